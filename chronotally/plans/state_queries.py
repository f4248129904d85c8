"""Queries on joins over time, latest state, snapshots and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronotally.operators import changelog as K
from chronotally.operators import folds
from chronotally.operators import joins as J
from chronotally.operators import prefix as P
from chronotally.operators import state as S
from chronotally.plans.registry import jobs, query, read, runs, steps

DAY, HOUR = 86_400_000_000, 3_600_000_000
CLOCK = 1_706_000_000_000_000
LO = 1_704_067_200_000_000


@query("select count(*) as n, 'events' as name from events union all select count(*), 'orders' from orders union all select count(*), 'lineitem' from lineitem")
def read_tables(spark, d):
    tables = [read(spark, d, n).agg(F.count("*").alias("n")).withColumn("name", F.lit(n)) for n in ("events", "orders", "lineitem")]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query("select run, repo, created, n, wait_s from runs join steps using (run) where runs.conclusion = 'failure'")
def equi_inner_join(spark, d):
    return runs(spark, d).where("conclusion = 'failure'").join(steps(spark, d), "run").select("run", "repo", "created", "n", "wait_s")


@query("""select runs.run, repo, s.run_s as first_s, f.n_failed from runs left join (select run, run_s from steps where n = 1) s on s.run = runs.run
    left join (select run, count(*) as n_failed from steps where conclusion = 'failure' group by run) f on f.run = runs.run""")
def left_outer_join(spark, d):
    parts = steps(spark, d)
    first = parts.where("n = 1").select("run", F.col("run_s").alias("first_s"))
    failed = parts.where("conclusion = 'failure'").groupBy("run").agg(F.count("*").alias("n_failed"))
    return runs(spark, d).select("run", "repo").join(first, "run", "left").join(failed, "run", "left")


@query("select run, repo, 'has' as side from runs where exists (select 1 from steps where steps.run = runs.run and steps.conclusion = 'failure') union all select run, repo, 'none' from runs where not exists (select 1 from steps where steps.run = runs.run)")
def semi_anti_join(spark, d):
    r, s = runs(spark, d).select("run", "repo"), steps(spark, d)
    return r.join(s.where("conclusion = 'failure'"), "run", "left_semi").withColumn("side", F.lit("has")).unionByName(r.join(s, "run", "left_anti").withColumn("side", F.lit("none")))


@query("""select l.id, l.run, l.a, (select max_by(r.id, (r.a, r.id)) from jobs r where r.run = l.run and r.kind = 'purchase' and r.a <= l.a) as asof_id from jobs l where l.kind = 'click'""")
def asof_latest(spark, d):
    rows = jobs(spark, d)
    left = rows.where("kind = 'click'").select("id", "run", "a")
    right = rows.where("kind = 'purchase'").select("run", F.col("a").alias("t"), "id")
    return J.asof_latest(left, right, ["run"], "a", "t", "id", slice_=7 * DAY)


@query(f"""with l as (select id, run, a as known from jobs where kind = 'click'), f as (select run, a + {HOUR} as available_at, id as fid, value as feature from jobs where kind = 'view'),
    m as (select l.id, l.run, l.known, max((available_at, fid, feature)) as b from l join f on f.run = l.run and available_at <= known group by all)
    select id, l.run, known, b[1] as available_at, b[2] as fid, b[3] as feature from l left join m using (id, run, known)""")
def pit_feature_join(spark, d):
    rows = jobs(spark, d)
    left = rows.where("kind = 'click'").select("id", "run", F.col("a").alias("known"))
    features = rows.where("kind = 'view'").select("run", (F.col("a") + HOUR).alias("available_at"), F.col("id").alias("fid"), F.col("value").alias("feature"))
    return J.pit_feature_join(left, features, ["run"], "known", "available_at", ["fid"])


@query(f"""with w as (select unnest(range(0, 40)) as w), x as (select w, {LO} + w * 5 * {HOUR} as lo, {LO} + w * 5 * {HOUR} + 8 * {HOUR} as hi from w)
    select w, kind, count(*) as n, cast(sum(least(b, hi) - greatest(a, lo)) as bigint) as overlap from jobs join x on a < hi and b > lo where b > a group by all""")
def interval_overlap_join(spark, d):
    windows = spark.range(40).select(F.col("id").alias("w"), (LO + F.col("id") * 5 * HOUR).alias("lo"), (LO + F.col("id") * 5 * HOUR + 8 * HOUR).alias("hi"))
    pairs = J.interval_overlap_join(jobs(spark, d), windows, "a", "b", "lo", "hi", 6 * HOUR)
    return pairs.groupBy("w", "kind").agg(F.count("*").alias("n"), F.sum("overlap").alias("overlap"))


_HOSTS = "hosts as (select n_nationkey as host, n_name as alias, n_regionkey as region from nation)"


@query(f"""with {_HOSTS} select jobs.id, alias, runs.repo, steps.run_s from jobs left join hosts on host = jobs.run % 30 and region = jobs.id % 5
    left join runs on runs.run = jobs.id left join steps on steps.run = jobs.id and steps.n = 1 and steps.kind = 'A'""")
def bind_identities(spark, d):
    hosts = read(spark, d, "nation").select(F.col("n_nationkey").alias("host"), F.col("n_name").alias("alias"), F.col("n_regionkey").alias("region"))
    rows = jobs(spark, d).select("id", (F.col("run") % 30).alias("host"), (F.col("id") % 5).alias("region")).join(hosts, ["host", "region"], "left")
    rows = rows.join(runs(spark, d).select(F.col("run").alias("id"), "repo"), "id", "left")
    return rows.join(steps(spark, d).where("n = 1 and kind = 'A'").select(F.col("run").alias("id"), "run_s"), "id", "left").select("id", "alias", "repo", "run_s")


@query("""with m as (select run, head, max(pr) as members from runs group by all), l as (select id, id % 15000 as batch, id % 997 as tested, case when id % 5 = 0 then -id end as members from jobs)
    select l.id, batch, tested, coalesce(l.members, m.members) as members from l left join m on m.run = l.batch and m.head = l.tested""")
def attach_members(spark, d):
    left = jobs(spark, d).select("id", (F.col("id") % 15000).alias("batch"), (F.col("id") % 997).alias("tested"), F.when(F.col("id") % 5 == 0, -F.col("id")).alias("members"))
    right = runs(spark, d).groupBy("run", "head").agg(F.max("pr").alias("members"))
    return J.attach_by(left, right, {"batch": "run", "tested": "head"}, ["members"])


@query(f"select r.id, s.id as artifact from jobs r join jobs s on s.run = r.run and s.kind = 'view' and s.a >= r.a and s.a <= r.b where r.kind = 'click'")
def attempt_window_join(spark, d):
    rows = jobs(spark, d)
    left = rows.where("kind = 'click'").select("id", "run", "a", "b")
    right = rows.where("kind = 'view'").select("run", F.col("a").alias("t"), F.col("id").alias("artifact"))
    left, right = left.withColumn("b1", F.col("b") + 1), right.withColumn("t1", F.col("t") + 1)  # ends are exclusive
    return J.interval_overlap_join(left, right, "a", "b1", "t", "t1", HOUR, ["run"]).select("id", "artifact")


@query("""with s as (select run, repo || ':' || (run // 7) as slot, 'success' as status, 1 + run % 3 as units from runs where run % 7 = 0), j as (select run as job, case when run % 11 = 0 then 'bench ' || repo || ':' || (run // 7) || '2 / x' when run % 2 = 0 then 'bench (' || repo || ':' || (run // 7) || ')' else repo || ':' || (run // 7) || ' again' end as name,
      case when run % 5 = 0 then 'in_progress' else 'completed' end as st, conclusion, case when run % 3 <> 0 then 'm' || run else '' end as runner, created // 1000000 + 600 as completed, created // 1000000 + run % 100 as began from runs where run % 7 in (0, 1)),
    m as (select slot, count(*) as n, min((job, st, conclusion, runner, completed, began)) as x from s join j on contains(j.name, s.slot) group by slot)
    select run, slot, case when n = 1 and (x[2] <> 'completed' or x[3] <> 'success') then 'failed-job' else status end as status, case when n = 1 then x[1] end as job, case when n = 1 then x[2] else 'missing-or-ambiguous' end as job_coverage,
      case when n = 1 and x[4] <> '' then (x[5] - x[6])::double end as job_elapsed_s, case when n = 1 and x[4] <> '' then round((x[5] - x[6]) / 60.0::double * units, 6) end as job_unit_minutes from s left join m using (slot)""")
def attach_jobs(spark, d):
    """Slots found in the names of jobs: missing ones, and ones that are part of another slot's name too."""
    r = runs(spark, d)
    slot = F.concat("repo", F.lit(":"), F.floor(F.col("run") / 7).cast("string"))
    name = F.when(F.col("run") % 11 == 0, F.concat(F.lit("bench "), slot, F.lit("2 / x"))).when(F.col("run") % 2 == 0, F.concat(F.lit("bench ("), slot, F.lit(")"))).otherwise(F.concat(slot, F.lit(" again")))
    second = F.floor(F.col("created") / 1_000_000)
    named = r.where("run % 7 in (0, 1)").select(
        F.col("run").alias("job"), name.alias("name"), F.when(F.col("run") % 5 == 0, "in_progress").otherwise("completed").alias("job_status"), F.col("conclusion").alias("job_conclusion"), F.when(F.col("run") % 3 != 0, F.concat(F.lit("m"), F.col("run").cast("string"))).otherwise("").alias("runner_name"),
        (second + 600).alias("completed"), F.array(F.struct((second + F.col("run") % 100).alias("started")), F.struct((second + 100).alias("started"))).alias("steps"),
    )
    slots = r.where("run % 7 = 0").select("run", slot.alias("slot"), F.lit("success").alias("status"), (1 + F.col("run") % 3).alias("units"))
    out = J.attach_jobs(slots, named, "slot", F.col("units")).drop("units")
    return out.withColumns({"job_elapsed_s": F.col("job_elapsed_s").cast("double"), "job_unit_minutes": F.round("job_unit_minutes", 6)})


@query("""with o as (select run, count(*) as c, min(n) as n, min(run_s) as run_s from steps where kind = 'R' group by run)
    select runs.run, case when c = 1 then o.n end as n, case when c = 1 then o.run_s end as run_s, case when c = 1 then 'matched' else 'missing-or-ambiguous' end as state from runs left join o using (run)""")
def only_match(spark, d):
    return J.only_match(runs(spark, d).select("run"), steps(spark, d).where("kind = 'R'"), ["run"], ["n", "run_s"])


_FEEDS = "x as (select id, a as observed, value, 1 as prio from jobs), y as (select id, case when id % 3 = 0 then a + 5 when id % 3 = 1 then a else a - 5 end as observed, -value as value, 0 as prio from jobs where id % 2 = 0)"


@query(f"with {_FEEDS} select id, max_by(observed, (observed, prio)) as observed, max_by(value, (observed, prio)) as value from (from x union all from y) group by id")
def latest_wins_two_sources(spark, d):
    x = jobs(spark, d).select("id", F.col("a").alias("observed"), "value")
    late = F.when(F.col("id") % 3 == 0, F.col("observed") + 5).when(F.col("id") % 3 == 1, F.col("observed")).otherwise(F.col("observed") - 5)
    return J.latest_wins(x, x.where("id % 2 = 0").select("id", late.alias("observed"), (-F.col("value")).alias("value")), ["id"], ["observed"])


@query("""with a as (select distinct pr from runs where conclusion = 'failure'), b as (select distinct pr from runs where workflow = '1-URGENT')
    select pr, 'missing' as side from a where pr not in (select pr from b) union all select pr, 'unexpected' from b where pr not in (select pr from a)""")
def set_equality_check(spark, d):
    r = runs(spark, d)
    return J.set_difference(r.where("conclusion = 'failure'"), r.where("workflow = '1-URGENT'"), ["pr"])


@query("""with a as (select run, repo, pr, price from runs where run % 11 <> 0), b as (select run, case when run % 7 = 0 then null else repo end as repo, pr + (run % 5 = 0)::int as pr, price from runs where run % 13 <> 0),
    j as (select coalesce(a.run, b.run) as run, a.run is null or b.run is null as lone, a.repo as r1, b.repo as r2, a.pr as p1, b.pr as p2 from a full join b on a.run = b.run)
    select run, '*' as field from j where lone union all select run, 'repo' from j where not lone and r1 is distinct from r2 union all select run, 'pr' from j where not lone and p1 is distinct from p2""")
def table_diff(spark, d):
    r = runs(spark, d).select("run", "repo", "pr", "price")
    other = r.where("run % 13 <> 0").withColumn("repo", F.when(F.col("run") % 7 != 0, F.col("repo"))).withColumn("pr", F.col("pr") + (F.col("run") % 5 == 0).cast("int"))
    return J.table_diff(r.where("run % 11 <> 0"), other, ["run"], ["repo", "pr", "price"])


@query("""select w as workload, r as repetition, s as shape, x.n from (values ('R'), ('A'), ('N'), ('X')) a(w), (values (1), (2), (3)) b(r), (values ('O'), ('F')) c(s)
    left join (select kind, n as k, size, count(*) as n from steps group by all) x on x.kind = w and x.k = r and x.size = s""")
def slot_grid(spark, d):
    grid = J.slot_grid(spark, workload=["R", "A", "N", "X"], repetition=[1, 2, 3], shape=["O", "F"])
    results = steps(spark, d).groupBy(F.col("kind").alias("workload"), F.col("n").alias("repetition"), F.col("size").alias("shape")).agg(F.count("*").alias("n"))
    return grid.join(results, ["workload", "repetition", "shape"], "left")


@query(f"""with recursive o as (select run, kind, id, a, row_number() over (partition by run, kind order by a, id) as k from jobs),
    f as (select run, kind, k, id, a as last, true as accepted from o where k = 1 union all
      select o.run, o.kind, o.k, o.id, case when o.a - f.last > {14 * DAY} then o.a else f.last end, o.a - f.last > {14 * DAY} from f join o on o.run = f.run and o.kind = f.kind and o.k = f.k + 1)
    select id, accepted from f""")
def dedupe_deliveries(spark, d):
    """Deliveries of one id (run and kind here) are taken again two weeks after the last that was."""
    return folds.dedupe_deliveries(jobs(spark, d).select("run", "kind", "id", "a"), ["run", "kind"], "a", ["a", "id"], window=14 * DAY).select("id", "accepted")


@query("select id, min((value, 0))[1] as value from (select id, value from jobs union all select id, value + 1 from jobs where id % 10 = 0) group by id")
def first_delivery(spark, d):
    rows = jobs(spark, d).select("id", "value")
    both = rows.unionByName(rows.where("id % 10 = 0").withColumn("value", F.col("value") + 1))
    return S.dedupe_first(both, ["id"], ["value"])


@query("select count(*) as n, count(distinct content) as distinct_rows from (select run || ':' || kind || ':' || value as content from jobs union all select run || ':' || kind || ':' || value from jobs where id % 10 = 0)")
def content_dedupe(spark, d):
    rows = jobs(spark, d).select("run", "kind", "value")
    both = rows.unionByName(jobs(spark, d).where("id % 10 = 0").select("run", "kind", "value"))
    keyed = both.select(F.sha2(F.to_json(F.struct("run", "kind", "value")), 256).alias("h"))
    return keyed.groupBy("h").agg(F.count("*").alias("c")).agg(F.sum("c").alias("n"), F.count("*").alias("distinct_rows"))


_STATUS = "case kind when 'signup' then 'pending' when 'error' then 'waiting' when 'click' then 'queued' when 'view' then 'in_progress' else 'completed' end"


_RANKED = lambda s: f"case {s} when 'completed' then 3 when 'in_progress' then 2 else 1 end"


@query(f"""with recursive o as (select run, {_STATUS} as s, a // 1000000 - (id % 4) * 200000 as u, case when id % 3 = 0 then 'unknown' else kind end as kd, case when id % 2 = 0 then 'm' || id % 10 end as rn,
      row_number() over (partition by run order by a, id) as k from jobs),
    f as (select run, k, s, u, kd, rn, 1 as n from o where k = 1 union all
      select run, k + 1, case when ok then s2 else s end, case when ok then u2 else u end, case when ok and kd2 <> 'unknown' then kd2 else kd end, case when ok then coalesce(rn2, rn) else rn end, n + ok::int
      from (select f.*, o.s as s2, o.u as u2, o.kd as kd2, o.rn as rn2, o.u >= f.u and ((f.s = 'in_progress' and o.s in ('pending', 'waiting')) or {_RANKED("o.s")} >= {_RANKED("f.s")}) as ok
            from f join o on o.run = f.run and o.k = f.k + 1))
    select run, arg_max(s, k) as status, arg_max(u, k) as updated, arg_max(kd, k) as kind, arg_max(rn, k) as runner, max(n)::bigint as n_accepted from f group by run""")
def latest_state(spark, d):
    """Records of a run, merged column by column in order of arrival."""
    status = F.when(F.col("kind") == "signup", "pending").when(F.col("kind") == "error", "waiting").when(F.col("kind") == "click", "queued").when(F.col("kind") == "view", "in_progress").otherwise("completed")
    i = F.col("id")
    rows = jobs(spark, d).select("run", "a", "id", status.alias("status"), (F.floor(F.col("a") / 1_000_000) - i % 4 * 200_000).alias("updated"), F.when(i % 3 == 0, "unknown").otherwise(F.col("kind")).alias("kind"), F.when(i % 2 == 0, F.concat(F.lit("m"), (i % 10).cast("string"))).alias("runner"))
    return folds.latest_state(rows, ["run"], ["a", "id"], ["status", "updated", "kind", "runner"], folds.Merge(fill={"kind": "unknown", "runner": None}))


@query("""select run, id, last_value(case when kind = 'click' then value end ignore nulls) over w as value from jobs window w as (partition by run order by a, id rows between unbounded preceding and current row)""")
def carry_forward(spark, d):
    rows = jobs(spark, d).withColumn("value", F.when(F.col("kind") == "click", F.col("value")))
    return S.carry_forward(rows, ["run"], ["a", "id"], ["value"]).select("run", "id", "value")


@query("""select run, max_by(case when id % 3 = 0 then value end, (kind = 'purchase', a, id)) filter (where id % 3 = 0) as value, max_by(kind, (kind = 'purchase', a, id)) as kind from jobs group by run""")
def snapshot_merge(spark, d):
    rows = jobs(spark, d).withColumn("value", F.when(F.col("id") % 3 == 0, F.col("value")))
    return S.snapshot_merge(rows, ["run"], [F.col("kind") == "purchase", F.col("a"), F.col("id")], ["value", "kind"])


@query("select head, max(attempt) as attempt, max_by(run, (attempt, run)) as run from runs group by head")
def latest_attempt(spark, d):
    rows = runs(spark, d).select("head", "attempt", "run")
    return S.latest_by(rows, ["head"], [F.col("attempt"), F.col("run")])


@query("select run, n from steps where conclusion <> 'cancelled' or run not in (select run from steps where conclusion <> 'cancelled')")
def drop_placeholders(spark, d):
    rows = steps(spark, d)
    actual = rows.where("conclusion <> 'cancelled'")
    lone = rows.where("conclusion = 'cancelled'").join(actual.select("run").distinct(), "run", "left_anti")
    return actual.select("run", "n").unionByName(lone.select("run", "n"))


@query("""select head, max_by(run, (attempt, conclusion <> 'cancelled', created, run)) as run, max_by(pr, (attempt, conclusion <> 'cancelled', created, run)) filter (where pr % 2 = 0) as members from runs group by head""")
def upsert_precedence(spark, d):
    rows = runs(spark, d).withColumn("members", F.when(F.col("pr") % 2 == 0, F.col("pr")))
    return S.snapshot_merge(rows, ["head"], [F.col("attempt"), F.col("conclusion") != "cancelled", F.col("created"), F.col("run")], ["run", "members"])


@query("select pr, min(created) as landed, min_by(run, (created, run)) as run from runs where conclusion = 'success' group by pr")
def earliest_landing(spark, d):
    return runs(spark, d).where("conclusion = 'success'").groupBy("pr").agg(F.min("created").alias("landed"), F.min_by("run", F.struct("created", "run")).alias("run"))


_FRAMES = "frames as (select repo as source, attempt as epoch, head as sequence, repo || attempt || head as snapshot, n - 1 as part, case when head % 17 = 0 then n else 1 + head % 6 end as parts, wait_s % 2 as digest from steps join (select run, repo, attempt, head from runs) using (run))"


@query(f"""with {_FRAMES}, p as (select source, epoch, sequence, snapshot, part, min(parts) as lo, max(parts) as hi, count(distinct digest) as n from frames group by all),
    w as (select source, epoch, sequence, snapshot, min(lo) as lo, max(hi) as parts, count(*) as got, min(part) as f, max(part) as l, max(n) as n from p group by all),
    s as (select *, case when n > 1 or lo <> parts then 'conflict' when got = parts and f = 0 and l = parts - 1 then 'complete' else 'incomplete' end as st from w),
    m as (select source, max((epoch, sequence)) as newest from s where st = 'complete' group by source)
    select s.source, epoch, sequence, snapshot, parts, got, case when (epoch, sequence) < newest then 'fenced' else st end as state from s left join m on m.source = s.source""")
def assemble_frames(spark, d):
    rows = steps(spark, d).join(runs(spark, d).select("run", "repo", "attempt", "head"), "run")
    parts = F.when(F.col("head") % 17 == 0, F.col("n").cast("long")).otherwise(1 + F.col("head") % 6)
    frames = rows.select(F.col("repo").alias("source"), F.col("attempt").alias("epoch"), F.col("head").alias("sequence"), F.concat("repo", "attempt", "head").alias("snapshot"), (F.col("n") - 1).alias("part"), parts.alias("parts"), (F.col("wait_s") % 2).alias("digest"))
    return S.assemble_frames(frames)


_PLACE = "case when {0} % 13 = 5 then {0} - 1 else {0} end"
_FRAMES = f"""i as (select repo as source, run, row_number() over (partition by repo order by created, run) as j from runs),
    k as (select source, run, j as arrival, case when j % 19 = 7 then j - 1 else j end as j from i),
    o as (select source, arrival, j, {_PLACE.format("j")} as q, case when j % 10 <> 1 then {_PLACE.format("(j - 1)")} end as base, j % 17 <> 3 as whole from k),
    f as (select source, arrival, j, whole, q as c, j as cj, q as s, j as sj, 1::bigint as n, 'committed' as status from o where arrival = 1 union all
      select source, arrival + 1, j2, whole2, case when st = 'committed' then q2 else c end, case when st = 'committed' then j2 else cj end, case when st in ('committed', 'incomplete') then q2 else s end,
        case when st in ('committed', 'incomplete') then j2 else sj end, n + (st = 'committed')::int, st
      from (select f.*, o.j as j2, o.q as q2, o.whole as whole2, case when o.j = f.cj then 'repeated' when o.base <> f.c then 'resync' when o.q < f.s then 'superseded' when o.q = f.s and o.j <> f.sj then 'conflict'
              when o.q <= f.c and o.q // 100 = f.c // 100 then 'committed before' when not o.whole then 'incomplete' else 'committed' end as st
            from f join o on o.source = f.source and o.arrival = f.arrival + 1))"""
_VERSIONS = f"""{_FRAMES}, c as (select source, j, n as commit, case when j % 10 = 1 then case when j % 20 = 1 then ['A', 'R'] else ['A'] end else [] end as complete from f where status = 'committed'),
    x as (select i.source, s.kind as collection, s.module % 50 as id, c.commit, max(case when s.n % 5 <> 0 then s.wait_s end) as data from steps s join i on i.run = s.run join c on c.source = i.source and c.j = i.j group by all),
    y as (select *, lead(commit) over (partition by source, collection, id order by commit) as after_ from x),
    v as (select source, collection, id, data, commit as since, least(after_, (select min(commit) from c where c.source = y.source and c.commit > y.commit and list_contains(c.complete, y.collection))) as until from y where data is not null)"""


def _frames(spark, d):
    """Every run as a frame of its repository: mostly deltas on the frame before, every tenth a full one; some are sent again, take
    another's place, or lack parts, upon which deltas are refused up to the next full frame."""
    rows = P.prefix_sums(runs(spark, d).select(F.col("repo").alias("source"), "run", "created"), ["source"], ["created", "run"], {"number": F.lit(1).cast("long")})
    j = F.when(F.col("number") % 19 == 7, F.col("number") - 1).otherwise(F.col("number"))
    place = lambda j: F.when(j % 13 == 5, j - 1).otherwise(j)
    base = F.when(j % 10 != 1, place(j - 1))
    complete = F.when(j % 20 == 1, F.array(F.lit("A"), F.lit("R"))).when(j % 10 == 1, F.array(F.lit("A")))
    div = lambda c: F.floor(c / 100)
    frames = rows.select("source", F.col("number").alias("arrival"), div(place(j)).alias("epoch"), (place(j) % 100).alias("sequence"), j.cast("string").alias("snapshot"), div(base).alias("base_epoch"), (base % 100).alias("base_sequence"), (j % 17 != 3).alias("whole"), F.lit("d").alias("digest"), complete.alias("complete"))
    content = steps(spark, d).join(rows, "run").select("source", F.col("number").cast("string").alias("snapshot"), F.col("kind").alias("collection"), (F.col("module") % 50).alias("id"), F.when(F.col("n") % 5 != 0, F.col("wait_s")).alias("data"))
    return K.commit_frames(frames, ["arrival"]), content


def _versions(spark, d):
    frames, content = _frames(spark, d)
    return K.entity_versions(content, frames.where("status = 'committed'"))


@query(f"with recursive {_FRAMES} select source, arrival, status, case when status = 'committed' then n end as commit from f")
def commit_frames(spark, d):
    return _frames(spark, d)[0].select("source", "arrival", "status", "commit")


@query(f"with recursive {_VERSIONS} select * from v")
def entity_versions(spark, d):
    return _versions(spark, d)


@query(f"with recursive {_VERSIONS} select source, collection, id, data from v where until is null")
def apply_snapshot(spark, d):
    return K.state_at(_versions(spark, d))


@query(f"""with recursive {_VERSIONS}, w as (select *, coalesce(lag(until) over e = since and lag(data) over e = data, false) as b, coalesce(lead(since) over e = until and lead(data) over e = data, false) as a from v window e as (partition by source, collection, id order by since)),
    t as (select source, data % 7 as key, since as commit from w where not b union all select source, data % 7, until from w where not a and until is not null) select distinct source, commit, 'bucket' as kind, key from t""")
def changed_keys(spark, d):
    return K.touched(_versions(spark, d), F.col("data") % 7, "bucket")


@query("select s.run, s.n, case when r.run is null then 'orphan' when r.attempt <> 1 + s.n % 3 then 'version' end as pruned from steps s left join (select * from runs where conclusion <> 'cancelled') r on r.run = s.run")
def prune_orphans(spark, d):
    parents = runs(spark, d).where("conclusion <> 'cancelled'").select("run", F.col("attempt").alias("version"))
    return K.prune_orphans(steps(spark, d).select("run", "n", (1 + F.col("n") % 3).alias("version")), parents, ["run"], "version").select("run", "n", "pruned")


@query("select run, kind, id from (select *, row_number() over (partition by run, kind order by a desc, id desc) as r from jobs) where r <= case kind when 'click' then 3 when 'view' then 5 else 0 end")
def topn_retention(spark, d):
    return S.topn_retention(jobs(spark, d), ["run", "kind"], [F.col("a").desc(), F.col("id").desc()], {"click": 3, "view": 5}, "kind").select("run", "kind", "id")


_EVICT = """with r as (select run % 3 as source, id, kind, cast(round(value * 100) as bigint) as size, a, case kind when 'error' then 0 when 'signup' then 1 else 2 end as rank from jobs),
    c as (select *, sum(case when kind = 'purchase' then 0 else size end) over (partition by source order by rank, a, id rows unbounded preceding) as c, sum(size) over (partition by source) as t from r),
    e as (select *, kind <> 'purchase' and t - (c - size) > BUDGET as gone from c)"""


def _evicted(spark, d, budget):
    """Details of three sources: errors go first, then signups, then the rest by age; purchases always stay."""
    rank = F.when(F.col("kind") == "error", 0).when(F.col("kind") == "signup", 1).otherwise(2)
    rows = jobs(spark, d).select((F.col("run") % 3).alias("source"), "id", "kind", "a", F.round(F.col("value") * 100).cast("long").alias("size"), rank.alias("rank"))
    return P.budget_eviction(rows, ["source"], ["rank", "a", "id"], "size", budget, fixed=F.col("kind") == "purchase")


@query(_EVICT.replace("BUDGET", "30000000") + " select source, id, gone as evicted from e")
def budget_eviction(spark, d):
    return _evicted(spark, d, 30_000_000).select("source", "id", "evicted")


@query(_EVICT.replace("BUDGET", "4000000") + " select source, kind, count(*) filter (where gone) as n_evicted, coalesce(sum(size) filter (where gone), 0)::bigint as size_evicted, count(*) filter (where not gone) as n_kept, not bool_or(gone) as complete from e group by all")
def eviction_counts(spark, d):
    return P.evicted_counts(_evicted(spark, d, 4_000_000), ["source"], "kind", "size")


@query("""with recursive o as (select run, id, a // 3600000000 as tm, run % 3 + (id % 20 = 0)::int as session, a // 3600000000 // 12 + id % 7 as q, row_number() over (partition by run order by a // 3600000000, id) as k from jobs),
    f as (select run, k, id, tm, session, q, cast(null as varchar) as refusal from o where k = 1 union all
      select run, k + 1, id2, case when no is null then tm2 else tm end, case when no is null then session2 else session end, case when no is null then q2 else q end, no
      from (select f.*, o.id as id2, o.tm as tm2, o.session as session2, o.q as q2, case when o.tm - f.tm > 200 then null when o.tm - f.tm < 10 then 'interval' when o.session <> f.session or o.q <= f.q then 'superseded' end as no
            from f join o on o.run = f.run and o.k = f.k + 1))
    select id, refusal is null as accepted, refusal from f""")
def sequence_guard(spark, d):
    """Reports of a run, an hour counting as a second: ten apart at least, of one session, in sequence, forgotten after 200."""
    hour, i = F.floor(F.col("a") / HOUR), F.col("id")
    rows = jobs(spark, d).select("run", "id", hour.alias("at"), (F.col("run") % 3 + (i % 20 == 0).cast("int")).alias("session"), (F.floor(hour / 12) + i % 7).alias("sequence"))
    return folds.sequence_guard(rows, ["run"], "at", "session", "sequence", ["id"], interval=10, lifetime=200).select("id", "accepted", "refusal")


@query(f"""with recursive o as (select run, id, a, kind, id % 2 as instance, row_number() over (partition by run order by a, id) as k from jobs where id % 11 <> 0),
    f as (select run, k, id, kind, instance, a as since, a as seen from o where k = 1 union all
      select run, k + 1, case when yes then id2 else id end, case when yes then kind2 else kind end, case when yes then instance2 else instance end, case when gone then a2 else since end, case when yes then a2 else seen end
      from (select f.*, o.id as id2, o.kind as kind2, o.instance as instance2, o.a as a2, o.a - f.seen > {5 * DAY} as gone, o.a - f.seen > {5 * DAY} or (o.kind = f.kind and o.instance = f.instance) as yes
            from f join o on o.run = f.run and o.k = f.k + 1)),
    l as (select run, max(k) as k from f group by run)
    select run, kind, instance, id % 4 as slot, since, seen from f join l using (run, k) where seen >= {CLOCK} - {5 * DAY}""")
def sticky_mapping(spark, d):
    """A runner stays with the machine and instance that it was first seen on, until it is unseen for five days."""
    i = F.col("id")
    rows = jobs(spark, d).select("run", "a", "id", F.when(i % 11 != 0, F.col("kind")).alias("kind"), (i % 2).alias("instance"), (i % 4).alias("slot"))
    return folds.sticky_mapping(rows, "run", "a", ["kind", "instance"], ["slot"], ["id"], clock=CLOCK, lifetime=5 * DAY)


@query("select repo, min(created) as created from (select repo, created from runs where run % 2 = 0 union all select repo, created + 7 from runs where run % 2 = 1) group by repo")
def merge_cursors(spark, d):
    r = runs(spark, d)
    return S.merge_cursors(r.where("run % 2 = 0"), r.where("run % 2 = 1").withColumn("created", F.col("created") + 7), "repo", "created")


@query("select run, n from steps where run in (select run from runs where repo in ('repo1', 'repo3'))")
def scope_filter(spark, d):
    allowed = runs(spark, d).where("repo in ('repo1', 'repo3')").select("repo").distinct()
    return S.scope_filter(runs(spark, d), steps(spark, d), allowed, "repo", "run")[1].select("run", "n")


@query(f"select id, kind from jobs where a >= {CLOCK} - case kind when 'click' then {9 * DAY} when 'view' then {6 * DAY} else {3 * DAY} end")
def retention_filter(spark, d):
    return S.retention_filter(jobs(spark, d), "a", "kind", {"click": 9 * DAY, "view": 6 * DAY}, 3 * DAY, CLOCK).select("id", "kind")


@query("""select run, case when not exists (select 1 from steps s where s.run = r.run) then 'no-children' when conclusion = 'failure' and not exists (select 1 from steps s where s.run = r.run and s.conclusion = 'failure') then 'no-failure-detail' end as reason
    from runs r where not exists (select 1 from steps s where s.run = r.run) or (conclusion = 'failure' and not exists (select 1 from steps s where s.run = r.run and s.conclusion = 'failure'))""")
def needs_work(spark, d):
    have = steps(spark, d).groupBy("run").agg(F.bool_or(F.col("conclusion") == "failure").alias("failed"))
    rows = runs(spark, d).join(have, "run", "left")
    reason = F.when(F.col("failed").isNull(), "no-children").when((F.col("conclusion") == "failure") & ~F.col("failed"), "no-failure-detail")
    return rows.select("run", reason.alias("reason")).where("reason is not null")
