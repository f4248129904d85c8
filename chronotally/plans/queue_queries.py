"""Queries on snapshots, landings, queue history, live activity and backlog."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronotally.operators import activity as A
from chronotally.operators import graphs as G
from chronotally.operators import joins as J
from chronotally.operators import partials as B
from chronotally.operators import quantiles as Q
from chronotally.operators import sequence as S
from chronotally.operators import snapshots as N
from chronotally.operators import state as T
from chronotally.plans.registry import jobs, query, read, runs, snapshots, steps

MINUTE, HOUR, DAY = 60_000_000, 3_600_000_000, 86_400_000_000
CLOCK = 1_706_000_000_000_000
LO = 1_704_067_200_000_000


@query("""select tm, case when len(items) % 5 = 0 then null else coalesce(case when len(items) % 4 = 0 then -1 end, len(items)) end as n, case when len(items) % 5 <> 0 then tm else max(case when len(items) % 5 <> 0 then tm end) over (order by tm) end as complete_at from snaps""")
def normalize_observation(spark, d):
    n = F.size("items")
    rows = snapshots(spark, d).withColumn("ok", n % 5 != 0)
    good = rows.where("ok").select(F.lit(0).alias("k"), F.col("tm").alias("t"), F.col("tm").alias("complete_at"))
    left = rows.select(F.lit(0).alias("k"), "tm", F.when(F.col("ok"), F.coalesce(F.when(n % 4 == 0, -1), n)).alias("n"))
    found = J.asof_latest(left, good, ["k"], "tm", "t", "complete_at", slice_=DAY)
    return found.select("tm", F.col("n").cast("long").alias("n"), F.col("asof_complete_at").alias("complete_at"))


@query("select item, min(tm) as first_seen, max(tm) as last_seen from (select tm, unnest(items) as item from snaps) group by item")
def first_observed(spark, d):
    return N.first_observed(snapshots(spark, d), "tm", "items")


@query("""with v as (select run as item, kind as version, min(a) as start, min(case when id % 9 = 0 then a end) as withdrawn from jobs group by all)
    select item, version, start, least(withdrawn, lead(start) over (partition by item order by start, version)) as "end" from v""")
def staleness_end(spark, d):
    rows = jobs(spark, d).select(F.col("run").alias("item"), F.col("kind").alias("version"), "a", "id")
    return N.staleness_end(rows, "item", "version", "a", F.col("id") % 9 == 0)


@query(f"""with t as (select tm, tm - lag(tm) over (order by tm) as gap, len(items) as n from snaps) select count(*) as snapshots, count(*) filter (where gap > 1200000000) as gaps, count(*) filter (where n = 1) as single, count(*) filter (where gap is null) as unknown from t""")
def capture_coverage(spark, d):
    rows = S.ordered_index(snapshots(spark, d), [F.col("tm")], "k")
    rows = rows.join(rows.select((F.col("k") + 1).alias("k"), F.col("tm").alias("before")), "k", "left").withColumn("gap", F.col("tm") - F.col("before"))
    return rows.agg(F.count("*").alias("snapshots"), F.count_if(F.col("gap") > 1_200_000_000).alias("gaps"), F.count_if(F.size("items") == 1).alias("single"), F.count_if(F.col("gap").isNull()).alias("unknown"))


_SEG = f"""s as (select run, kind, a, id, lag(kind) over w as p from jobs window w as (partition by run order by a, id)), seg as (select run, kind, a as lo, coalesce(lead(a) over (partition by run order by a, id), {CLOCK}) as hi from s where p is null or p <> kind)"""


def _settings_windows(rows):
    seg = S.change_segments(rows, ["run"], ["a", "id"], ["kind"], "a").select("run", "kind", F.col("seg_start").alias("lo"), F.coalesce("seg_end", F.lit(CLOCK)).alias("hi"))
    pairs = J.interval_overlap_join(rows.select("run", "id", "a", "b"), seg, "a", "b", "lo", "hi", 6 * HOUR, ["run"])
    return pairs.groupBy("run", "kind", "lo", "hi").agg(F.count("id").alias("n"), F.sum("overlap").alias("busy"))


_SETTINGS = f"""with {_SEG} select seg.run, seg.kind, seg.lo, seg.hi, count(j.id) as n, cast(coalesce(sum(least(j.b, hi) - greatest(j.a, lo)), 0) as bigint) as busy from seg join (select * from jobs where b > a) j on j.run = seg.run and j.a < hi and j.b > lo and hi > lo group by all"""


@query(_SETTINGS)
def settings_windows(spark, d):
    return _settings_windows(jobs(spark, d))


@query(_SETTINGS)
def settings_windows_all(spark, d):
    return settings_windows(spark, d)


@query(f"""with p as (select min(a) as t0 from jobs), x as (select t0, unnest([0, 1, 2, 3]) as k from p), w as (select k, t0 + k * {DAY} as lo, t0 + k * {DAY} + (k + 1) * {6 * HOUR} as hi from x),
    j as (select k, value, a, row_number() over (partition by k order by value) as r, count(*) over (partition by k) as n from w join jobs on a >= lo and a < hi)
    select k as phase, count(*) as arrivals, cast(max(a) - min(a) as bigint) as spread, max(case when r = least(n, cast(floor(0.5::double * n) as bigint) + 1) then value end) as median, max(case when r = least(n, cast(floor(0.95::double * n) as bigint) + 1) then value end) as p95 from j group by k""")
def experiment_phases(spark, d):
    rows = jobs(spark, d)
    t0 = rows.agg(F.min("a").alias("t0"))
    ends = ", ".join(f"{k}, t0 + {k * DAY}, t0 + {k * DAY + (k + 1) * 6 * HOUR}" for k in range(4))
    phases = t0.select(F.expr(f"stack(4, {ends}) as (phase, lo, hi)"))
    points = rows.select("value", "a", (F.col("a") + 1).alias("a1"))
    inside = J.interval_overlap_join(points, phases, "a", "a1", "lo", "hi", 6 * HOUR)
    out = inside.groupBy("phase").agg(F.count("*").alias("arrivals"), (F.max("a") - F.min("a")).alias("spread"))
    return out.join(Q.report_quantiles(inside, ["phase"], "value", {"median": 0.5, "p95": 0.95}), "phase")


_LANDED = """l as (select unnest([pr, pr + 1]) as pr, head % 50 as version, case when run % 2 = 0 then 'queue' else 'bors' end as engine, created as landed from runs where conclusion = 'success'),
    f as (select pr, head % 50 as version, min(created) as seen from runs where conclusion <> 'success' group by all),
    j as (select l.*, coalesce(e.seen, case when engine = 'queue' then (select max(f.seen) from f where f.pr = l.pr and f.seen <= l.landed) end) as ready from l left join f e on e.pr = l.pr and e.version = l.version),
    q as (select *, row_number() over (partition by pr order by landed, engine, ready) as r from j where ready <= landed), p as (select pr, engine, landed, ready from q where r = 1)"""


def _latencies(spark, d):
    """Two members a landing; the queue's members count from the last ready time of any version if theirs was never seen."""
    r = runs(spark, d).withColumn("version", F.col("head") % 50)
    landed = r.where("conclusion = 'success'").select(F.explode(F.array("pr", F.col("pr") + 1)).alias("pr"), "version", F.when(F.col("run") % 2 == 0, "queue").otherwise("bors").alias("engine"), F.col("created").alias("landed"))
    ready = r.where("conclusion <> 'success'").select("pr", "version", F.col("created").alias("seen"))
    return J.landing_latencies(landed, ready, item="pr", version="version", engine="engine", at="landed", seen="seen", loose="queue")


@query(f"with {_LANDED} select * from p")
def landed_items(spark, d):
    return _latencies(spark, d).select("pr", "engine", "landed", "ready")


@query(f"""with {_LANDED}, m as (select engine, (landed - ready) / 60000000.0::double as minutes from p), o as (select *, row_number() over (partition by engine order by minutes) - 1 as k, count(*) over (partition by engine) as n from m)
    select engine, any_value(n) as items, max(minutes) filter (where k = least(n - 1, floor(0.5::double * n))) as median, max(minutes) filter (where k = least(n - 1, floor(0.95::double * n))) as p95 from o group by engine""")
def landing_latency(spark, d):
    minutes = _latencies(spark, d).withColumn("minutes", (F.col("landed") - F.col("ready")) / 60_000_000.0)
    return minutes.groupBy("engine").agg(F.count("*").alias("items")).join(Q.report_quantiles(minutes, ["engine"], "minutes", {"median": 0.5, "p95": 0.95}), "engine")


_EDGES = "edges as (select r1.repo as scope, r1.run as sha, r1.run - 5 as parent from runs r1 where r1.run % 3 <> 0)"


@query(f"""with recursive {_EDGES}, p as (select repo as scope, run as sha, created as at_ from runs where run % 10 = 0),
    up as (select scope, sha, at_, 0 as d from p union all select up.scope, e.parent, up.at_, d + 1 from up join edges e on e.scope = up.scope and e.sha = up.sha where d < 20),
    b as (select scope, sha, min(at_) as landed_at from up group by all)
    select b.scope, b.sha, landed_at, case when p.at_ = landed_at then 'push' else 'ancestor-bound' end as source from b join runs r on r.repo = b.scope and r.run = b.sha left join p on p.scope = b.scope and p.sha = b.sha""")
def main_landings(spark, d):
    r = runs(spark, d).select(F.col("repo").alias("scope"), F.col("run").alias("sha"), "created")
    parents = r.where("sha % 3 <> 0").select("scope", "sha", (F.col("sha") - 5).alias("parent"))
    pushes = r.where("sha % 10 = 0").select("scope", "sha", F.col("created").alias("pushed_at"))
    return G.ancestor_landings(r.select("scope", "sha"), parents, pushes, "scope")


def _post_merge_attribution(rows):
    one = F.when(F.count_distinct("workflow") == 1, F.min("workflow"))
    return rows.groupBy("head").agg(one.alias("engine"), F.count("*").alias("n"))


_ENGINES = "select head, case when count(distinct workflow) = 1 then min(workflow) end as engine, count(*) as n from runs group by head"


@query(_ENGINES)
def post_merge_attribution(spark, d):
    return _post_merge_attribution(runs(spark, d))


@query(_ENGINES)
def post_merge_attribution_all(spark, d):
    return post_merge_attribution(spark, d)


@query("""with recursive n as (select conv_id as scope, turn, conv_id * 1000 + turn as id, turn % 5 = 3 as failed from (select distinct conv_id, turn from conversations)),
    c as (select scope, id, turn, [turn] as chain, turn - 1 as base, false as ahead_failed from n union all
      select c.scope, c.id, c.turn, list_prepend(n.turn, c.chain), n.turn - 1, c.ahead_failed or n.failed from c join n on n.scope = c.scope and n.turn = c.base)
    select scope, id, array_to_string(arg_max(chain, len(chain)), ',') as chain, bool_or(ahead_failed) as ahead_failed, max(len(chain))::int as position from c group by scope, id""")
def queue_chain(spark, d):
    t = read(spark, d, "conversations").select("conv_id", "turn").distinct()
    rows = t.select(F.col("conv_id").alias("scope"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), (F.col("turn") - 1).alias("base"), F.col("turn").alias("head"), F.col("turn").alias("item"), (F.col("turn") % 5 == 3).alias("failed"))
    out = G.queue_chain(rows, "scope", "id", "base", "head", "item", "failed")
    return out.withColumn("chain", F.array_join(F.transform("chain", lambda x: x.cast("string")), ","))


@query("with m as (select pr, max(attempt) as m from runs group by pr), w as (select pr, unnest(range(1, m + 1))::int as attempt from m) select pr, attempt from w where (pr, attempt) not in (select (pr, attempt) from runs)")
def missing_attempts(spark, d):
    return N.missing_attempts(runs(spark, d), "pr", "attempt")


@query(f"select run, coalesce(min(case when kind = 'error' and (id % 2 = 0 or a >= {CLOCK} - {6 * HOUR}) then a end), max(b)) as complete_to from jobs group by run")
def completeness_watermark(spark, d):
    return N.completeness_watermark(jobs(spark, d), "run", "a", F.col("kind") == "error", "b", F.col("id") % 2 != 0, CLOCK, 6 * HOUR)


@query("""select repo, workflow, count(*) as attempts, count(s.run) as covered, count(*) - count(s.run) as gaps, 'attempts' as stream from runs left join (select distinct run from steps) s using (run) where repo in (select repo from runs where workflow = '1-URGENT') group by all
    union all select repo, workflow, count(*), count(*) filter (where conclusion <> 'cancelled'), count(*) filter (where conclusion = 'cancelled'), 'conclusions' from runs where repo in (select repo from runs where workflow = '1-URGENT') group by all""")
def published_coverage(spark, d):
    r = runs(spark, d)
    r = r.join(r.where("workflow = '1-URGENT'").select("repo").distinct(), "repo", "left_semi")
    have = steps(spark, d).select("run").distinct().withColumn("hit", F.lit(1))
    a = r.join(have, "run", "left").groupBy("repo", "workflow").agg(F.count("*").alias("attempts"), F.count("hit").alias("covered"))
    b = r.groupBy("repo", "workflow").agg(F.count("*").alias("attempts"), F.count_if(F.col("conclusion") != "cancelled").alias("covered"))
    both = a.withColumn("stream", F.lit("attempts")).unionByName(b.withColumn("stream", F.lit("conclusions")))
    return both.withColumn("gaps", F.col("attempts") - F.col("covered"))


@query("select run, kind as phase, min(a) as started, max(a + run_s * 1000000) as ended, count(*) as steps from steps where conclusion in ('success', 'failure') group by all")
def phase_boundaries(spark, d):
    rows = steps(spark, d).where("conclusion in ('success', 'failure')").select("run", F.col("kind").alias("phase"), "a", (F.col("a") + F.col("run_s") * 1_000_000).alias("e"))
    return rows.groupBy("run", "phase").agg(F.min("a").alias("started"), F.max("e").alias("ended"), F.count("*").alias("steps"))


@query("""with r as (select repo, workflow, count(*) as total from runs group by all), g as (select repo, workflow, count(distinct run) as ids, count(*) - count(distinct run) as duplicates from (select repo, workflow, run from runs where run % 50 <> 0 or repo = 'repo2' union all select repo, workflow, run from runs where run % 40 = 1) group by all)
    select r.repo, r.workflow, total, coalesce(ids, 0) as ids, coalesce(duplicates, 0) as duplicates, case when total > 620 then 'over-cap' when coalesce(ids, 0) < total then 'short' else 'ok' end as state from r left join g using (repo, workflow)""")
def window_reconciliation(spark, d):
    r = runs(spark, d).select("repo", "workflow", "run")
    got = r.where("run % 50 <> 0 or repo = 'repo2'").unionByName(r.where("run % 40 = 1"))
    return N.window_reconciliation(got, r.groupBy("repo", "workflow").agg(F.count("*").alias("total")), ["repo", "workflow"], "run", 620)


_JOURNAL = "j as (select run, id, id % 10 as item, case when kind in ('click', 'view') then 1 else -1 end as delta from jobs)"


@query(f"""with {_JOURNAL}, s as (select *, lag(delta, 1, -1) over (partition by run, item order by id) as was from j)
    select run, id, item, delta, cast(sum(case when delta <> was then delta else 0 end) over (partition by run order by id) as bigint) as live from s""")
def replay_journal(spark, d):
    rows = jobs(spark, d).select("run", "id", (F.col("id") % 10).alias("item"), F.when(F.col("kind").isin("click", "view"), 1).otherwise(-1).alias("delta"))
    return N.replay_journal(rows, ["run"], "id", "item", "delta")


@query("select run, id, max(a) over w as monotone, a < max(a) over w as uncertain from (select run, id, a from jobs) window w as (partition by run order by id)")
def clock_inversions(spark, d):
    return N.clock_inversions(jobs(spark, d).select("run", "id", "a"), ["run"], "id", "a").select("run", "id", "monotone", "uncertain")


_SAMPLES = f"""with c as (select run, a, max(value) as value from jobs where value is not null group by all), g as (select distinct run, unnest(range({LO}, {LO + 30 * DAY} + 1, {10 * MINUTE})) as tick from jobs)
    select g.run, g.tick, c.value from g asof left join c on c.run = g.run and c.a <= g.tick"""


@query(_SAMPLES)
def minute_samples(spark, d):
    return N.minute_samples(jobs(spark, d), ["run"], "a", "value", LO, LO + 30 * DAY, 10 * MINUTE)


@query(_SAMPLES)
def minute_samples_all(spark, d):
    return minute_samples(spark, d)


@query("""with g as (select run, min(n) as lo, max(n) as hi, count(*) as c, count(distinct n) as dn from steps group by run)
    select run, 'start' as violation from g where lo <> 1 union all select run, 'hole' from g where hi - lo + 1 <> dn union all select run, 'duplicate' from g where c <> dn""")
def journal_checks(spark, d):
    return N.journal_checks(steps(spark, d), ["run"], "n")


UNTIL = 820_000_000_000_000
_PLACE = ("n", "wait_s", "kind", "module")


def _kind():
    return F.when(F.col("kind") == "N", "approved").when(F.col("kind") == "R", "landed").otherwise("withdrawn")


@query(f"""with s as (select *, row_number() over (partition by run order by n, wait_s, kind, module) + 1 as id from steps), j as (select * from s where module % 41 <> 0), ids as (select run, id from j union all select run, 1 from runs where run % 5 <> 0),
    b as (select run, min(id) as lo, max(id) as hi, count(*) as c from ids group by run), inputs as (select run, id, module % 3 + (wait_s = 50)::int as number, module, wait_s from s where kind = 'N'),
    changes as (select run, id, kind, unnest(case when kind = 'R' then [module % 3, (module + 1) % 3] else [module % 3] end) as item from j), live as (select run, item from changes group by all having arg_max(kind, id) = 'N'),
    expected as (select run, number as item from inputs where wait_s < 25 union select run, wait_s % 3 from s where kind = 'A' and run_s % 2 = 1 and run % 2 = 0)
    select run, 'start' as violation, null::bigint as item from b where lo <> 1 union all select run, 'hole', null from b where hi - lo + 1 <> c union all select distinct run, 'repository', null from inputs where module % 43 = 0
    union all select coalesce(j.run, i.run), 'approval', coalesce(j.id, i.id) from (select * from j where kind = 'N') j full join inputs i on i.run = j.run and i.id = j.id where j.id is null or i.id is null or j.module % 3 <> i.number
    union all select b.run, 'window', null from b join runs r on r.run = b.run where r.run % 5 = 0 or r.run % 7 = 0 or r.created > {UNTIL} union all select coalesce(l.run, e.run), 'final-set', coalesce(l.item, e.item) from live l full join expected e on e.run = l.run and e.item = l.item where l.run is null or e.run is null""")
def journal_violations(spark, d):
    """A run as a queue, its steps as the journal: approvals, landings and withdrawals, with holes, foreign and differing inputs."""
    s = steps(spark, d).withColumn("id", F.row_number().over(Window.partitionBy("run").orderBy(*_PLACE)).cast("long") + 1).withColumn("number", (F.col("module") % 3).cast("long"))
    r = runs(spark, d)
    journal = s.where("module % 41 <> 0").select("run", "id", F.col("a").alias("at"), _kind().alias("kind"), F.col("id").alias("input_id"), "number", F.array("number", ((F.col("module") + 1) % 3).cast("long")).alias("members"))
    setting = r.where("run % 5 <> 0").select("run", F.lit(1).cast("long").alias("id"), F.col("created").alias("at"), F.lit("setting").alias("kind"), F.lit("publication_enabled").alias("key"), F.when(F.col("run") % 7 == 0, "false").otherwise("true").alias("value"))
    journal = journal.unionByName(setting, allowMissingColumns=True).withColumns({"withdrawn": F.lit(None).cast("array<long>"), "against_main": F.lit(None).cast("boolean")})
    inputs = s.where("kind = 'N'").select("run", "id", F.when(F.col("wait_s") == 50, F.col("number") + 1).otherwise(F.col("number")).alias("number"), F.when(F.col("module") % 43 == 0, "o/b").otherwise("o/a").alias("repository"), F.when(F.col("wait_s") < 25, "waiting").otherwise("landed").alias("state"))
    batches = r.select("run", F.col("run").alias("id"), F.when(F.col("run") % 2 == 0, "open").otherwise("landed").alias("state"), F.lit("o/a").alias("repository"))
    members = s.where("kind = 'A'").select("run", F.col("run").alias("batch_id"), (F.col("wait_s") % 3).alias("number"), (F.col("run_s") % 2 == 0).alias("removed"), F.lit(False).alias("withdrawn"))
    return N.journal_violations(journal, inputs, batches, N.expected_backlog(inputs, members, batches, ["run"]), ["run"], repository="o/a", until=UNTIL, captured=UNTIL)


_TICK = 30 * DAY


@query(f"""with x as (select run % 1000 as queue, row_number() over (partition by run % 1000 order by a + case when module % 50 = 0 then {40 * DAY} else 0 end, run, n, wait_s, kind, module) as id, a, kind, module from steps), y as (select *, max(a) over (partition by queue order by id rows unbounded preceding) as m from x),
    c as (select queue, id, m, case when kind = 'N' then 1 else -1 end as delta, unnest(case when kind = 'R' then [module % 7, (module + 1) % 7] else [module % 7] end) as item from y), w as (select *, lag(delta, 1, -1) over (partition by queue, item order by id) as was from c),
    p as (select queue, id, m, sum(case when delta <> was then delta else 0 end) as moved from w group by all), l as (select queue, id, m, sum(moved) over (partition by queue order by id rows unbounded preceding) as v from p), u as (select queue, m, arg_max(v, id) as v from l group by all),
    g as (select distinct queue, unnest(range({268 * _TICK}, {340 * _TICK} + 1, {_TICK})) as tick from x)
    select g.queue, g.tick, cast(coalesce(u.v, 0) as bigint) as waiting, not exists (select 1 from y where y.queue = g.queue and y.a < y.m and y.a <= g.tick and g.tick <= y.m) as complete from g asof left join u on u.queue = g.queue and u.m <= g.tick""")
def queue_samples(spark, d):
    """A thousand queues by steps in the order of their journal, in which some lag behind by 40 days."""
    s = steps(spark, d).withColumn("queue", F.col("run") % 1000)
    place = F.row_number().over(Window.partitionBy("queue").orderBy(F.col("a") + F.when(F.col("module") % 50 == 0, 40 * DAY).otherwise(0), "run", *_PLACE))
    journal = s.select("queue", place.cast("long").alias("id"), F.col("a").alias("at"), _kind().alias("kind"), (F.col("module") % 7).cast("long").alias("number"), F.array((F.col("module") % 7).cast("long"), ((F.col("module") + 1) % 7).cast("long")).alias("members"))
    journal = journal.withColumns({"withdrawn": F.lit(None).cast("array<long>"), "against_main": F.lit(None).cast("boolean")})
    return N.queue_samples(journal, ["queue"], 268 * _TICK, 340 * _TICK, _TICK)


@query("""with recursive l as (select run as parent, run * 2 as child from runs union all select run, run // 3 from runs where run % 3 = 0), n as (select run as node from runs where run <= 3 union select l.child from n join l on l.parent = n.node) select node from n""")
def reachable_set(spark, d):
    r = runs(spark, d).select("run")
    links = r.select(F.col("run").alias("parent"), (F.col("run") * 2).alias("child")).unionByName(r.where("run % 3 = 0").select(F.col("run").alias("parent"), F.expr("run div 3").alias("child")))
    return G.reachable_set(r.where("run <= 3").select(F.col("run").alias("node")), links, "node", "parent", "child")


_STATE = "case when kind = 'purchase' then 'completed' when kind = 'click' then 'in_progress' when kind = 'view' then 'waiting' else 'queued' end"
_LIVE = f"live as (select id, run % 20 as pool, {_STATE} as state, case when id % 17 <> 0 then a end as created, a + 1000000 as started, b as completed from jobs where a <= {CLOCK})"


def live(spark, d):
    state = F.when(F.col("kind") == "purchase", "completed").when(F.col("kind") == "click", "in_progress").when(F.col("kind") == "view", "waiting").otherwise("queued")
    return jobs(spark, d).where(f"a <= {CLOCK}").select("id", (F.col("run") % 20).alias("pool"), state.alias("state"), F.when(F.col("id") % 17 != 0, F.col("a")).alias("created"), (F.col("a") + 1_000_000).alias("started"), F.col("b").alias("completed"))


_STALE = f"coalesce(created // {HOUR} * {HOUR} + {HOUR} <= {CLOCK - DAY}, false)"
_WAITS = "state in ('queued', 'waiting', 'pending')"


@query(f"""with {_LIVE} select pool, count(*) filter (where state = 'in_progress') as running, count(*) filter (where {_WAITS}) as waiting, count(*) filter (where {_WAITS} and {_STALE}) as stale,
    arg_min(id, (started is not null, started, id)) filter (where state = 'in_progress') as oldest_running, arg_min(id, (created is not null, coalesce(created, 0), id)) filter (where {_WAITS} and not {_STALE}) as oldest_waiting,
    arg_min(id, (created is not null, coalesce(created, 0), id)) filter (where {_WAITS} and {_STALE}) as oldest_stale, max(completed) filter (where state = 'completed') as latest_completion from live group by pool""")
def pool_activity(spark, d):
    return A.pool_activity(live(spark, d), "pool", "state", "created", "started", "completed", "id", CLOCK)


@query(f"with {_LIVE} select id, {_WAITS} and {_STALE} as stale from live")
def stale_waiting(spark, d):
    return live(spark, d).select("id", (F.col("state").isin("queued", "waiting", "pending") & A.stale_waiting(F.col("created"), CLOCK)).alias("stale"))


@query(f"with {_LIVE} select pool, state, arg_min(id, (created is not null, coalesce(created, 0), id)) as oldest from live group by all")
def oldest_reference(spark, d):
    return live(spark, d).groupBy("pool", "state").agg(A.oldest_reference("id", "created", F.lit(True)).alias("oldest"))


def _activity(spark, d):
    """Every event up to the clock as a job of one of twenty pools."""
    i, done = F.col("id"), F.col("kind") == "purchase"
    result = F.get(F.array(*[F.lit(x) for x in ("success", "failure", "timed_out", "cancelled", "skipped", "odd")]), (i % 6).cast("int"))
    return jobs(spark, d).where(f"a <= {CLOCK}").select(
        "id", (F.col("run") % 20).alias("pool"), (i % 3 == 0).alias("build"), (~done).alias("active"), (F.col("kind") == "click").alias("running"), F.when(i % 17 != 0, F.col("a")).alias("created"), (F.col("a") + 1_000_000).alias("started"),
        F.when(done, F.col("a") + i % 7 * 600_000_000).alias("completed"), F.when(done, result).alias("result"), (i % 8).alias("part"),
    )


def _report(parts, clock):
    out = B.report(parts, clock)
    windows = F.array_join(F.transform("windows", lambda w: F.concat_ws(",", *[w[c].cast("string") for c in ("finished", *B.RESULTS)])), ";")
    return out.select("pool", "scope", "running", "waiting", "stale_waiting", "oldest_running", "oldest_waiting", "oldest_unknown", "oldest_stale_waiting", "latest_completion", windows.alias("windows"))


def _activity_sql(clock: int) -> str:
    through, results = clock // 60_000_000 * 60_000_000, ("success", "failure", "cancelled", "skipped", "other")
    stale = f"coalesce(created // {HOUR} * {HOUR} + {HOUR} <= {clock - DAY}, false)"
    counts = lambda w: " || ',' || ".join(["count(*) filter (where " + f"inside and completed // 60000000 * 60000000 >= {through - w} and completed // 60000000 * 60000000 < {through}" + (f" and result = '{r}'" if r else "") + ")" for r in (None, *results)])
    return f"""with j as (select id, run % 20 as pool, id % 3 = 0 as build, kind = 'click' as running, kind not in ('purchase', 'click') as waits, case when id % 17 <> 0 then a end as created, a + 1000000 as started, case when kind = 'purchase' then a + id % 7 * 600000000 end as completed,
        ['success', 'failure', 'failure', 'cancelled', 'skipped', 'other'][id % 6 + 1] as result from jobs where a <= {CLOCK}),
    s as (select 'all' as scope, * from j union all select 'builds', * from j where build),
    k as (select *, waits and row_number() over (partition by pool, scope, waits order by created is not null, created, id) <= 20 as named, {stale} as stale, completed <= {CLOCK} and completed >= {CLOCK // 60_000_000 * 60_000_000 - DAY} as inside from s)
    select pool, scope, count(*) filter (where running) as running, count(*) filter (where waits and not stale) as waiting, count(*) filter (where waits and stale) as stale_waiting, arg_min(id, (started, created is not null, coalesce(created, 0), id)) filter (where running) as oldest_running,
        arg_min(id, (created is not null, coalesce(created, 0), id)) filter (where named and not stale) as oldest_waiting, count(*) filter (where named and not stale) = 0 and count(*) filter (where waits and not stale) > 0 as oldest_unknown,
        arg_min(id, (created is not null, coalesce(created, 0), id)) filter (where named and stale) as oldest_stale_waiting, arg_min(id, (-completed, id)) filter (where completed <= {CLOCK}) as latest_completion,
        {" || ';' || ".join(f"({counts(w)})" for w in (HOUR, 3 * HOUR, DAY))} as windows from k group by pool, scope"""


@query(_activity_sql(CLOCK))
def activity_report(spark, d):
    """Both scopes of every pool from one partial each."""
    return _report(B.partials(_activity(spark, d), [], CLOCK), CLOCK)


@query(_activity_sql(CLOCK + 5 * HOUR))
def activity_merge(spark, d):
    """Partials of eight partitions, merged and read five hours later: what was live may be stale by then."""
    return _report(B.merged(B.partials(_activity(spark, d), ["part"], CLOCK)), CLOCK + 5 * HOUR)


_STATUSES = ["queued", "in_progress", "pending", "waiting", "requested", "completed", "odd"]


@query(f"""with t as (select run, 1 + id % 2 as attempt, kind <> 'purchase' as active, id % 29 = 0 as estimated, kind = 'click' and id % 13 <> 0 as in_progress, case when id % 17 <> 0 then a end as created, a from jobs),
    u as (select run, attempt, min(a) as created, max(a) as touched from t group by all union all select run, attempt, created, created from runs where not exists (select 1 from t where t.run = runs.run)),
    r as (select run, attempt, {_STATUSES!r}[run % 7 + 1] as status, run % 5 <> 0 as verified, run % 3 as category, created, touched from u),
    n as (select * from r where status <> 'completed' and attempt = (select max(attempt) from r o where o.run = r.run)),
    c as (select run, attempt, count(*) filter (where active) as active_jobs, count(*) filter (where active and not estimated) as actual, count(*) filter (where active and not estimated and in_progress) as running,
        count(*) filter (where active and not estimated and not in_progress and created > 0) as dated, max(created) filter (where active and not estimated and not in_progress) as latest from t group by all),
    m as (select n.*, coalesce(active_jobs, 0) as active_jobs, coalesce(actual, 0) as actual, coalesce(running, 0) as running, coalesce(dated, 0) as dated, latest from n left join c using (run, attempt)),
    s as (select *, case when status not in ('pending', 'waiting', 'requested') and verified and active_jobs = 0 and {CLOCK} - touched >= 5400000000 then 'stuck' when running > 0 then 'in_progress'
        when status in ('pending', 'waiting', 'requested') or status = 'in_progress' and actual > 0 then 'pending' when status = 'queued' then 'queued' when status = 'in_progress' then 'pending' else 'unconfirmed' end as state,
        case when status = 'queued' and actual = 0 then m.created when status in ('queued', 'in_progress') and running = 0 and actual > 0 and dated = actual then latest end as since from m),
    x as (select *, case when coalesce(since // {HOUR} * {HOUR} + {HOUR} <= {CLOCK - DAY}, false) then 'stale' else state end as final from s)
    select category, final as state, count(*) as n, min(created) as oldest, cast(sum(actual) as bigint) as jobs, cast(sum(running) as bigint) as running from x group by all""")
def workflow_backlog(spark, d):
    """Every run with its newest attempt, whatever its age: those of the jobs, and orders as runs that have no jobs (yet, or any more)."""
    t = jobs(spark, d).select(
        "run", (1 + F.col("id") % 2).alias("attempt"), (F.col("kind") != "purchase").alias("active"), (F.col("id") % 29 == 0).alias("estimated"),
        ((F.col("kind") == "click") & (F.col("id") % 13 != 0)).alias("in_progress"), F.when(F.col("id") % 17 != 0, F.col("a")).alias("created"), "a",
    )
    status = F.get(F.array(*[F.lit(x) for x in _STATUSES]), (F.col("run") % 7).cast("int"))
    u = t.groupBy("run", "attempt").agg(F.min("a").alias("created"), F.max("a").alias("updated"))
    u = u.unionByName(runs(spark, d).join(t.select("run").distinct(), "run", "left_anti").select("run", F.col("attempt").cast("long").alias("attempt"), "created", F.col("created").alias("updated")))
    r = u.select("run", "attempt", status.alias("status"), (F.col("run") % 5 != 0).alias("verified"), "created", "updated", F.col("created").alias("started"), (F.col("run") % 3).alias("category"))
    out = A.workflow_backlog(r, t, "category", CLOCK)
    return out.groupBy("category", "state").agg(F.count("*").alias("n"), F.min("created").alias("oldest"), F.sum("actual_jobs").alias("jobs"), F.sum("running_jobs").alias("running"))


@query("with p as (select repo, head % 8 as part, count(*) as n, sum(attempt) as attempts, case when repo = 'repo1' and head % 8 = 3 then null else repo <> 'repo2' or head % 8 <> 5 end as complete from runs group by all) select repo, cast(sum(n) as bigint) as n, cast(sum(attempts) as bigint) as attempts, case when bool_and(coalesce(complete, false)) then 'complete' else 'partial' end as coverage from p group by repo")
def merge_partitions(spark, d):
    part = F.col("head") % 8
    complete = F.when((F.col("repo") == "repo1") & (F.col("part") == 3), None).otherwise((F.col("repo") != "repo2") | (F.col("part") != 5))
    p = runs(spark, d).groupBy("repo", part.alias("part")).agg(F.count("*").alias("n"), F.sum("attempt").alias("attempts")).withColumn("complete", complete)
    return A.merge_partials(p, ["repo"], ["n", "attempts"], "complete")


@query(f"""with {_LIVE}, c as (select id, pool, case when state = 'in_progress' then 'active' when pool % 2 = 0 then 'builds' else 'others' end as cohort, completed from live),
    r as (select *, row_number() over (partition by cohort order by completed desc, id desc) as r, count(*) over (partition by cohort) as n from c)
    select id, cohort, n > case cohort when 'active' then 2000 when 'builds' then 150 else 50 end as truncated from r where r <= case cohort when 'active' then 2000 when 'builds' then 150 else 50 end""")
def recent_cohorts(spark, d):
    rows = live(spark, d).withColumn("klass", F.when(F.col("pool") % 2 == 0, "builds").otherwise("others"))
    out = A.recent_cohorts(rows, F.col("state") == "in_progress", "klass", [F.col("completed").desc(), F.col("id").desc()], {"builds": 150, "others": 50}, 2000)
    return out.select("id", "cohort", "truncated")


@query(f"with {_LIVE} select count(*) filter (where state = 'in_progress') as running, count(*) filter (where {_WAITS}) as queued, count(*) filter (where {_WAITS} and {_STALE}) as stale_queued, count(distinct case when {_WAITS} then pool end) as pending_pools from live")
def job_counts(spark, d):
    waits = F.col("state").isin("queued", "waiting", "pending")
    return live(spark, d).agg(F.count_if(F.col("state") == "in_progress").alias("running"), F.count_if(waits).alias("queued"), F.count_if(waits & A.stale_waiting(F.col("created"), CLOCK)).alias("stale_queued"), F.count_distinct(F.when(waits, F.col("pool"))).alias("pending_pools"))


@query("select run, repo, created from runs where conclusion = 'cancelled' union select run, repo, created from (select * from runs order by created desc, run desc limit 20)")
def queue_summary(spark, d):
    r = runs(spark, d)
    newest = r.orderBy(F.desc("created"), F.desc("run")).limit(20)
    return r.where("conclusion = 'cancelled'").select("run", "repo", "created").union(newest.select("run", "repo", "created")).distinct()


def _rollup_sql(step: int) -> str:
    return f"select run as host, a - a % {step} as bucket, count(*) as samples, count(*) filter (where id % 6 <> 0) as fresh, count(case when id % 6 <> 0 then value end) as n, round(sum(case when id % 6 <> 0 then value end), 4) as total, min(case when id % 6 <> 0 then value end) as least, max(case when id % 6 <> 0 then value end) as most, {step} as step from jobs group by all"


@query(f"{_rollup_sql(300_000_000)} union all {_rollup_sql(DAY)}")
def host_rollup(spark, d):
    rows = jobs(spark, d).withColumnRenamed("run", "host")
    levels = [A.host_rollup(rows, "host", "a", "value", F.col("id") % 6 != 0, s).withColumn("step", F.lit(s)) for s in (300_000_000, DAY)]
    return levels[0].unionByName(levels[1].withColumn("step", F.col("step").cast("long"))).withColumns({"total": F.round("total", 4), "step": F.col("step").cast("long")})


@query(f"select id, kind from jobs where a >= {CLOCK} - case kind when 'view' then {7 * DAY} when 'click' then {9 * DAY} else {15 * DAY} end and a <= {CLOCK}")
def host_retention(spark, d):
    return T.retention_filter(jobs(spark, d), "a", "kind", {"view": 7 * DAY, "click": 9 * DAY}, 15 * DAY, CLOCK).where(f"a <= {CLOCK}").select("id", "kind")


@query(f"select run as host, a - a % 300000000 as bucket, count(*) as samples, max(value) as most from jobs where a >= {CLOCK - 7 * DAY} and a < {CLOCK} group by all")
def host_history(spark, d):
    rows = jobs(spark, d).where(f"a >= {CLOCK - 7 * DAY} and a < {CLOCK}").withColumnRenamed("run", "host")
    return A.host_rollup(rows, "host", "a", "value", F.lit(True), 300_000_000).select("host", "bucket", "samples", "most").orderBy("host", "bucket")


@query("select run, created from runs order by created desc, run desc limit 25 offset 50")
def keyset_page(spark, d):
    return runs(spark, d).select("run", "created").orderBy(F.desc("created"), F.desc("run")).offset(50).limit(25)


@query("(select pr from runs where conclusion = 'failure' union select pr from runs where workflow = '1-URGENT') except select pr from runs where repo = 'repo1'")
def set_operations(spark, d):
    r = runs(spark, d)
    both = r.where("conclusion = 'failure'").select("pr").union(r.where("workflow = '1-URGENT'").select("pr")).distinct()
    return both.join(r.where("repo = 'repo1'").select("pr"), "pr", "left_anti")
