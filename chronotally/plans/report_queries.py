"""Queries that report on runs, jobs and observations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotally.functions import columns as C
from chronotally.operators import joins as J
from chronotally.operators import quantiles as Q
from chronotally.operators import reports as R
from chronotally.operators import sequence as S
from chronotally.plans.registry import jobs, query, read, runs, steps

DAY, HOUR = 86_400_000_000, 3_600_000_000
CLOCK = 1_706_000_000_000_000
_W = "round({p}, 9) as rate, round(greatest(0, ({p} + 1.96*1.96/(2*{n}) - 1.96*sqrt({p}*(1-{p})/{n} + 1.96*1.96/(4*{n}*{n})))/(1+1.96*1.96/{n})), 9) as low, round(least(1, ({p} + 1.96*1.96/(2*{n}) + 1.96*sqrt({p}*(1-{p})/{n} + 1.96*1.96/(4*{n}*{n})))/(1+1.96*1.96/{n})), 9) as high"


def _wilson_sql(k: str, n: str) -> str:
    return _W.format(p=f"({k}::double/{n})", n=f"{n}::double")


@query("select min(created) as first, max(created) as last, count(*) as n, count(*) filter (where conclusion = 'failure') as failed, count(*) filter (where pr % 3 = 0) as subset from runs")
def data_coverage(spark, d):
    return runs(spark, d).agg(F.min("created").alias("first"), F.max("created").alias("last"), F.count("*").alias("n"), F.count_if(F.col("conclusion") == "failure").alias("failed"), F.count_if(F.col("pr") % 3 == 0).alias("subset"))


@query(f"with c as (select repo, count(*) filter (where conclusion = 'failure') as failed, count(*) filter (where conclusion <> 'cancelled') as finished from runs group by repo) select *, {_wilson_sql('failed', 'finished')} from c")
def failure_rate(spark, d):
    return R.failure_rate(runs(spark, d), ["repo"], F.col("conclusion") == "failure", F.col("conclusion") != "cancelled")


@query(f"with c as (select head, count(*) filter (where conclusion = 'failure') as k, count(*) as n from runs group by head) select head, {_wilson_sql('k', 'n')} from c")
def wilson_interval(spark, d):
    rows = runs(spark, d).groupBy("head").agg(F.count_if(F.col("conclusion") == "failure").alias("k"), F.count("*").alias("n"))
    p, lo, hi = C.wilson(F.col("k"), F.col("n"))
    return rows.select("head", F.round(p, 9).alias("rate"), F.round(lo, 9).alias("low"), F.round(hi, 9).alias("high"))


@query("select kind, size, count(*) as n, round(count(*)::double / (select count(*) from steps where conclusion = 'failure'), 9) as share from steps where conclusion = 'failure' group by all")
def failures_by_class(spark, d):
    return R.share_of_total(steps(spark, d).where("conclusion = 'failure'"), ["kind", "size"])


@query(f"with c as (select case when price < 50000 then '<50k' when price < 150000 then '50k-149k' when price < 300000 then '150k-299k' else '300k+' end as size, count(*) filter (where conclusion = 'failure') as failed, count(*) filter (where conclusion <> 'cancelled') as finished from runs group by 1) select *, {_wilson_sql('failed', 'finished')} from c")
def failure_by_size(spark, d):
    size = C.labelled_ranges(F.col("price"), [0, 50_000, 150_000, 300_000], ["<50k", "50k-149k", "150k-299k", "300k+"])
    return R.failure_rate(runs(spark, d).withColumn("size", size), ["size"], F.col("conclusion") == "failure", F.col("conclusion") != "cancelled")


@query("""with x as (select head, conclusion, lead(conclusion) over (partition by head order by created, run) as next from runs)
    select count(*) as rebuilt, count(*) filter (where next = 'success') as passed, round(count(*) filter (where next = 'success')::double / count(*), 9) as share from x where conclusion = 'failure' and next is not null""")
def retry_flakiness(spark, d):
    rows = R.next_outcome(runs(spark, d), ["head"], ["created", "run"], "conclusion").where("conclusion = 'failure' and next_conclusion is not null")
    return rows.agg(F.count("*").alias("rebuilt"), F.count_if(F.col("next_conclusion") == "success").alias("passed")).withColumn("share", F.round(F.col("passed") / F.col("rebuilt"), 9))


@query(f"""with i as (select *, row_number() over (order by created, run) - 1 as ix from runs),
    p as (select conclusion, ix - lag(ix) over w as moved, lag(conclusion) over w as prev from i window w as (partition by pr order by created, run)),
    c as (select case when moved <= 10 then '1-10' when moved <= 50 then '11-50' when moved <= 200 then '51-200' else '>200' end as moved, count(*) filter (where conclusion = 'failure') as failed, count(*) as finished
      from p where prev = 'success' and conclusion <> 'cancelled' group by 1)
    select *, {_wilson_sql('failed', 'finished')} from c""")
def green_rebuild_risk(spark, d):
    rows = S.ordered_index(runs(spark, d), [F.col("created"), F.col("run")], "ix")
    rows = S.consecutive_pairs(rows, ["pr"], ["created", "run"], ["ix", "conclusion"]).where("prev_conclusion = 'success' and conclusion <> 'cancelled'")
    rows = rows.withColumn("moved", C.moved_bucket(F.col("ix") - F.col("prev_ix")))
    return R.failure_rate(rows, ["moved"], F.col("conclusion") == "failure", F.lit(True))


@query(f"""with i as (select *, row_number() over (order by created, run) - 1 as ix from runs),
    g as (select repo, conclusion, ix, max(case when conclusion = 'success' then ix end) over (partition by repo order by created, run rows between unbounded preceding and 1 preceding) as green from i),
    c as (select case when ix - green <= 10 then '0-10' when ix - green <= 50 then '11-50' when ix - green <= 200 then '51-200' else '>200' end as moved, count(*) filter (where conclusion = 'failure') as failed, count(*) as finished from g where green is not null and conclusion <> 'cancelled' group by 1)
    select *, {_wilson_sql('failed', 'finished')} from c""")
def queue_staleness_risk(spark, d):
    rows = S.ordered_index(runs(spark, d), [F.col("created"), F.col("run")], "ix")
    green = rows.where("conclusion = 'success'").select("repo", F.col("ix").alias("at"), F.col("ix").alias("green"))
    rows = J.asof_latest(rows, green, ["repo"], "ix", "at", "green", strict=True, slice_=10_000).withColumnRenamed("asof_green", "green")
    rows = rows.where("green is not null and conclusion <> 'cancelled'")
    return R.failure_rate(rows.withColumn("moved", C.moved_bucket(F.col("ix") - F.col("green"), "0-10")), ["moved"], F.col("conclusion") == "failure", F.lit(True))


@query("""with x as (select n, conclusion, coalesce(bool_or(conclusion = 'failure') over (partition by run order by n, wait_s, run_s, module rows between unbounded preceding and 1 preceding), false) as ahead from steps)
    select n as position, count(*) as builds, count(*) filter (where conclusion = 'failure' and not ahead) as own, count(*) filter (where conclusion = 'failure' and ahead) as cascade, round(count(*) filter (where conclusion = 'failure' and ahead)::double / count(*), 9) as rate from x group by n""")
def position_cascade(spark, d):
    before = Window.partitionBy("run").orderBy("n", "wait_s", "run_s", "module").rowsBetween(Window.unboundedPreceding, -1)
    rows = steps(spark, d).withColumn("ahead", F.coalesce(F.bool_or(F.col("conclusion") == "failure").over(before), F.lit(False)))
    failed = F.col("conclusion") == "failure"
    out = rows.groupBy(F.col("n").alias("position")).agg(F.count("*").alias("builds"), F.count_if(failed & ~F.col("ahead")).alias("own"), F.count_if(failed & F.col("ahead")).alias("cascade"))
    return out.withColumn("rate", F.round(F.col("cascade") / F.col("builds"), 9))


@query("with x as (select run_s, bool_or(conclusion = 'failure') over (partition by run order by n, wait_s, run_s, module rows between unbounded preceding and 1 preceding) as ahead from steps) select cast(sum(run_s) as bigint) as doomed_s, count(*) as n from x where ahead")
def cascade_cost(spark, d):
    before = Window.partitionBy("run").orderBy("n", "wait_s", "run_s", "module").rowsBetween(Window.unboundedPreceding, -1)
    rows = steps(spark, d).withColumn("ahead", F.bool_or(F.col("conclusion") == "failure").over(before)).where("ahead")
    return rows.agg(F.sum("run_s").alias("doomed_s"), F.count("*").alias("n"))


@query(f"with x as (select a // {DAY} as day, count(*) as n from jobs group by 1 having count(*) >= 20), r as (select n, row_number() over (order by n) as k, count(*) over () as c from x) select n / 24.0::double as per_hour from r where k = least(c, cast(floor(0.5::double * c) as bigint) + 1)")
def arrival_rate(spark, d):
    return R.daily_median(jobs(spark, d), F.expr(f"a div {DAY}"), 20).select((F.col("quantile") / F.lit(24.0)).alias("per_hour"))


@query("""with s as (select median(run_s) as variable, median(wait_s) as fixed, count(*) filter (where conclusion = 'failure')::double / count(*) as p from steps)
    select b as size, round((fixed + variable * b) / (b * pow(1 - p, b)), 6) as per_item from s, (values (1), (2), (4), (8)) v(b)""")
def batch_economics(spark, d):
    s = steps(spark, d).agg(F.median("run_s").alias("v"), F.median("wait_s").alias("f"), (F.count_if(F.col("conclusion") == "failure") / F.count("*")).alias("p"))
    s = s.withColumn("size", F.explode(F.array(*[F.lit(b) for b in (1, 2, 4, 8)])))
    return s.select("size", F.round((F.col("f") + F.col("v") * F.col("size")) / (F.col("size") * F.pow(1 - F.col("p"), F.col("size"))), 6).alias("per_item"))


_WEIGHTS = "w as (select kind, size, count(*) as total, count(*) filter (where run % 5 = 0) as fetched, count(*)::double / nullif(count(*) filter (where run % 5 = 0), 0) as weight from steps where conclusion <> 'cancelled' group by all)"


@query(f"with {_WEIGHTS} select * from w")
def sample_weights(spark, d):
    return R.sample_weights(steps(spark, d), ["kind", "size"], F.col("run") % 5 == 0, F.col("conclusion") == "cancelled")


@query(f"""with {_WEIGHTS}, x as (select s.kind, s.size, s.run_s * w.weight as weighted from steps s join w on w.kind = s.kind and w.size = s.size where s.run % 5 = 0 and s.conclusion <> 'cancelled'), t as (select sum(weighted) as t from x)
    select kind, size, round(sum(weighted), 3) as weighted_s, round(sum(weighted) / any_value(t), 9) as share from x, t group by all order by weighted_s desc, kind, size limit 12""")
def weighted_capacity(spark, d):
    s = steps(spark, d)
    w = R.sample_weights(s, ["kind", "size"], F.col("run") % 5 == 0, F.col("conclusion") == "cancelled").select("kind", "size", "weight")
    rows = s.where("run % 5 = 0 and conclusion <> 'cancelled'").join(w, ["kind", "size"]).groupBy("kind", "size").agg(F.sum(F.col("run_s") * F.col("weight")).alias("ws"))
    total = rows.agg(F.sum("ws").alias("_t"))
    out = rows.crossJoin(F.broadcast(total)).select("kind", "size", F.round("ws", 3).alias("weighted_s"), F.round(F.col("ws") / F.col("_t"), 9).alias("share"))
    return out.orderBy(F.desc("weighted_s"), "kind", "size").limit(12)


@query(f"""with r as (select a // {HOUR} as hour, value, row_number() over (partition by a // {HOUR} order by value) as k, count(*) over (partition by a // {HOUR}) as n from jobs)
    select hour, n as jobs, value as p90 from r where n >= 10 and k = least(n, cast(floor(0.9::double * n) as bigint) + 1) and value > 100""")
def saturated_hours(spark, d):
    rows = jobs(spark, d).withColumn("hour", F.expr(f"a div {HOUR}"))
    q = Q.report_quantile(rows, ["hour"], "value", 0.9).where("quantile > 100")
    return rows.groupBy("hour").agg(F.count("*").alias("jobs")).where("jobs >= 10").join(q, "hour").select("hour", "jobs", F.col("quantile").alias("p90"))


@query("""with c as (select run, cast(sum(run_s) as bigint) as s from steps group by run),
    m as (select r.workflow as engine, count(distinct s.module) as items from runs r join steps s on s.run = r.run where r.attempt <> 3 and r.conclusion = 'success' and s.size = 'O' group by 1),
    x as (select workflow as engine, 1 as runs, coalesce(s, 0) as v, 0 as p, (conclusion = 'failure')::int as f, (conclusion = 'cancelled')::int as c, 0 as items from runs left join c using (run) where attempt <> 3
      union all select case when repo <> 'repo4' then workflow end, 0, 0, coalesce(s, 0), 0, 0, 0 from runs left join c using (run) where attempt = 3 union all select engine, 0, 0, 0, 0, 0, items from m)
    select engine, cast(sum(runs) as bigint) as runs, cast(sum(items) as bigint) as items, cast(sum(v) as bigint) as validation_s, cast(sum(p) as bigint) as post_s, cast(sum(f) as bigint) as failed, cast(sum(c) as bigint) as cancelled, cast(sum(v) + sum(p) as bigint) as total_s, round((sum(v) + sum(p)) / nullif(sum(items), 0), 6) as per_item from x group by 1""")
def engine_cost(spark, d):
    """First and second attempts are validations, the modules of their open steps their members; third ones follow a merge."""
    members = steps(spark, d).where("size = 'O'").groupBy("run").agg(F.collect_set("module").alias("members"))
    r = runs(spark, d).withColumn("engine", F.col("workflow"))
    builds = r.where("attempt <> 3").join(members, "run", "left").select("run", "engine", (F.col("conclusion") == "success").alias("landed"), "conclusion", "members")
    post = r.where("attempt = 3").select("run", F.when(F.col("repo") != "repo4", F.col("engine")).alias("engine"))
    return R.engine_costs(builds, post, steps(spark, d).select("run", "run_s"), ["run"]).withColumn("per_item", F.round("per_item", 6))


@query("""select cast(sum(case when r.workflow is null then run_s end) as bigint) as unknown_s, cast(sum(case when r.workflow = '5-LOW' then run_s end) as bigint) as ordinary_s,
    (select count(*) from runs where run not in (select run from steps)) as unfetched from steps s left join (select * from runs where run % 10 <> 0) r on r.run = s.run""")
def unattributed_cost(spark, d):
    s, r = steps(spark, d), runs(spark, d)
    rows = s.join(r.where("run % 10 <> 0").select("run", "workflow"), "run", "left")
    sums = rows.agg(F.sum(F.when(F.col("workflow").isNull(), F.col("run_s"))).alias("unknown_s"), F.sum(F.when(F.col("workflow") == "5-LOW", F.col("run_s"))).alias("ordinary_s"))
    return sums.crossJoin(r.join(s.select("run").distinct(), "run", "left_anti").agg(F.count("*").alias("unfetched")))  # one row each


@query("select coalesce(case when run % 10 <> 0 then kind end, 'unknown') as kind, coalesce(case when run % 7 <> 0 then size end, 'unknown') as size, count(*) as jobs, cast(sum(run_s) as bigint) as seconds from steps group by 1, 2")
def runner_breakdown(spark, d):
    unknown = lambda c, m: F.coalesce(F.when(F.col("run") % m != 0, F.col(c)), F.lit("unknown"))
    return steps(spark, d).groupBy(unknown("kind", 10).alias("kind"), unknown("size", 7).alias("size")).agg(F.count("*").alias("jobs"), F.sum("run_s").alias("seconds"))


@query("""select event_type as kind, k as counter, cast(sum(cast(props ->> ('$."' || k || '"') as bigint)) as bigint) as total from events, unnest(json_keys(props)) as g(k) group by all""")
def map_counters(spark, d):
    rows = read(spark, d, "events").select(F.col("event_type").alias("kind"), F.explode(F.from_json("props", T.MapType(T.StringType(), T.LongType()))).alias("counter", "v"))
    return rows.groupBy("kind", "counter").agg(F.sum("v").alias("total"))


@query("""with j as (select run, string_agg(distinct case when wait_s % 5 = 0 then kind else size end, ',' order by case when wait_s % 5 = 0 then kind else size end) as sizes, sum(wait_s) as cpu, max(run_s) as rss, count(*) as n from steps group by run),
    a as (select workflow, conclusion, coalesce(sizes, 'unknown') as sizes, run % 4 <> 0 and attempt <> 2 as there, run % 4 <> 0 and n is not null as seen, run % 6 <> 0 as whole, run, cpu, rss, n from runs left join j using (run)),
    o as (select workflow, conclusion, sizes, there, there and seen and run % 10 = 0 as partial, there and not (seen and whole) as incomplete, case when seen then n else 0 end as samples, case when seen and whole and run % 9 <> 0 then cpu + 1.5 end as cpu, case when seen and whole then rss end as rss, case when seen then 0.5 end as sampler, case when seen then (run % 100) / 100.0 end as busy from a)
    select workflow, conclusion, sizes, count(*) as attempts, count(*) filter (where there) as covered, count(*) filter (where partial) as partial, count(*) filter (where incomplete) as incomplete, cast(sum(samples) as bigint) as samples, sum(cpu)::double as cpu_s, max(rss)::double as rss_bytes, sum(sampler)::double as sampler_s,
      (list_sort(list(busy) filter (where busy is not null))[least(count(busy) - 1, count(busy) // 2) + 1])::double as busy from o group by all""")
def resource_cohorts(spark, d):
    """Runs with what their steps used as the payload of an observation; some are missing, expired, of another scope or negative."""
    j = steps(spark, d)
    used = j.groupBy("run").agg(F.sum("wait_s").alias("cpu"), F.max("run_s").alias("rss"), F.count("*").alias("n"))
    i, text = F.col("run"), lambda c: c.cast("string")
    payload = F.concat(
        F.lit('{"command_accounting_scope":"'), F.when(i % 6 == 0, "shell").otherwise("reaped-descendants"), F.lit('","command_cpu_user_s":'), text(F.when(i % 9 == 0, -1).otherwise(F.col("cpu"))), F.lit(',"command_cpu_system_s":1.5,"command_max_process_rss_bytes":'), text(F.col("rss")), F.lit(',"samples":'), text(F.col("n")),
        F.lit(',"sampler_cpu_s":0.5,"host_cpu_busy_fraction":'), text(i % 100 / 100), F.lit(',"missing":'), F.when(i % 10 == 0, '["load"]').otherwise("[]"), F.lit("}"),
    )
    seen = runs(spark, d).where("run % 4 <> 0").join(used, "run", "left").select("run", F.when(F.col("attempt") == 2, "expired").otherwise("present").alias("coverage"), payload.alias("payload"))
    sizes = j.select("run", F.when(F.col("wait_s") % 5 == 0, "").otherwise(F.col("size")).alias("runner_size"), F.col("kind").alias("runner_kind"))
    return R.resource_cohorts(runs(spark, d), sizes, seen, ["run"], ["workflow", "conclusion"])


@query("""select k.kind, coalesce(case when s.run is null then null when s.wait_s > 40 then 'present' else 'expired' end, 'missing') as coverage, count(*) as attempts from runs r cross join (values ('A'), ('N'), ('R')) k(kind)
    left join (select run, kind, max(wait_s) as wait_s from steps group by all) s on s.run = r.run and s.kind = k.kind group by all""")
def coverage_counts(spark, d):
    wanted = runs(spark, d).select("run", F.explode(F.array(*[F.lit(k) for k in "ANR"])).alias("kind"))
    seen = steps(spark, d).groupBy("run", "kind").agg(F.max("wait_s").alias("w"))
    coverage = F.when(F.col("w").isNull(), "missing").when(F.col("w") > 40, "present").otherwise("expired")
    return wanted.join(seen, ["run", "kind"], "left").groupBy("kind", coverage.alias("coverage")).agg(F.count("*").alias("attempts"))


@query("""select kind, size as inner_key, cast(sum(t) as bigint) as total, max(m) as peak from (select run, kind, size, sum(run_s) as t, max(run_s) as m from steps group by all) group by all""")
def nested_counters(spark, d):
    return steps(spark, d).groupBy("kind", F.col("size").alias("inner_key")).agg(F.sum("run_s").alias("total"), F.max("run_s").alias("peak"))


@query("select count(*) filter (where conclusion = 'success') as complete, count(*) filter (where conclusion = 'success' and pr % 2 = 0) as confirmed, cast(sum(case when conclusion = 'success' then head end) as bigint) as bytes, count(distinct case when conclusion = 'success' then head end) as objects from runs")
def publication_totals(spark, d):
    ok = F.col("conclusion") == "success"
    return runs(spark, d).agg(F.count_if(ok).alias("complete"), F.count_if(ok & (F.col("pr") % 2 == 0)).alias("confirmed"), F.sum(F.when(ok, F.col("head"))).alias("bytes"), F.count_distinct(F.when(ok, F.col("head"))).alias("objects"))


@query("select n as phase, count(*) as n, cast(sum(run_s) as bigint) as seconds from steps group by 1")
def phase_totals(spark, d):
    return steps(spark, d).groupBy(F.col("n").alias("phase")).agg(F.count("*").alias("n"), F.sum("run_s").alias("seconds"))


@query("select coalesce(case when run % 4 <> 0 then conclusion end, 'historical-unknown') as state, count(*) as jobs, cast(sum(wait_s) as bigint) as wait_s, cast(sum(run_s) as bigint) as run_s from steps group by 1")
def state_totals(spark, d):
    state = F.coalesce(F.when(F.col("run") % 4 != 0, F.col("conclusion")), F.lit("historical-unknown"))
    return steps(spark, d).groupBy(state.alias("state")).agg(F.count("*").alias("jobs"), F.sum("wait_s").alias("wait_s"), F.sum("run_s").alias("run_s"))


@query("select cast(sum(case when attempt > 1 then run_s end) as bigint) as retry_s, cast(sum(case when s.conclusion <> 'success' then run_s end) as bigint) as failed_s, cast(sum(case when s.conclusion = 'success' and r.conclusion <> 'success' then run_s end) as bigint) as unlanded_s from steps s join runs r using (run)")
def overlap_cost_categories(spark, d):
    rows = steps(spark, d).join(runs(spark, d).select("run", "attempt", F.col("conclusion").alias("rc")), "run")
    total = lambda c: F.sum(F.when(c, F.col("run_s")))
    return rows.agg(total(F.col("attempt") > 1).alias("retry_s"), total(F.col("conclusion") != "success").alias("failed_s"), total((F.col("conclusion") == "success") & (F.col("rc") != "success")).alias("unlanded_s"))


@query(f"select day, count(*) as n from (select pr, min(created) // {DAY} as day from runs where conclusion = 'success' group by pr) group by day")
def first_seen_throughput(spark, d):
    first = runs(spark, d).where("conclusion = 'success'").groupBy("pr").agg(F.expr(f"min(created) div {DAY}").alias("day"))
    return first.groupBy("day").agg(F.count("*").alias("n"))


@query("select count(*) filter (where r.run is null) as no_run, count(distinct case when r.run is null then s.run end) as runs_unknown, count(*) filter (where s.run % 9 = 0) as no_engine from steps s left join (select run from runs where run % 6 <> 0) r using (run)")
def missing_metadata_counts(spark, d):
    known = runs(spark, d).where("run % 6 <> 0").select(F.col("run").alias("_r"))
    rows = steps(spark, d).join(known, F.col("run") == F.col("_r"), "left")
    return rows.agg(F.count_if(F.col("_r").isNull()).alias("no_run"), F.count_distinct(F.when(F.col("_r").isNull(), F.col("run"))).alias("runs_unknown"), F.count_if(F.col("run") % 9 == 0).alias("no_engine"))


@query(f"select kind, case when b > {CLOCK} then 'running' else 'queued' end as state, count(*) as n from jobs where a <= {CLOCK} group by all")
def current_counts(spark, d):
    state = F.when(F.col("b") > CLOCK, "running").otherwise("queued")
    return jobs(spark, d).where(f"a <= {CLOCK}").groupBy("kind", state.alias("state")).agg(F.count("*").alias("n"))


@query("select count(*) as items, bool_and(known) as complete from (select item, bool_and(known) as known from (select pr as item, true as known from runs where conclusion = 'cancelled' union all select s.module as item, r.run is not null from steps s left join runs r on r.run = s.run and r.attempt = 1 + s.n % 3 where s.conclusion = 'cancelled') group by item)")
def distinct_backlog(spark, d):
    waiting = runs(spark, d).where("conclusion = 'cancelled'").select(F.col("pr").alias("item"), F.lit(True).alias("known"))
    versions = runs(spark, d).select("run", F.col("attempt").alias("version"), F.lit(True).alias("hit"))
    members = steps(spark, d).where("conclusion = 'cancelled'").select("run", (1 + F.col("n") % 3).alias("version"), F.col("module").alias("item"))
    current = members.join(versions, ["run", "version"], "left").select("item", F.col("hit").isNotNull().alias("known"))
    items = waiting.unionByName(current).groupBy("item").agg(F.bool_and("known").alias("known"))
    return items.agg(F.count("*").alias("items"), F.bool_and("known").alias("complete"))


@query("""with t as (select run, count(*) filter (where conclusion <> 'cancelled') as active, count(*) filter (where conclusion = 'cancelled') as removed, max(n) as declared, list(distinct n order by n) filter (where conclusion = 'failure') as open from steps group by run)
    select run, active, removed, active + removed = declared as complete, coalesce(array_to_string(open[1:10], ','), '') as first_open from t""")
def batch_rollup(spark, d):
    failed = F.array_sort(F.collect_set(F.when(F.col("conclusion") == "failure", F.col("n"))))
    t = steps(spark, d).groupBy("run").agg(F.count_if(F.col("conclusion") != "cancelled").alias("active"), F.count_if(F.col("conclusion") == "cancelled").alias("removed"), F.max("n").alias("declared"), failed.alias("open"))
    return t.select("run", "active", "removed", (F.col("active") + F.col("removed") == F.col("declared")).alias("complete"), F.array_join(F.slice("open", 1, 10), ",").alias("first_open"))


@query("select pr % 64 as bucket, pr, count(*) as n, string_agg(run::varchar, ',' order by run) as runs from runs group by 1, 2")
def pr_index(spark, d):
    out = runs(spark, d).groupBy(F.pmod("pr", F.lit(64)).alias("bucket"), "pr").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("run")).alias("runs"))
    return out.withColumn("runs", F.array_join("runs", ","))


@query("select kind, size, count(*) filter (where conclusion <> 'failure' or n > 1) as successes, case when count(case when conclusion <> 'failure' or n > 1 then case when wait_s > 1 then wait_s end end) = count(*) filter (where conclusion <> 'failure' or n > 1) then median(case when conclusion <> 'failure' or n > 1 then wait_s end)::double end as median from steps group by all")
def group_medians(spark, d):
    rows = steps(spark, d).withColumn("wait_s", F.when(F.col("wait_s") > 1, F.col("wait_s")))
    return R.group_medians(rows, ["kind", "size"], "wait_s", (F.col("conclusion") != "failure") | (F.col("n") > 1))


@query("with m as (select n, kind as shape, avg(run_s)::double as v from steps group by all), b as (select n, v as base from m where shape = 'A') select m.n, shape, round(v, 6) as v, round(base, 6) as base, round(1 - v / base, 9) as reduction, round(base / v, 9) as ratio from m left join b using (n) where shape <> 'A'")
def baseline_compare(spark, d):
    rows = steps(spark, d).groupBy("n", F.col("kind").alias("shape")).agg(F.avg("run_s").alias("v"))
    return R.baseline_compare(rows, ["n"], "shape", "v", "A").withColumns({"v": F.round("v", 6), "base": F.round("base", 6)})


@query("""with x as (select run, n, case when n % 7 <> 0 then size end as identity, conclusion <> 'failure' as ok from steps)
    select run, n, (count(distinct case when ok then identity end) over (partition by run) = 1) and coalesce(max(case when ok then (identity is null)::int end) over (partition by run), 0) = 0 as comparable from x""")
def drift_invalidate(spark, d):
    rows = steps(spark, d).withColumn("identity", F.when(F.col("n") % 7 != 0, F.col("size")))
    return R.drift_invalidate(rows, ["run"], "identity", F.col("conclusion") != "failure").select("run", "n", "comparable")


@query("""with s as (select n, kind, wait_s::double as x, run_s::double as y from steps where conclusion <> 'failure'),
    f as (select n, kind, count(*) as c, min(x) as lo, max(x) as hi, sum(x) as sx, sum(y) as sy, sum(x * x) as sxx, sum(x * y) as sxy from s group by all),
    b as (select *, case when c >= 3 and lo < hi then greatest((c * sxy - sx * sy) / (c * sxx - sx * sx), 0) end as b from f)
    select n, kind, c as rows, case when b is not null then round(greatest((sy - b * sx) / c, 1), 9) else 1 end as intercept, case when b is not null then round(b, 9) else 0 end as slope from b""")
def linear_fit(spark, d):
    rows = steps(spark, d).where("conclusion <> 'failure'").withColumnRenamed("n", "k")
    out = R.linear_fit(rows, ["k", "kind"], "wait_s", "run_s")
    return out.select(F.col("k").alias("n"), "kind", F.col("n").alias("rows"), "intercept", "slope")


@query(f"select count(*) as runs, count(*) filter (where c is null) as missing, cast(sum(s) as bigint) as seconds, count(distinct case when conclusion = 'success' then pr end) as accepted, min(created) <= 788918400000000 as covered from runs left join (select run, count(*) as c, sum(run_s) as s from steps group by run) using (run)")
def observed_baseline(spark, d):
    cost = steps(spark, d).groupBy("run").agg(F.count("*").alias("c"), F.sum("run_s").alias("s"))
    rows = runs(spark, d).join(cost, "run", "left")
    return rows.agg(F.count("*").alias("runs"), F.count_if(F.col("c").isNull()).alias("missing"), F.sum("s").alias("seconds"), F.count_distinct(F.when(F.col("conclusion") == "success", F.col("pr"))).alias("accepted"), (F.min("created") <= 788_918_400_000_000).alias("covered"))


@query("""with m as (select distinct pr, r.run, s.module % 50 as m from runs r left join steps s on s.run = r.run and s.module % 7 <> 0), f as (select pr, run, m, row_number() over (partition by pr, m order by run) as k from m),
    o as (select pr, run, count(m) as n, count(*) filter (where k > 1 and m is not null) as shared from f group by all),
    w as (select r.run, coalesce(sum(wait_s), 0) as w, any_value(head) as behind, bool_or(coalesce(s.kind, '') = 'R' and s.module % 40 = 0) as dep from runs r left join steps s on s.run = r.run group by r.run),
    x as (select pr, run, w * (1 - 0.5::double * coalesce(shared / nullif(n, 0)::double, 0)) * (1 + least(behind, 500) / 500.0::double) as work, dep from o join w using (run))
    select pr, count(*) as members, round(sum(work), 6) as work, round((600 + 2 * sum(work)) * case when bool_or(dep) then 3 else 1 end, 6) as cost from x group by pr""")
def group_overlap_cost(spark, d):
    """Members without modules are among them: every run of a group counts."""
    own = steps(spark, d).groupBy("run").agg(F.collect_set(F.when(F.col("module") % 7 != 0, F.col("module") % 50)).alias("modules"), F.sum("wait_s").alias("w"), F.bool_or((F.col("kind") == "R") & (F.col("module") % 40 == 0)).alias("dep"))
    rows = runs(spark, d).select("run", "pr", F.col("head").alias("behind")).join(own, "run", "left").withColumn("w", F.coalesce("w", F.lit(0)))
    return R.group_overlap_cost(rows, "pr", "run", "modules", "w", behind="behind", dependency="dep", fixed=600, per_work=2, multiplier=3)


@query("select coalesce(case when pr % 3 = 0 then pr end, -run) as unit, max(created) as bound, bool_and(conclusion = 'success') as ready, count(*) as members from runs group by 1")
def atomic_units(spark, d):
    unit = F.coalesce(F.when(F.col("pr") % 3 == 0, F.col("pr")), -F.col("run"))
    return runs(spark, d).groupBy(unit.alias("unit")).agg(F.max("created").alias("bound"), F.bool_and(F.col("conclusion") == "success").alias("ready"), F.count("*").alias("members"))


@query("""with f as (select repo, max_by(head, (created, run)) as estimate, max_by(run, (created, run)) as source from runs where conclusion = 'success' group by repo)
    select r.run, r.head as done, case when f.estimate > r.head and f.source <> r.run then f.estimate end as estimate from runs r left join f using (repo) where r.conclusion = 'cancelled'""")
def finished_estimate(spark, d):
    r = runs(spark, d)
    last = r.where("conclusion = 'success'").groupBy("repo").agg(F.max_by("head", F.struct("created", "run")).alias("e"), F.max_by("run", F.struct("created", "run")).alias("s"))
    rows = r.where("conclusion = 'cancelled'").join(last, "repo", "left")
    return rows.select("run", F.col("head").alias("done"), F.when((F.col("e") > F.col("head")) & (F.col("s") != F.col("run")), F.col("e")).alias("estimate"))


@query("select workflow as kind, count(*) as pending, min(created) as oldest_due, min(run) as oldest_admission from runs where conclusion = 'cancelled' group by 1")
def health_by_kind(spark, d):
    return runs(spark, d).where("conclusion = 'cancelled'").groupBy(F.col("workflow").alias("kind")).agg(F.count("*").alias("pending"), F.min("created").alias("oldest_due"), F.min("run").alias("oldest_admission"))


@query(f"with g as (select run, min(b) as lo, max(b) as hi, bool_or(kind = 'error') as bad from jobs group by run) select run, case when bad and hi < {CLOCK} then 'stale' when hi < {CLOCK} + {3 * DAY} then 'pending' else 'updated' end as status, hi - lo as spread from g")
def group_status(spark, d):
    g = jobs(spark, d).groupBy("run").agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.bool_or(F.col("kind") == "error").alias("bad"))
    status = F.when(F.col("bad") & (F.col("hi") < CLOCK), "stale").when(F.col("hi") < CLOCK + 3 * DAY, "pending").otherwise("updated")
    return g.select("run", status.alias("status"), (F.col("hi") - F.col("lo")).alias("spread"))


@query("select repo, count(*) as attempted, count(*) filter (where c > 0) as recorded, count(*) filter (where coalesce(c, 0) = 0) as gaps, cast(sum(coalesce(f, 0)) as bigint) as failures from runs left join (select run, count(*) as c, count(*) filter (where conclusion = 'failure') as f from steps group by run) using (run) group by repo")
def receipt_summary(spark, d):
    s = steps(spark, d).groupBy("run").agg(F.count_if(F.col("conclusion") == "failure").alias("failed"))
    rows = runs(spark, d).join(s, "run", "left")
    recorded = F.col("failed").isNotNull()
    return rows.groupBy("repo").agg(F.count("*").alias("attempted"), F.count_if(recorded).alias("recorded"), F.count_if(~recorded).alias("gaps"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failures"))
