"""Queries on reversible metrics, daily measures and chart series."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronotally.functions import columns as C
from chronotally.operators import metrics as M
from chronotally.plans.registry import jobs, query, runs, steps

STEP, DAY, HOUR = 7_200_000_000, 86_400_000_000, 3_600_000_000


def work(spark, d):
    """Events as jobs with creation, start, end, outcome, assignment and weight."""
    j = jobs(spark, d)
    conclusion = F.when(F.col("id") % 5 == 0, "failure").when(F.col("id") % 7 == 0, "cancelled").when(F.col("id") % 11 == 0, "timed_out").otherwise("success")
    return j.select("id", "run", "kind", conclusion.alias("conclusion"), F.col("a").alias("created"), (F.col("a") + F.col("id") % 900 * 1_000_000).alias("started"), (F.col("a") + F.col("id") % 900 * 1_000_000 + F.expr("(b - a) div 2")).alias("ended"), (F.col("id") % 13 != 0).alias("assigned"), (1 + F.col("id") % 2).alias("weight"))


_WORK = """work as (select id, run, kind, case when id % 5 = 0 then 'failure' when id % 7 = 0 then 'cancelled' when id % 11 = 0 then 'timed_out' else 'success' end as conclusion,
    a as created, a + id % 900 * 1000000 as started, a + id % 900 * 1000000 + (b - a) // 2 as ended, id % 13 <> 0 as assigned, 1 + id % 2 as weight from jobs)"""
_DAY = "make_date(1970, 1, 1) + cast({} // 86400000000 as integer)"
_METRICS = f"""rows as (
    select id, {_DAY.format('created')} as day, null::bigint as bucket, 'jobs/' || kind as metric, 0.0::double as value, weight::double as amount from work
    union all select id, {_DAY.format('created')}, null, 'finished/' || kind, 0.0, weight from work where conclusion in ('success', 'failure', 'timed_out')
    union all select id, {_DAY.format('created')}, null, 'failure/' || kind, 0.0, weight from work where conclusion in ('failure', 'timed_out')
    union all select id, {_DAY.format('created')}, null, 'wait/' || kind, (started - created) / 1000000.0::double, weight from work where assigned
    union all select id, {_DAY.format('created')}, null, 'duration/' || kind, (ended - started) / 1000000.0::double, weight from work where assigned
    union all select id, {_DAY.format('created')}, null, 'minutes/' || kind, 0.0, (ended - started) / 1000000.0::double / 60 * weight from work where assigned
    union all select id, {_DAY.format('bucket')}, bucket, 'running/' || kind, 0.0, (least(ended, bucket + {STEP}) - greatest(started, bucket)) / {STEP}.0::double * weight from work, unnest(range(started - started % {STEP}, ended, {STEP})) g(bucket) where assigned and ended > started
    union all select id, {_DAY.format('bucket')}, bucket, 'queued/' || kind, 0.0, (least(until, bucket + {STEP}) - greatest(created, bucket)) / {STEP}.0::double * weight from (select *, case when assigned then started else ended end as until from work), unnest(range(created - created % {STEP}, until, {STEP})) g(bucket) where until > created)"""
_ROUND = "round(sum(amount), 6) as amount"


def _rounded(df):
    return df.withColumn("amount", F.round("amount", 6))


@query(f"with {_WORK}, {_METRICS} select day, bucket, metric, value, {_ROUND} from rows group by all")
def contributions(spark, d):
    return _rounded(M.summed(M.contributions(work(spark, d), step=STEP)))


@query(f"with {_WORK}, {_METRICS} select day, bucket, metric, value, {_ROUND} from (select * from rows where id % 3 = 0 union all select id, day, bucket, metric, value, -amount from rows where id % 4 = 0) group by all having abs(sum(amount)) >= 1e-9")
def diff_contributions(spark, d):
    rows = M.contributions(work(spark, d), step=STEP, keep=["id"])
    return _rounded(M.diff_contributions(rows.where("id % 4 = 0"), rows.where("id % 3 = 0")))


@query(f"with {_WORK}, {_METRICS} select day, bucket, metric, value, {_ROUND} from rows where id % 2 = 0 or id % 10 = 1 group by all having abs(sum(amount)) >= 1e-9")
def apply_deltas(spark, d):
    rows = M.contributions(work(spark, d), step=STEP, keep=["id"])
    deltas = rows.where("id % 10 = 1").withColumn("receipt", F.floor(F.col("id") / 100))  # several rows of one key in a receipt
    twice = deltas.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    return _rounded(M.apply_deltas(M.summed(rows.where("id % 2 = 0")), twice, "receipt", "delivery"))


_FIX = "select id, day, bucket, split_part(metric, '/', 1) || '/' as p, metric, value, amount from rows where id % 20 = 0 and metric not like '%/click'"


@query(f"with {_WORK}, {_METRICS}, f as ({_FIX}) select day, bucket, metric, value, {_ROUND} from (select day, bucket, p || 'click' as metric, value, amount from f union all select day, bucket, metric, value, -amount from f) group by all having abs(sum(amount)) >= 1e-9")
def recompute_dimension(spark, d):
    rows = work(spark, d).withColumn("fixed", F.when(F.col("id") % 20 == 0, "click").otherwise(F.col("kind"))).withColumnRenamed("kind", "was")
    return _rounded(M.recompute_dimension(rows, "was", "fixed", step=STEP))


@query(f"with {_WORK} select {_DAY.format('created')} as day, kind, count(*) as jobs, round(sum(ended - started) / 6e7, 6) as minutes, count(*) filter (where conclusion = 'failure') as failed from work group by all")
def dirty_recompute(spark, d):
    rows = work(spark, d).withColumn("day", C.utc_day(F.col("created")))
    derive = lambda f: f.groupBy("day", "kind").agg(F.count("*").alias("jobs"), F.round(F.sum(F.col("ended") - F.col("started")) / 6e7, 6).alias("minutes"), F.count_if(F.col("conclusion") == "failure").alias("failed"))
    stale = derive(rows.where("id % 50 <> 0"))
    return M.dirty_recompute(stale, rows, rows.where("id % 50 = 0").select("day", "kind"), derive, ["day", "kind"])


_DAILY = f"""with {_WORK}, {_METRICS}, s as (select day, metric, value, sum(amount) as w from rows where metric like 'wait/%' or metric like 'duration/%' group by all),
    r as (select *, sum(w) over (partition by day, metric order by value) as run, sum(w) over (partition by day, metric) as total from s)"""


@query(f"{_DAILY} select day, metric, max(total) as total, min(value) filter (where run >= greatest(1, ceil(total * 0.5))) as median, min(value) filter (where run >= greatest(1, ceil(total * 0.9))) as p90 from r group by all")
def day_summary(spark, d):
    return M.day_summary(M.contributions(work(spark, d), step=STEP), ["wait", "duration"])


@query(f"with {_WORK}, {_METRICS} select day, metric, {_ROUND} from rows where bucket is null group by all")
def daily_measures(spark, d):
    rows = M.contributions(work(spark, d), step=STEP).where("bucket is null")
    return rows.groupBy("day", "metric").agg(F.round(F.sum("amount"), 6).alias("amount"))


@query(f"with {_WORK}, {_METRICS} select day, round(sum(amount) filter (where metric like 'minutes/%'), 6) as minutes, round(sum(amount) filter (where metric like 'jobs/%'), 6) as jobs, round(sum(amount) filter (where metric = 'finished/purchase'), 6) as landed from rows where bucket is null group by day")
def compact_day(spark, d):
    rows = M.contributions(work(spark, d), step=STEP).where("bucket is null")
    total = lambda p, n: F.round(F.sum(F.when(F.col("metric").like(p), F.col("amount"))), 6).alias(n)
    return rows.groupBy("day").agg(total("minutes/%", "minutes"), total("jobs/%", "jobs"), total("finished/purchase", "landed"))


@query(f"with {_WORK}, {_METRICS} select day, round(coalesce(sum(amount) filter (where metric like 'failure/%'), 0) / nullif(sum(amount) filter (where metric like 'finished/%'), 0), 9) as rate from rows where bucket is null group by day")
def failure_rate_series(spark, d):
    rows = M.contributions(work(spark, d), step=STEP).where("bucket is null")
    total = lambda p: F.sum(F.when(F.col("metric").like(p), F.col("amount")))
    return rows.groupBy("day").agg(F.round(F.try_divide(F.coalesce(total("failure/%"), F.lit(0.0)), total("finished/%")), 9).alias("rate"))


@query(f"with {_WORK} select {_DAY.format('created')} as day, round(sum(case when run % 2 = 0 then weight end)::double / sum(weight), 9) as share from work group by 1")
def picker_share(spark, d):
    rows = work(spark, d).withColumn("day", C.utc_day(F.col("created")))
    return rows.groupBy("day").agg(F.round(F.sum(F.when(F.col("run") % 2 == 0, F.col("weight"))) / F.sum("weight"), 9).alias("share"))


@query(f"select created // {DAY} as day, count(*) filter (where conclusion = 'success') as success, count(*) filter (where conclusion = 'failure') as failure, count(*) filter (where conclusion = 'cancelled') as cancelled, count(distinct case when conclusion = 'success' then pr end) as landed from runs group by 1")
def merge_outcome_series(spark, d):
    r = runs(spark, d).withColumn("day", F.expr(f"created div {DAY}"))
    counts = r.groupBy("day").pivot("conclusion", ["success", "failure", "cancelled"]).agg(F.count("run")).fillna(0)
    return counts.join(r.groupBy("day").agg(F.count_distinct(F.when(F.col("conclusion") == "success", F.col("pr"))).alias("landed")), "day")


@query("select r.run, created, k as size, conclusion, k is not null as known from runs r left join (select run, count(*) as k from steps where run % 4 <> 0 group by run) using (run)")
def staging_scatter(spark, d):
    sizes = steps(spark, d).where("run % 4 <> 0").groupBy("run").agg(F.count("*").alias("size"))
    return runs(spark, d).join(sizes, "run", "left").select("run", "created", "size", "conclusion", F.col("size").isNotNull().alias("known"))


@query(f"select a // {STEP} * {STEP} as bucket, string_agg((a % {STEP})::varchar, ',' order by a % {STEP}) as ticks from jobs where kind = 'signup' group by 1")
def picked_ticks(spark, d):
    rows = jobs(spark, d).where("kind = 'signup'").groupBy((F.col("a") - F.col("a") % STEP).alias("bucket")).agg(F.sort_array(F.collect_list(F.col("a") % STEP)).alias("t"))
    return rows.select("bucket", F.array_join(F.transform("t", lambda x: x.cast("string")), ",").alias("ticks"))


@query("""with p as (select run, kind as phase, wait_s::double as s from steps where run % 3 <> 0), t as (select run, sum(s) as t from p group by run), st as (select run, greatest(60, head % 200)::double as s, workflow from runs)
    select run, phase, round(sum(seconds), 6) as seconds from (
      select st.run, p.phase, p.s * least(1.0, st.s / t.t) as seconds from st join t using (run) join p on p.run = st.run where t.t > 0
      union all select st.run, 'unattributed', st.s - t.t from st join t using (run) where st.s > t.t and t.t > 0
      union all select st.run, st.workflow, st.s from st left join t using (run) where t.t is null or t.t = 0) where seconds > 0 group by all""")
def phase_split(spark, d):
    st = runs(spark, d).select("run", F.greatest(F.lit(60), F.col("head") % 200).cast("double").alias("s"), "workflow")
    phases = steps(spark, d).where("run % 3 <> 0").select("run", F.col("kind").alias("phase"), F.col("wait_s").cast("double").alias("ps"))
    return M.phase_split(st, phases, "run", "s", "phase", "ps", "workflow").groupBy("run", "phase").agg(F.round(F.sum("seconds"), 6).alias("seconds"))


@query("select kind, size, round(case when count(*) filter (where run % 6 = 0) > 0 then sum(case when run % 6 = 0 then run_s end)::double / count(*) filter (where run % 6 = 0) else avg(run_s) end, 6) as mean from steps group by all")
def phase_means(spark, d):
    sampled = F.col("run") % 6 == 0
    mean = F.when(F.count_if(sampled) > 0, F.avg(F.when(sampled, F.col("run_s")))).otherwise(F.avg("run_s"))
    return steps(spark, d).groupBy("kind", "size").agg(F.round(mean, 6).alias("mean"))


@query(f"""with r as (select run, workflow, created // {30 * DAY} as month, created, created + head * 1000000 as updated from runs), j as (select s.run, run_s from steps s where s.run % 97 = 0),
    g as (select distinct workflow, month from r where run in (select run from j)), w as (select workflow, run_s, row_number() over (partition by workflow order by run_s) as k, count(*) over (partition by workflow) as n from j join r using (run)),
    m as (select workflow, run_s as q from w where k = least(n, cast(floor(0.5::double * n) as bigint) + 1))
    select run, r.workflow, r.month, greatest(created, updated - q * 1000000) as started, updated as ended, true as estimated from r join m using (workflow) where (r.workflow, r.month) not in (select (workflow, month) from g)""")
def impute_unsampled(spark, d):
    r = runs(spark, d).select("run", "workflow", F.expr(f"created div {30 * DAY}").alias("month"), "created", (F.col("created") + F.col("head") * 1_000_000).alias("updated"))
    return M.impute_unsampled(r, steps(spark, d).where("run % 97 = 0").select("run", "run_s"), ["workflow", "month"], "run", "run_s")
