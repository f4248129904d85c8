"""Queries on buckets, intervals, quantiles and ordered rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronotally.operators import intervals as I
from chronotally.operators import quantiles as Q
from chronotally.operators import sequence as S
from chronotally.plans.registry import jobs, query, runs, snapshots, steps

MINUTE, STEP, DAY = 60_000_000, 600_000_000, 86_400_000_000
CLOCK = 1_706_000_000_000_000  # within the events
LO = 1_704_067_200_000_000  # 2024-01-01

_BUCKETS = f"""pieces as (select jobs.*, bucket, greatest(a, bucket) as lo, least(b, bucket + {STEP}) as hi
    from jobs, unnest(range(a - a % {STEP}, b, {STEP})) as g(bucket) where b > a)"""
_ENDS = "ends as (select bucket, kind, lo as tm, 1 as d from pieces union all select bucket, kind, hi, -1 from pieces)"


@query(f"with {_BUCKETS} select id, bucket, lo, hi from pieces")
def interval_buckets(spark, d):
    return I.interval_buckets(jobs(spark, d), "a", "b", STEP).select("id", "bucket", "lo", "hi")


@query(f"with {_BUCKETS} select bucket, kind, cast(sum(hi - lo) as bigint) as busy, sum(hi - lo)::double / {STEP} as used from pieces group by all")
def bucket_utilisation(spark, d):
    return I.bucket_utilisation(jobs(spark, d), ["kind"], "a", "b", STEP)


@query(f"with {_BUCKETS}, {_ENDS} select bucket, kind, tm, d as delta from ends")
def queue_depth_events(spark, d):
    return I.queue_depth_events(jobs(spark, d), ["kind"], "a", "b", STEP).withColumnRenamed("at", "tm")


@query(f"""with {_BUCKETS}, {_ENDS}, net as (select bucket, kind, tm, sum(d) as d from ends group by all),
    run as (select bucket, kind, sum(d) over (partition by bucket, kind order by tm) as depth from net)
    select bucket, kind, cast(greatest(max(depth), 0) as bigint) as peak from run group by all""")
def peak_concurrency(spark, d):
    return I.peak_concurrency(jobs(spark, d), ["kind"], "a", "b", STEP)


@query(f"""with w as (select kind, b as started, b - a as wait from jobs),
    e as (select kind, wait, started, unnest(range(started - 1 - (started - 1) % {STEP} + {STEP}, started + 1800000000, {STEP})) as bucket_end from w)
    select bucket_end - {STEP} as bucket, kind, max(wait) as wait from e group by all""")
def trailing_wait(spark, d):
    return I.trailing_wait(jobs(spark, d), ["kind"], "a", "b", STEP, 1_800_000_000)


@query(f"""select id, greatest(a, least(case when id % 4 <> 0 then b when id % 8 = 0 then b + 5000000 else {CLOCK} end, {CLOCK}, a + 3600000000)) as closed from jobs""")
def close_open_intervals(spark, d):
    open_ = jobs(spark, d).withColumn("end", F.when(F.col("id") % 4 != 0, F.col("b")))
    parent = F.when(F.col("id") % 8 == 0, F.col("b") + 5_000_000)
    return I.close_open_intervals(open_, "end", parent, CLOCK, 3_600_000_000, "a").select("id", "closed")


@query(f"""with c as (select id, a, b, a + (b - a) // 3 as cut, id % 4 as w from jobs),
    p as (select id, a as part_start, least(b, cut) as part_end, w::double as part_weight from c union all select id, greatest(a, cut), b, 1.0 from c)
    select * from p where part_end > part_start and part_weight <> 0""")
def sampling_cutover(spark, d):
    rows = jobs(spark, d).select("id", "a", "b", (F.col("a") + F.expr("(b - a) div 3")).alias("cut"), (F.col("id") % 4).alias("w"))
    return I.sampling_cutover(rows, "a", "b", "cut", "w").select("id", "part_start", "part_end", "part_weight")


@query(f"""with n as (select a - a % {STEP} as bucket, count(*) as n from jobs group by 1), g as (select unnest(range({CLOCK // STEP * STEP + STEP - 50 * STEP}, {CLOCK // STEP * STEP + STEP}, {STEP})) as bucket)
    select bucket, n from g left join n using (bucket)""")
def dense_grid(spark, d):
    counts = jobs(spark, d).groupBy((F.col("a") - F.col("a") % STEP).alias("bucket")).agg(F.count("*").alias("n"))
    return I.dense_grid(counts, "bucket", STEP, 50, CLOCK, ["n"])


_UNCOVERED = f"""with i as (select kind, greatest(a, {LO}) as a, least(b, {LO + 10 * DAY}) as b from jobs where b > {LO} and a < {LO + 10 * DAY} and b > a),
    u as (select * from i union all select distinct kind, {LO + 10 * DAY}, {LO + 10 * DAY} from jobs),
    g as (select kind, a, coalesce(max(b) over (partition by kind order by a, b rows between unbounded preceding and 1 preceding), {LO}) as gap_start from u)
    select kind, gap_start, a as gap_end from g where a > gap_start"""


@query(_UNCOVERED)
def uncovered_intervals(spark, d):
    return I.uncovered_intervals(jobs(spark, d), ["kind"], "a", "b", LO, LO + 10 * DAY)


@query(_UNCOVERED)
def uncovered_intervals_all(spark, d):
    return uncovered_intervals(spark, d)


_THROUGH = CLOCK - CLOCK % MINUTE


@query(f"select a - a % {MINUTE} as bin, kind, run % 3 as scope, count(*) as n from jobs group by all")
def minute_bins(spark, d):
    return jobs(spark, d).groupBy((F.col("a") - F.col("a") % MINUTE).alias("bin"), "kind", (F.col("run") % 3).alias("scope")).agg(F.count("*").alias("n"))


@query(f"""select kind, w as width, count(*) as n from jobs, (values (3600000000), (10800000000), (86400000000)) v(w)
    where a >= {_THROUGH} - w and a < {_THROUGH} group by all""")
def rolling_windows(spark, d):
    return I.rolling_windows(jobs(spark, d), ["kind"], "a", CLOCK, [3_600_000_000, 10_800_000_000, 86_400_000_000])


@query("""with s as (select kind, value, sum(1 + id % 3) as w from jobs group by all),
    r as (select kind, value, sum(w) over (partition by kind order by value) as run, sum(w) over (partition by kind) as total from s)
    select kind, min(value) as quantile from r where run >= greatest(1, ceil(total * 0.9)) group by kind""")
def weighted_quantile(spark, d):
    return Q.weighted_quantile(jobs(spark, d), ["kind"], "value", 1 + F.col("id") % 3, 0.9)


_RANKED = "with r as (select kind, value, row_number() over (partition by kind order by value) as k, count(*) over (partition by kind) as n from jobs)"


@query(f"{_RANKED} select kind, value as quantile from r where k = least(n, cast(floor(0.9::double * n) as bigint) + 1)")
def report_quantile(spark, d):
    return Q.report_quantile(jobs(spark, d), ["kind"], "value", 0.9)


@query(f"{_RANKED} select kind, value as quantile from r where k = cast(floor((n - 1) * 0.9::double) as bigint) + 1")
def replay_percentile(spark, d):
    return Q.replay_percentile(jobs(spark, d), ["kind"], "value", 0.9)


@query("select run, created, row_number() over (order by created, run) - 1 as index from runs")
def commit_index(spark, d):
    return S.ordered_index(runs(spark, d).select("run", "created"), [F.col("created"), F.col("run")])


@query("select run, id, kind, value, lag(kind) over w as prev_kind, lag(value) over w as prev_value from jobs window w as (partition by run order by a, id)")
def consecutive_pairs(spark, d):
    return S.consecutive_pairs(jobs(spark, d), ["run"], ["a", "id"], ["kind", "value"]).select("run", "id", "kind", "value", "prev_kind", "prev_value")


_SEGMENTS = """s as (select run, kind, a, id, lag(kind) over (partition by run order by a, id) as p, row_number() over (partition by run order by a, id) as k from jobs),
    seg as (select run, kind, a as seg_start, lead(a) over (partition by run order by a, id) as seg_end from s where k = 1 or p <> kind)"""


@query(f"with {_SEGMENTS} select * from seg")
def change_segments(spark, d):
    return S.change_segments(jobs(spark, d), ["run"], ["a", "id"], ["kind"], "a")


@query(f"""with {_SEGMENTS}, h as (select seg.run, seg_start, min(jobs.a) as first_at from seg join jobs on jobs.run = seg.run and jobs.value > 100 and jobs.a >= seg_start and (seg_end is null or jobs.a < seg_end) group by 1, 2)
    select seg.run, kind, seg.seg_start, seg_end, first_at from seg left join h on seg.run = h.run and seg.seg_start = h.seg_start""")
def first_in_segment(spark, d):
    rows = jobs(spark, d)
    return S.first_in_segment(S.change_segments(rows, ["run"], ["a", "id"], ["kind"], "a"), rows, ["run"], "a", F.col("value") > 100)


@query(f"""with t as (select run, a as tm from jobs where a >= {LO} and a < {LO + 20 * DAY} union all select distinct run, unnest([{LO}, {LO + 20 * DAY}]) from jobs),
    g as (select run, tm - lag(tm) over (partition by run order by tm) as gap from t)
    select run, max(gap) as max_gap, count(*) filter (where gap > {DAY}) as n_long from g group by run""")
def observation_gaps(spark, d):
    return S.observation_gaps(jobs(spark, d), ["run"], "a", LO, LO + 20 * DAY, DAY)


@query(f"""with t as (select run, max(a) as a, max(value) as value, max(id) as id from jobs group by run, a // {STEP}),
    g as (select run, a, case when id % 9 <> 0 then value end as value, a - lag(a) over (partition by run order by a) as gap from t)
    select run, a as tm, value from g union all select run, a - 1, null from g where gap > {DAY}""")
def gap_broken_series(spark, d):
    rows = jobs(spark, d).groupBy("run", F.expr(f"a div {STEP}")).agg(F.max("a").alias("a"), F.max("value").alias("value"), F.max("id").alias("id"))
    return S.gap_broken_series(rows, ["run"], "a", "value", F.col("id") % 9 != 0, DAY).withColumnRenamed("at", "tm")


@query("""select run, arg_min(value, (a, value)) as first_value, arg_max(value, (a, value)) as last_value, max(value) as max_value from (select run, a, value from jobs) group by run""")
def first_last_max(spark, d):
    return S.first_last_max(jobs(spark, d), ["run"], "a", "value")


@query("""with f as (select item, min(tm) as hi from (select tm, unnest(items) as item from snaps) group by item),
    t as (select tm, lag(tm) over (order by tm) as lo from snaps)
    select item, lo, hi from f join t on f.hi = t.tm""")
def censored_arrivals(spark, d):
    return S.censored_arrivals(snapshots(spark, d), "tm", "items")


@query("""with s as (select a - a % 600000000 as tm, run, kind from jobs), t as (select tm, lag(tm) over (order by tm) as lo from (select distinct tm from s)), f as (select run as item, kind as version, min(tm) as hi from s group by all)
    select item, version, lo, hi from f join t on t.tm = f.hi""")
def censored_versions(spark, d):
    """Arrivals of each version of an item, not of the item alone."""
    s = jobs(spark, d).groupBy((F.col("a") - F.col("a") % 600_000_000).alias("tm")).agg(F.collect_set(F.struct("run", "kind")).alias("items"))
    return S.censored_arrivals(s, "tm", "items").select(F.col("item.run").alias("item"), F.col("item.kind").alias("version"), "lo", "hi")


@query("select run, wait_s, n from steps where size = 'O' order by wait_s, run, n")
def ordered_waiting_list(spark, d):
    return steps(spark, d).where("size = 'O'").select("run", "wait_s", "n").orderBy("wait_s", "run", "n")
