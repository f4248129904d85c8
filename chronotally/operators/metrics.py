"""Reversible metric rows (day, bucket, metric, value, amount): what a job or run contributes, differences, and sums.

A distribution is kept as (value, amount) pairs and a total as value 0, so every row can be added and taken back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.functions.columns import utc_day
from chronotally.operators import intervals as I
from chronotally.operators import quantiles as Q

KEY = ["day", "bucket", "metric", "value"]
NOTHING = 1e-9


def _rows(df: DataFrame, keep: Sequence[str], *metrics: tuple[Column, Column, Column, Column]) -> DataFrame:
    """(metric, value, amount, condition) of each row in one pass; day and bucket must be columns."""
    parts = [F.when(when, F.struct(m.alias("metric"), v.cast("double").alias("value"), a.cast("double").alias("amount"))) for m, v, a, when in metrics]
    return df.select(*keep, "day", "bucket", F.explode(F.array_compact(F.array(*parts))).alias("m")).select(*keep, "day", "bucket", "m.*")


def contributions(jobs: DataFrame, *, step: int, keep: Sequence[str] = ()) -> DataFrame:
    """Metric rows of jobs (kind, conclusion, created, started, ended, assigned, weight; times in microseconds).

    Per day of creation: jobs/<kind>, failure/<kind> (cancelled ones do not count as finished), finished/<kind>,
    wait/<kind> and duration/<kind> in seconds, minutes/<kind>. Per bucket: running/<kind> and queued/<kind>, the
    weighted mean number. A job that never got a runner does not execute, whatever its start time says."""
    kind = lambda p: F.concat(F.lit(p + "/"), F.col("kind"))
    ran = F.col("assigned") & F.col("started").isNotNull()
    finished = F.col("conclusion").isin("success", "failure", "timed_out")
    seconds = lambda a, b: F.greatest(F.lit(0), F.col(b) - F.col(a)) / F.lit(1_000_000.0)
    w, always = F.col("weight"), F.lit(True)
    daily = jobs.withColumn("day", utc_day(F.col("created"))).withColumn("bucket", F.lit(None).cast("long"))
    points = _rows(
        daily, keep, (kind("jobs"), F.lit(0.0), w, always), (kind("finished"), F.lit(0.0), w, finished), (kind("failure"), F.lit(0.0), w, F.col("conclusion").isin("failure", "timed_out")),
        (kind("wait"), seconds("created", "started"), w, ran), (kind("duration"), seconds("started", "ended"), w, ran), (kind("minutes"), F.lit(0.0), seconds("started", "ended") / 60 * w, ran),
    )
    share = (F.col("hi") - F.col("lo")) / F.lit(float(step)) * w
    running = I.interval_buckets(jobs.where(ran), "started", "ended", step).withColumn("day", utc_day(F.col("bucket")))
    queued = I.interval_buckets(jobs.withColumn("_until", F.when(ran, F.col("started")).otherwise(F.col("ended"))), "created", "_until", step).withColumn("day", utc_day(F.col("bucket")))
    out = points.unionByName(_rows(running, keep, (kind("running"), F.lit(0.0), share, always))).unionByName(_rows(queued, keep, (kind("queued"), F.lit(0.0), share, always)))
    return out.where("amount <> 0")


def summed(rows: DataFrame) -> DataFrame:
    """Rows added up by key; sums that are nothing but rounding go."""
    return rows.groupBy(*KEY).agg(F.sum("amount").alias("amount")).where(F.abs("amount") >= NOTHING)


def diff_contributions(before: DataFrame, after: DataFrame) -> DataFrame:
    """What must be added to go from one set of rows to the other."""
    return summed(after.select(*KEY, "amount").unionByName(before.select(*KEY, (-F.col("amount")).alias("amount"))))


def apply_deltas(state: DataFrame, deltas: DataFrame, receipt: str, delivery: str) -> DataFrame:
    """State after deltas. A receipt that was delivered several times counts once: all rows of its smallest ``delivery``
    are added, also several of one key, and no row of a later one."""
    first = deltas.groupBy(receipt).agg(F.min(delivery).alias("_first"))
    once = deltas.join(first, receipt).where(F.col(delivery) == F.col("_first"))
    return summed(state.select(*KEY, "amount").unionByName(once.select(*KEY, "amount")))


def recompute_dimension(jobs: DataFrame, old: str, new: str, *, step: int) -> DataFrame:
    """Difference that a corrected kind (column ``new`` instead of ``old``) makes, from the changed rows alone."""
    changed = jobs.where(~F.col(old).eqNullSafe(F.col(new)))
    return diff_contributions(contributions(changed.withColumn("kind", F.col(old)), step=step), contributions(changed.withColumn("kind", F.col(new)), step=step))


def dirty_recompute(stored: DataFrame, facts: DataFrame, dirty: DataFrame, derive, keys: Sequence[str]) -> DataFrame:
    """Stored rows with those of dirty keys derived again from the facts of these keys alone."""
    kept = stored.join(dirty.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(derive(facts.join(dirty.select(*keys).distinct(), list(keys), "left_semi")))


def day_summary(rows: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per day and metric: total amount, and the median and 90th percentile of its values (live rule), in one pass."""
    some = rows.where(F.split("metric", "/")[0].isin(*metrics))
    return Q.weighted_quantiles(some, ["day", "metric"], "value", F.col("amount"), {"median": 0.5, "p90": 0.9})


def phase_split(steps: DataFrame, phases: DataFrame, key: str, step_s: str, phase: str, phase_s: str, coarse: str) -> DataFrame:
    """Telemetry phases scaled to fit their step (factor at most 1) and the rest as 'unattributed'; a step without
    telemetry counts wholly as its coarse phase."""
    total = phases.groupBy(key).agg(F.sum(phase_s).alias("_t"), F.collect_list(F.struct(F.col(phase).alias("phase"), F.col(phase_s).alias("s"))).alias("_p"))
    rows = steps.join(total, key, "left")
    factor = F.least(F.lit(1.0), F.try_divide(F.col(step_s), F.col("_t")))
    rest = F.struct(F.lit("unattributed").alias("phase"), F.greatest(F.lit(0.0), F.col(step_s) - F.col("_t")).cast("double").alias("s"))
    split = F.concat(F.transform("_p", lambda p: F.struct(p["phase"].alias("phase"), (p["s"] * factor).cast("double").alias("s"))), F.array(rest))
    lone = F.array(F.struct(F.col(coarse).alias("phase"), F.col(step_s).cast("double").alias("s")))
    return rows.select(key, F.explode(F.when(F.col("_t") > 0, split).otherwise(lone)).alias("e")).select(key, "e.phase", F.col("e.s").alias("seconds")).where("seconds > 0")


def impute_unsampled(runs: DataFrame, jobs: DataFrame, group: Sequence[str], key: str, run_s: str) -> DataFrame:
    """One estimated job per terminal run of a group whose runs have no sampled job: the upper median of the sampled jobs
    of the first group column, ending at the run's update and not starting before its creation."""
    sampled = runs.join(jobs.select(key).distinct(), key, "left_semi").select(*group).distinct()
    bare = runs.join(sampled, list(group), "left_anti")
    work = jobs.join(runs.select(key, group[0]), key)
    median = Q.report_quantile(work, [group[0]], run_s, 0.5)
    return bare.join(median, group[0]).select(key, *group, F.greatest(F.col("created"), F.col("updated") - F.col("quantile") * 1_000_000).alias("started"), F.col("updated").alias("ended"), F.lit(True).alias("estimated"))
