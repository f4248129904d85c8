"""Live activity and backlog at a given clock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR, DAY = 3_600_000_000, 86_400_000_000


def stale_waiting(created: Column, clock: int) -> Column:
    """The whole creation hour lies more than a day before the clock; an unknown creation is never stale."""
    return F.coalesce(F.floor(created / HOUR) * HOUR + HOUR <= clock - DAY, F.lit(False))


def oldest_reference(id_: str, created: str, when: Column) -> Column:
    """Id of the oldest row that meets the condition; an unknown time sorts first."""
    return F.min(F.when(when, F.struct(F.col(created).isNotNull().alias("k"), F.col(created).alias("c"), F.col(id_).alias("id")))).getField("id")


def pool_activity(df: DataFrame, pool: str, state: str, created: str, started: str, completed: str, id_: str, clock: int) -> DataFrame:
    """Per pool: running, waiting, stale waiting, oldest running, waiting and stale ids, latest completion."""
    running, waiting = F.col(state) == "in_progress", F.col(state).isin("queued", "waiting", "pending")
    stale = waiting & stale_waiting(F.col(created), clock)
    return df.groupBy(pool).agg(
        F.count_if(running).alias("running"), F.count_if(waiting).alias("waiting"), F.count_if(stale).alias("stale"),
        oldest_reference(id_, started, running).alias("oldest_running"), oldest_reference(id_, created, waiting & ~stale).alias("oldest_waiting"),
        oldest_reference(id_, created, stale).alias("oldest_stale"), F.max(F.when(F.col(state) == "completed", F.col(completed))).alias("latest_completion"),
    )


#: A workflow that nothing touched for so long is settled.
SETTLED = 5_400_000_000


def backlog_state(status: Column, verified: Column, touched: Column, active: Column, actual: Column, running: Column, clock: int) -> Column:
    """State of a workflow that is not completed, by ordered rules, from its run's status and the counts of its attempt's
    jobs: active ones, of them actual (not estimated) ones, of them running ones. A settled one (enumerated, without active
    jobs, not held back, and not touched for long) is stuck."""
    held = status.isin("pending", "waiting", "requested")
    settled = ~held & verified & (active == 0) & (clock - touched >= SETTLED)
    return (
        F.when(settled, "stuck").when(running > 0, "in_progress").when(held | ((status == "in_progress") & (actual > 0)), "pending")
        .when(status == "queued", "queued").when(status == "in_progress", "pending").otherwise("unconfirmed")
    )


def workflow_backlog(runs: DataFrame, jobs: DataFrame, category: str, clock: int) -> DataFrame:
    """Open workflows with their state; superseded attempts are left out, whatever their jobs.

    runs: run, attempt, status, verified, created, updated, started and the category; jobs: run, attempt, active, estimated,
    in_progress, created (0 or null: unknown). ``since`` is set where a workflow waits for a runner that may never come: queued
    without jobs, or with nothing but waiting jobs of known creation; it is stale once that hour lies a day back."""
    fields = [c for c in runs.columns if c not in ("run", "attempt")]
    newest = runs.groupBy("run").agg(F.max_by(F.struct("attempt", *fields), "attempt").alias("r")).select("run", "r.*").where("status <> 'completed'")
    on, actual = F.coalesce(F.col("active"), F.lit(False)), F.col("active") & ~F.coalesce(F.col("estimated"), F.lit(False))
    running = actual & F.coalesce(F.col("in_progress"), F.lit(False))
    counts = jobs.groupBy("run", "attempt").agg(
        F.count_if(on).alias("active_jobs"), F.count_if(actual).alias("actual_jobs"), F.count_if(running).alias("running_jobs"),
        F.count_if(actual & ~running & (F.col("created") > 0)).alias("dated"), F.max(F.when(actual & ~running, F.col("created"))).alias("latest"),
    )
    rows = newest.join(counts, ["run", "attempt"], "left").fillna(0, ["active_jobs", "actual_jobs", "running_jobs", "dated"])
    known = lambda c: F.coalesce(F.col(c), F.lit(0))
    touched = F.greatest(known("created"), known("updated"), known("started"))
    rows = rows.withColumn("state", backlog_state(F.col("status"), F.coalesce("verified", F.lit(False)), touched, F.col("active_jobs"), F.col("actual_jobs"), F.col("running_jobs"), clock))
    queued_since = F.nullif(F.greatest(known("created"), known("started")), F.lit(0))
    waits = F.col("status").isin("queued", "in_progress") & (F.col("running_jobs") == 0) & (F.col("actual_jobs") > 0) & (F.col("dated") == F.col("actual_jobs"))
    since = F.when((F.col("status") == "queued") & (F.col("actual_jobs") == 0), queued_since).when(waits, F.col("latest"))
    stale = F.coalesce(stale_waiting(since, clock), F.lit(False))
    return rows.select("run", "attempt", category, "created", "actual_jobs", "running_jobs", since.alias("since"), F.when(stale, "stale").otherwise(F.col("state")).alias("state"))


def recent_cohorts(df: DataFrame, active: Column, klass: str, order: Sequence[Column], limits: dict[str, int], most_active: int) -> DataFrame:
    """All active rows (up to most_active) and the newest of each class, with whether the cohort was cut.

    The limits are the feature: this is a top-k report. Rank filters are pushed below the shuffle by Spark."""
    cohort = F.when(active, "active").otherwise(F.col(klass))
    limit = F.element_at(F.create_map(*[x for k, v in ({"active": most_active} | limits).items() for x in (F.lit(k), F.lit(v))]), F.col("cohort"))
    rows = df.withColumn("cohort", cohort)
    sizes = rows.groupBy("cohort").agg(F.count("*").alias("_n"))
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("cohort").orderBy(*order))).where(F.col("_r") <= max([most_active, *limits.values()]))
    return ranked.where(F.col("_r") <= F.coalesce(limit, F.lit(0))).join(sizes, "cohort").withColumn("truncated", F.col("_n") > limit).drop("_n", "_r")


def host_rollup(df: DataFrame, host: str, at: str, value: str, fresh: Column, step: int) -> DataFrame:
    """Samples, fresh samples, and count, sum, min, max of fresh values per host and step."""
    v = F.when(fresh, F.col(value))
    return df.groupBy(host, (F.col(at) - F.pmod(F.col(at), F.lit(step))).alias("bucket")).agg(
        F.count("*").alias("samples"), F.count_if(fresh).alias("fresh"), F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("least"), F.max(v).alias("most")
    )


def merge_partials(df: DataFrame, keys: Sequence[str], sums: Sequence[str], complete: str) -> DataFrame:
    """Partials added up; coverage is 'partial' as soon as one partial is incomplete or unknown."""
    whole = F.bool_and(F.coalesce(F.col(complete), F.lit(False)))
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], F.when(whole, "complete").otherwise("partial").alias("coverage"))
