"""Activity of pools as mergeable partial states.

A partial says what is needed to report at any later clock: running jobs, waiting jobs per hour of creation with the oldest few
by name, completions per minute and result. Partials of any split of the jobs merge into the partial of all of them, in any
order and grouping; whether a waiting job is stale is decided when a partial is read, so that a quiet partition's old partial
ages without being computed again. Instants are microseconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.operators.activity import DAY, HOUR

MINUTE = 60_000_000
WINDOWS = (HOUR, 3 * HOUR, DAY)
RESULTS = ("success", "failure", "cancelled", "skipped", "other")
#: Waiting jobs that a partial names; beyond these the oldest live one may be unknown.
REFERENCES = 20
FIELDS = ("running", "oldest_running", "latest_completion", "hours", "references", "bins", "complete")


def _together(base: DataFrame, hours: DataFrame, references: DataFrame, bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A partial per key: base with the lists of hours (hour, n), references and bins (minute, results), each in order."""
    hours = hours.groupBy(*keys, "hour").agg(F.sum("n").alias("n")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("hour", "n"))).alias("hours"))
    oldest = Window.partitionBy(*keys).orderBy(F.col("created").asc_nulls_first(), "id")  # Spark cuts ranks before it shuffles
    references = references.withColumn("_rank", F.row_number().over(oldest)).where(F.col("_rank") <= REFERENCES)
    references = references.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "created", "id"))), lambda r: F.struct(r["created"].alias("created"), r["id"].alias("id"))).alias("references"))
    bins = bins.groupBy(*keys, "minute").agg(*[F.sum(r).alias(r) for r in RESULTS]).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("minute", *RESULTS))).alias("bins"))
    rows = base
    for part in (hours, references, bins):
        match = [base[k].eqNullSafe(part[k]) for k in keys]
        rows = rows.join(part, match, "left").select(*[rows[c] for c in rows.columns], *[part[c] for c in part.columns if c not in keys])
    return rows.select(*keys, *[F.coalesce(c, F.array()).alias(c) if c in ("hours", "references", "bins") else F.col(c) for c in FIELDS])


def partials(jobs: DataFrame, by: Sequence[str], clock: int, *, complete: Column | None = None) -> DataFrame:
    """by, pool, scope ("all" jobs, or "builds" alone), running, oldest_running (started, created, id), latest_completion (completed,
    id), hours (hour of creation, null if unknown, and n), references (created, id of the oldest waiting ones, unknown times first),
    bins (minute of completion and a count per result), complete.

    jobs: id, pool, build, active, running, created, started, completed, result and ``by``. Completions count up to the clock and a day
    back. A job is in one row; null pools and null ``by`` are values of their own."""
    keys = [*by, "pool", "scope"]
    build = F.coalesce(F.col("build"), F.lit(False))
    rows = jobs.select(*by, "pool", "id", "active", "running", "created", "started", "completed", "result", F.explode(F.when(build, F.array(F.lit("all"), F.lit("builds"))).otherwise(F.array(F.lit("all")))).alias("scope"))
    active, runs = F.coalesce(F.col("active"), F.lit(False)), F.coalesce(F.col("running"), F.lit(False))
    done = F.col("completed").isNotNull() & (F.col("completed") <= clock)
    last = F.min(F.when(done, F.struct((-F.col("completed")).alias("back"), "id")))
    base = rows.groupBy(*keys).agg(
        F.count_if(active & runs).alias("running"), F.min(F.when(active & runs, F.struct("started", "created", "id"))).alias("oldest_running"),
        F.when(last.isNotNull(), F.struct((-last["back"]).alias("completed"), last["id"].alias("id"))).alias("latest_completion"), F.lit(True).alias("complete"),
    )
    if complete is not None:
        base = base.withColumn("complete", F.coalesce(complete, F.lit(False)))
    waiting = rows.where(active & ~runs)
    hours = waiting.select(*keys, (F.floor(F.col("created") / HOUR) * HOUR).alias("hour"), F.lit(1).cast("long").alias("n"))
    counted = F.when(F.col("result") == "timed_out", "failure").when(F.col("result").isin(*RESULTS), F.col("result")).otherwise("other")
    recent = rows.where(done & (F.col("completed") >= clock // MINUTE * MINUTE - DAY)).withColumn("_result", counted)
    bins = recent.select(*keys, (F.floor(F.col("completed") / MINUTE) * MINUTE).alias("minute"), *[F.when(F.col("_result") == r, 1).otherwise(0).cast("long").alias(r) for r in RESULTS])
    return _together(base, hours, waiting.select(*keys, "created", "id"), bins, keys)


def merged(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The partials of each ``by``, pool and scope as one; complete if all of them are."""
    keys = [*by, "pool", "scope"]
    back = F.min(F.when(F.col("latest_completion").isNotNull(), F.struct((-F.col("latest_completion.completed")).alias("back"), F.col("latest_completion.id").alias("id"))))
    base = parts.groupBy(*keys).agg(
        F.sum("running").alias("running"), F.min("oldest_running").alias("oldest_running"), F.when(back.isNotNull(), F.struct((-back["back"]).alias("completed"), back["id"].alias("id"))).alias("latest_completion"),
        F.bool_and(F.coalesce("complete", F.lit(False))).alias("complete"),
    )
    list_ = lambda c: parts.select(*keys, F.explode(c).alias("_x")).select(*keys, "_x.*")
    return _together(base, list_("hours"), list_("references"), list_("bins"), keys)


def report(parts: DataFrame, clock: int) -> DataFrame:
    """Partials as read at a clock: running, waiting, stale_waiting, ids of the oldest running, waiting and stale ones and of the latest
    completion, oldest_unknown, finished and results of the rolling windows, coverage.

    A waiting job is stale once its whole hour of creation lies a day back; one of unknown creation never is. If only stale jobs are
    named but live ones wait, the oldest live one is unknown. Windows end at the last whole minute."""
    stale = lambda at: F.coalesce(F.floor(at / HOUR) * HOUR + HOUR <= clock - DAY, F.lit(False))
    total = lambda rows, n: F.aggregate(rows, F.lit(0).cast("long"), lambda a, x: a + n(x))
    through = clock // MINUTE * MINUTE
    live = F.filter("references", lambda r: ~stale(r["created"]))
    old = F.filter("references", lambda r: stale(r["created"]))
    waiting = total(F.filter("hours", lambda h: ~stale(h["hour"])), lambda h: h["n"])

    def window(width: int) -> Column:
        inside = F.filter("bins", lambda b: (b["minute"] >= through - width) & (b["minute"] < through))
        count = lambda result: total(inside, lambda b: b[result])
        return F.struct(F.lit(width // 1_000_000).alias("seconds"), sum((count(r) for r in RESULTS[1:]), count(RESULTS[0])).alias("finished"), *[count(r).alias(r) for r in RESULTS])

    windows = [window(w) for w in WINDOWS]
    kept = [c for c in parts.columns if c not in FIELDS]
    return parts.select(
        *kept, "running", waiting.alias("waiting"), total(F.filter("hours", lambda h: stale(h["hour"])), lambda h: h["n"]).alias("stale_waiting"), F.col("oldest_running.id").alias("oldest_running"),
        F.get(live, F.lit(0))["id"].alias("oldest_waiting"), ((F.size(live) == 0) & (waiting > 0)).alias("oldest_unknown"), F.get(old, F.lit(0))["id"].alias("oldest_stale_waiting"),
        F.col("latest_completion.id").alias("latest_completion"), F.array(*windows).alias("windows"), F.when(F.col("complete"), "retained_observations").otherwise("partial").alias("coverage"),
    )
