"""What a day's reversible metric rows (``live.job_contributions``, summed or not, with whatever was taken back) say: its measures, its
fleet by time step, and the series that are drawn from them.

Everything is a long table, a row per measure or point, so that no day, step or list of ticks has to fit into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.operators import live
from chronotally.operators import quantiles as Q
from chronotally.operators.prefix import prefix_sums
from chronotally.operators.snapshots import checkpointed

KEY = ["day", "bucket", "metric", "value"]
NOTHING = 1e-9
FLEET = "fleet/"
LANDED = "landed-prs"
MERGED = ("success", "failure", "cancelled", "other")


def _after(prefix: str) -> Column:
    """The metric's name behind a prefix, null if it has another."""
    return F.when(F.col("metric").startswith(prefix), F.substring("metric", F.lit(len(prefix) + 1), F.length("metric")))


def _is_distribution() -> Column:
    return F.col("metric").startswith("duration/") | F.col("metric").startswith("wait/")


def day_measures(rows: DataFrame) -> DataFrame:
    """day, metric, amount, median, p90: a counter has its amount, a distribution (duration/*, wait/*) its quantiles by weight.

    Counters that were taken back to nothing stay away, as does a distribution without a positive weight; values of which
    nothing is left do not count. Rows of the fleet are left out. Rows are read once, and summed per distinct value; quantiles come from
    these sums, in ranges."""
    daily = rows.where(~F.col("metric").startswith(FLEET)).groupBy("day", "metric", "value").agg(F.sum("amount").alias("amount"))
    daily = checkpointed(daily)  # a row per distinct value; counters, quantiles and their ranges would each make all rows anew
    none = lambda c: F.lit(None).cast("double").alias(c)
    counters = daily.where(~_is_distribution()).groupBy("day", "metric").agg(F.sum("amount").alias("amount")).where(F.abs("amount") >= NOTHING)
    values = daily.where(_is_distribution() & (F.col("amount") >= NOTHING))
    spread = Q.weighted_quantiles(values, ["day", "metric"], "value", F.col("amount"), {"median": 0.5, "p90": 0.9})
    return counters.select("day", "metric", "amount", none("median"), none("p90")).unionByName(spread.select("day", "metric", none("amount"), "median", "p90"))


def fleet_rows(rows: DataFrame) -> DataFrame:
    """step, at, type, key, value: a time step's mean number running, largest number queued, longest wait, and picked (a row per tick).

    The queue's level is a prefix sum over the ranges of (step, instant), so that a step with very many waits is several tasks'
    work. Changes of one instant count together: a wait that ends where another begins does not overlap it."""
    fleet = rows.where(F.col("metric").startswith(FLEET)).groupBy(*KEY).agg(F.sum("amount").alias("amount")).where(F.abs("amount") >= NOTHING)
    fleet = checkpointed(fleet)  # four uses, each of which would make all rows anew
    part = F.split("metric", "/", 4)
    named = fleet.select(part[1].cast("long").alias("step"), F.col("bucket").alias("at"), part[2].alias("type"), F.coalesce(F.get(part, F.lit(3)), F.lit("")).alias("key"), "value", "amount")
    group = ["step", "at", "type", "key"]
    running = named.where("type = 'running'").groupBy(*group).agg(F.sum("amount").alias("value"))
    longest = named.where("type = 'wait' and amount > 0").groupBy(*group).agg(F.greatest(F.max("value"), F.lit(0.0)).alias("value"))
    changes = named.where("type = 'queued'").groupBy(*group, F.col("value").alias("instant")).agg(F.sum("amount").alias("change"))
    levels = prefix_sums(changes, group, ["instant"], {"level": F.col("change")})
    queued = levels.groupBy(*group).agg(F.greatest(F.max("level"), F.lit(0.0)).alias("value"))
    picked = named.where("type = 'picked' and amount > 0").select(*group, "value")
    return running.unionByName(longest).unionByName(queued).unionByName(picked)


def failure_causes(measures: DataFrame) -> DataFrame:
    """day, cause, builds: failed builds by cause; those that wait for a class are 'unclassified'."""
    cause = _after("failure/")
    return measures.where(cause.isNotNull()).select("day", F.when(cause == "pending", "unclassified").otherwise(cause).alias("cause"), F.col("amount").alias("builds"))


def failure_rates(measures: DataFrame) -> DataFrame:
    """day, rate: failed builds of all that ended, null on a day of none."""
    failed = F.coalesce(F.sum(F.when(F.col("metric").startswith("failure/"), F.col("amount"))), F.lit(0.0))
    return measures.groupBy("day").agg(F.try_divide(failed, F.sum(F.when(F.col("metric") == "pr-total", F.col("amount")))).alias("rate"))


def picker_shares(measures: DataFrame, kind: str, runners: Sequence[str]) -> DataFrame:
    """day, share: builds that runners of one kind picked, of those of all listed kinds; null on a day of none."""
    of = lambda kinds: F.sum(F.when(_after("picker/").isin(*kinds), F.col("amount")))
    return measures.groupBy("day").agg(F.try_divide(F.coalesce(of([kind]), F.lit(0.0)), of(runners)).alias("share"))


def merge_outcomes(measures: DataFrame, landings: DataFrame) -> DataFrame:
    """day, success, failure, cancelled, other, landed for all days of either table. ``landings``: day, pr, where a pr counts once a
    day; a stored landed-prs measure stands before the count, as it outlives the landings themselves."""
    counts = measures.groupBy("day").agg(
        *[F.sum(F.when(F.col("metric") == f"merge/{k}", F.col("amount"))).alias(k) for k in MERGED], F.max(F.when(F.col("metric") == LANDED, F.col("amount"))).alias("_kept")
    )
    both = counts.join(landings.groupBy("day").agg(F.count_distinct("pr").alias("_counted")), "day", "full")
    return both.select("day", *[F.coalesce(k, F.lit(0.0)).alias(k) for k in MERGED], F.coalesce("_kept", F.col("_counted").cast("double"), F.lit(0.0)).alias("landed"))


def mean_phases(measures: DataFrame) -> DataFrame:
    """day, phase, minutes: a phase's mean over the sampled builds of a day if there is any, else over all its builds. A phase of
    the day that no sampled build has is 0 there."""
    phase, sampled = _after("phase/"), _after("sample-phase/")
    counts = measures.where(F.col("metric").isin("phase-count", "phase-sample-count")).groupBy("day").agg(
        F.sum(F.when(F.col("metric") == "phase-count", F.col("amount"))).alias("_all"), F.coalesce(F.sum(F.when(F.col("metric") == "phase-sample-count", F.col("amount"))), F.lit(0.0)).alias("_sampled")
    )
    sums = measures.where(F.coalesce(sampled, phase).isNotNull()).groupBy("day", F.coalesce(sampled, phase).alias("phase")).agg(
        F.coalesce(F.sum(F.when(phase.isNotNull(), F.col("amount"))), F.lit(0.0)).alias("_sum"), F.coalesce(F.sum(F.when(sampled.isNotNull(), F.col("amount"))), F.lit(0.0)).alias("_of_sampled")
    )
    mean = F.when(F.col("_sampled") > 0, F.col("_of_sampled") / F.col("_sampled")).otherwise(F.col("_sum") / F.coalesce(F.nullif(F.col("_all"), F.lit(0.0)), F.lit(1.0)))
    return sums.join(counts, "day", "left").select("day", "phase", mean.alias("minutes"))


def compacted(measures: DataFrame, landings: DataFrame, oldest: Column) -> DataFrame:
    """The long-term rows of days before ``oldest``: their measures and how many landed, in place of their landings. A day that was
    compacted before keeps its count if its landings are gone."""
    old = measures.where(F.col("day") < oldest)
    count = landings.where(F.col("day") < oldest).groupBy("day").agg(F.count_distinct("pr").cast("double").alias("_counted"))
    kept = old.groupBy("day").agg(F.max(F.when(F.col("metric") == LANDED, F.col("amount"))).alias("_kept")).join(count, "day", "full")
    none = lambda c: F.lit(None).cast("double").alias(c)
    landed = kept.select("day", F.lit(LANDED).alias("metric"), F.coalesce("_counted", "_kept", F.lit(0.0)).alias("amount"), none("median"), none("p90"))
    return old.where(F.col("metric") != LANDED).unionByName(landed)


def reassigned(work: DataFrame, hosts: live.Hosts) -> DataFrame:
    """Jobs with ``now``: an own machine's job is of the kind of the one machine that its labels and runner name tell."""
    host = live.host_of(F.col("labels"), F.col("runner_name"), hosts)
    return work.withColumn("now", F.when((F.col("kind") == "self-hosted") & host.isNotNull(), host).otherwise(F.col("kind")))


def recompute_hosts(work: DataFrame, hosts: live.Hosts, until: float, *, reported: Column | None = None, names: live.Names = live.Names()) -> DataFrame:  # noqa: B008
    """Signed rows that known machines make of stored jobs (``work`` as for ``live.job_contributions``, with labels and runner_name):
    derived from the jobs whose kind changes and from no other. ``names.runners`` must list the machines."""
    changed = reassigned(work, hosts).where(~F.col("kind").eqNullSafe(F.col("now")))
    both = changed.withColumn("_s", F.explode(F.array(F.struct(F.col("kind").alias("k"), F.lit(-1).alias("sign")), F.struct(F.col("now").alias("k"), F.lit(1).alias("sign")))))
    rows = live.job_contributions(both.withColumns({"kind": F.col("_s.k"), "sign": F.col("_s.sign")}).drop("_s"), until, reported=reported, names=names, keep=["sign"])
    return rows.groupBy(*KEY).agg(F.sum(F.col("amount") * F.col("sign")).alias("amount")).where(F.abs("amount") >= NOTHING)
