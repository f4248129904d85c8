"""Metrics stored by day, kept up to date by signed deltas: only the days that a delta touches are written again.

``folder`` holds deltas/batch=<n> (signed rows of a micro-batch, which are their own receipt), late/batch=<n> (rows of closed days,
acknowledged and never added), and state/day=<d> (the sums). What is dirty follows from what is stored: a day is dirty while there
are deltas of it with a higher batch than its state went through. A fold that fails half-way is simply repeated: days that were
written hold the batch they went through, so nothing is added twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.operators import live
from chronotally.streaming.streams import foreach_batch_deltas, open_days

KEY = ["day", "bucket", "metric", "value"]
#: A day of no sums still holds one row of this metric, which says what it went through.
MARK = ""


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def foreach_batch_store(derive: Callable[[DataFrame], DataFrame], folder: str, clock_day: Callable[[], str], keep_days: int) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: the signed rows that ``derive`` makes of a batch are stored exactly once, those of days that are closed at
    ``clock_day()`` (keep_days back) beside the others."""

    def signed(batch: DataFrame, late: bool) -> DataFrame:
        rows = derive(batch).select(*KEY, "amount")
        open_ = open_days(rows, "day", clock_day(), keep_days)
        return rows.join(open_.select("day").distinct(), "day", "left_anti").select(*KEY, "amount") if late else open_

    late = foreach_batch_deltas(lambda b: signed(b, True), f"{folder}/late")
    add = foreach_batch_deltas(lambda b: signed(b, False), f"{folder}/deltas")

    def run(batch: DataFrame, batch_id: int) -> None:
        late(batch, batch_id)
        add(batch, batch_id)

    return run


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """day, bucket, metric, value, amount: the sums as of the last fold."""
    return _state(spark, folder).where(F.col("metric") != MARK).select(*KEY, "amount")


def _state(spark: SparkSession, folder: str) -> DataFrame:
    schema = "bucket long, metric string, value double, amount double, through long, day date"
    return spark.read.schema(schema).parquet(f"{folder}/state") if _exists(spark, f"{folder}/state") else spark.createDataFrame([], schema)


def pending(spark: SparkSession, folder: str) -> DataFrame:
    """Deltas that are not in the state of their day yet, with their batch."""
    deltas = spark.read.schema("day date, bucket long, metric string, value double, amount double, batch long").parquet(f"{folder}/deltas")
    through = _state(spark, folder).groupBy("day").agg(F.max("through").alias("through"))  # a row per day
    return deltas.join(through, "day", "left").where("through is null or batch > through").drop("through")


def dirty_days(spark: SparkSession, folder: str) -> list[str]:
    """Days with pending deltas: at most as many as are open."""
    return sorted(str(r["day"]) for r in pending(spark, folder).select("day").distinct().collect())


def fold(spark: SparkSession, folder: str) -> list[str]:
    """Add pending deltas to the state and return the days that were written. Partitions of other days are neither read nor
    touched."""
    days = dirty_days(spark, folder)
    if not days:
        return []
    dirty = F.col("day").isin(*[F.lit(d).cast("date") for d in days])
    new = pending(spark, folder).where(dirty)
    went = new.groupBy("day").agg(F.max("batch").alias("through"))
    sums = _state(spark, folder).where(dirty).select(*KEY, "amount").unionByName(new.select(*KEY, "amount")).groupBy(*KEY).agg(F.sum("amount").alias("amount"))
    marks = went.select("day", F.lit(0).cast("long").alias("bucket"), F.lit(MARK).alias("metric"), F.lit(0.0).alias("value"), F.lit(0.0).alias("amount"))
    rows = sums.where((F.abs("amount") >= 1e-9) & (F.col("metric") != MARK)).unionByName(marks).join(went, "day")
    rows.select("bucket", "metric", "value", "amount", "through", "day").repartition("day", F.pmod(F.xxhash64("metric", "value"), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{folder}/state")
    return days


def extended(work: DataFrame, last: float, clock: float, *, reported: Column | None = None, names: live.Names = live.Names(), keep: Sequence[str] = ()) -> DataFrame:  # noqa: B008
    """Signed rows that let open jobs (``work`` as for ``live.job_contributions``) run on from ``last`` to ``clock``: called for the
    stored open jobs at each trigger, and added as a batch of its own."""
    rows = [live.job_contributions(work, at, reported=reported, names=names, keep=keep).withColumn("amount", F.col("amount") * sign) for at, sign in ((last, -1), (clock, 1))]
    summed = rows[0].unionByName(rows[1]).groupBy(*keep, *KEY).agg(F.sum("amount").alias("amount"))
    return summed.where(F.abs("amount") >= 1e-9)
