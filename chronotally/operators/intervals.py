"""Time buckets, intervals and peaks. Times are epoch microseconds in long columns; windows are half-open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _floor(x: Column, step: int) -> Column:
    return x - F.pmod(x, F.lit(step))


def interval_buckets(df: DataFrame, start: str, end: str, step: int) -> DataFrame:
    """One row per interval and bucket of ``step`` that it touches, with lo and hi, its part in the bucket.

    Empty and reversed intervals touch none. The upper bound is exclusive."""
    some = df.where(F.col(end) > F.col(start))
    buckets = F.sequence(_floor(F.col(start), step), _floor(F.col(end) - 1, step), F.lit(step))
    rows = some.withColumn("bucket", F.explode(buckets))
    return rows.withColumn("lo", F.greatest(F.col(start), "bucket")).withColumn("hi", F.least(F.col(end), F.col("bucket") + step))


def bucket_utilisation(df: DataFrame, keys: Sequence[str], start: str, end: str, step: int, weight: Column | None = None) -> DataFrame:
    """Weighted mean number of open intervals per (bucket, keys): busy is whole microseconds, used is busy / step."""
    rows = interval_buckets(df, start, end, step)
    busy = F.sum((F.col("hi") - F.col("lo")) * (F.lit(1) if weight is None else weight))
    return rows.groupBy("bucket", *keys).agg(busy.alias("busy")).withColumn("used", F.col("busy") / step)


def queue_depth_events(df: DataFrame, keys: Sequence[str], start: str, end: str, step: int, weight: Column | None = None) -> DataFrame:
    """+weight and -weight at the ends of each interval's part in each bucket."""
    rows = interval_buckets(df, start, end, step).withColumn("w", F.lit(1) if weight is None else weight)
    ends = F.array(F.struct(F.col("lo").alias("at"), F.col("w").alias("delta")), F.struct(F.col("hi").alias("at"), (-F.col("w")).alias("delta")))
    return rows.select("bucket", *keys, F.explode(ends).alias("e")).select("bucket", *keys, "e.at", "e.delta")


def peak_concurrency(df: DataFrame, keys: Sequence[str], start: str, end: str, step: int, weight: Column | None = None) -> DataFrame:
    """Most intervals open at once per (bucket, keys), at least 0. Changes of one instant are netted first, so that
    an interval that ends as another starts does not overlap it."""
    events = queue_depth_events(df, keys, start, end, step, weight)
    net = events.groupBy("bucket", *keys, "at").agg(F.sum("delta").alias("delta"))
    depth = F.sum("delta").over(Window.partitionBy("bucket", *keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    return net.withColumn("depth", depth).groupBy("bucket", *keys).agg(F.greatest(F.max("depth"), F.lit(0)).alias("peak"))


def trailing_wait(df: DataFrame, keys: Sequence[str], created: str, started: str, step: int, trail: int) -> DataFrame:
    """Longest wait per bucket; a wait counts in every bucket whose end lies in [started, started + max(step, trail))."""
    reach = max(step, trail)
    first = _floor(F.col(started) - 1, step) + step
    ends = F.sequence(first, first + F.floor((F.col(started) + reach - 1 - first) / step).cast("long") * step, F.lit(step))
    rows = df.withColumn("bucket_end", F.explode(ends))
    return rows.groupBy((F.col("bucket_end") - step).alias("bucket"), *keys).agg(F.max(F.greatest(F.col(started) - F.col(created), F.lit(0))).alias("wait"))


def close_open_intervals(df: DataFrame, end: str, parent_end: Column, clock: int, longest: int, start: str) -> DataFrame:
    """``closed``: own end, else the parent's if it has ended, else the clock; not past the clock or ``longest`` after start."""
    closed = F.least(F.coalesce(F.col(end), parent_end, F.lit(clock)), F.lit(clock), F.col(start) + longest)
    return df.withColumn("closed", F.greatest(closed, F.col(start)))


def sampling_cutover(df: DataFrame, start: str, end: str, cutover: str, weight: str) -> DataFrame:
    """Split intervals at the cutover: ``weight`` before it, 1 after; parts that are empty or weigh 0 go."""
    before = F.struct(F.col(start).alias("a"), F.least(F.col(end), F.col(cutover)).alias("b"), F.col(weight).cast("double").alias("w"))
    after = F.struct(F.greatest(F.col(start), F.col(cutover)).alias("a"), F.col(end).alias("b"), F.lit(1.0).alias("w"))
    rows = df.withColumn("_p", F.explode(F.array(before, after)))
    return rows.where("_p.b > _p.a and _p.w <> 0").select(*df.columns, F.col("_p.a").alias("part_start"), F.col("_p.b").alias("part_end"), F.col("_p.w").alias("part_weight"))


def dense_grid(df: DataFrame, bucket: str, step: int, n: int, clock: int, values: Sequence[str]) -> DataFrame:
    """The last n buckets before ceil(clock / step), with null where there is no row."""
    last = -(-clock // step) * step
    grid = df.sparkSession.range(n).select((F.lit(last - n * step) + F.col("id") * step).alias(bucket))
    return grid.join(df.select(bucket, *values), bucket, "left")


def uncovered_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, lo: int, hi: int, slice_: int = 3_600_000_000) -> DataFrame:
    """Parts of [lo, hi) that no interval of the key covers. Keys are cut into time slices of ``slice_``, each of which
    starts from the largest end of the slices before it, so that a hot key is spread over many tasks."""
    inside = df.where((F.col(end) > lo) & (F.col(start) < hi) & (F.col(end) > F.col(start)))
    inside = inside.select(*keys, F.greatest(F.col(start), F.lit(lo)).alias("a"), F.least(F.col(end), F.lit(hi)).alias("b"))
    edge = df.select(*keys).distinct().withColumns({"a": F.lit(hi), "b": F.lit(hi)})
    rows = inside.unionByName(edge).withColumn("_s", F.floor((F.col("a") - F.lit(lo)) / slice_))
    before = F.max("b").over(Window.partitionBy(*keys, "_s").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1))
    slices = rows.groupBy(*keys, "_s").agg(F.max("b").alias("_tail"))  # one row per key and slice
    carry = F.max("_tail").over(Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_s").alias("_k"), carry.alias("_carry"))
    same = F.col("_s") == F.col("_k")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = rows.withColumn("_before", before).join(slices, same).withColumn("gap_start", F.greatest("_before", "_carry", F.lit(lo)))
    return rows.where("a > gap_start").select(*keys, "gap_start", F.col("a").alias("gap_end"))


def rolling_windows(df: DataFrame, keys: Sequence[str], at: str, clock: int, widths: Sequence[int], bin_: int = 60_000_000) -> DataFrame:
    """Counts per key and width in [through - width, through), through being the clock's last whole bin; from bins."""
    through = clock - clock % bin_
    bins = df.where((F.col(at) >= through - max(widths)) & (F.col(at) < through)).groupBy(*keys, _floor(F.col(at), bin_).alias("bin")).agg(F.count("*").alias("n"))
    spans = F.explode(F.array(*[F.lit(w).cast("long") for w in widths]))
    return bins.withColumn("width", spans).where(F.col("bin") >= F.lit(through) - F.col("width")).groupBy(*keys, "width").agg(F.sum("n").alias("n"))
