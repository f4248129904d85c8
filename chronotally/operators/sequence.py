"""Ordered analytics: neighbours, segments, gaps, ranks. Windows are always partitioned by a key or a coarse bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.operators.prefix import ordered_index


def consecutive_pairs(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each row with the previous row's columns as prev_<column>; null on the first of a key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({f"prev_{c}": F.lag(c).over(window) for c in columns})


def change_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], at: str) -> DataFrame:
    """A segment starts where any of the columns differs from the row before; it ends where the next one starts."""
    window = Window.partitionBy(*keys).orderBy(*order)
    here = F.struct(*columns)
    starts = df.withColumn("_prev", F.lag(here).over(window)).where(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(here))
    return starts.select(*keys, *columns, F.col(at).alias("seg_start"), F.lead(at).over(window).alias("seg_end"))


def first_in_segment(segments: DataFrame, rows: DataFrame, keys: Sequence[str], at: str, when: Column) -> DataFrame:
    """Segments with ``first_at``: the first row of the key in [seg_start, seg_end) that meets the condition.

    Both sides are unioned and read backwards in time, where the last row passed is the next one: one window, no product."""
    hits = rows.where(when).dropna(subset=[*keys, at])
    a = segments.select(*keys, F.col("seg_start").alias("_t"), F.lit(0).alias("_o"), F.struct(*segments.columns).alias("_s"), F.lit(None).cast(hits.schema[at].dataType).alias("_at"))
    b = hits.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_o"), F.lit(None).cast(a.schema["_s"].dataType).alias("_s"), F.col(at).alias("_at"))
    window = Window.partitionBy(*keys).orderBy(F.col("_t").desc(), F.col("_o").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = a.unionByName(b).withColumn("_next", F.last("_at", ignorenulls=True).over(window)).where("_s is not null")
    inside = F.col("_s.seg_start").isNotNull() & (F.col("_s.seg_end").isNull() | (F.col("_next") < F.col("_s.seg_end")))
    return found.select("_s.*", F.when(inside, F.col("_next")).alias("first_at"))


def observation_gaps(df: DataFrame, keys: Sequence[str], at: str, lo: int, hi: int, most: int) -> DataFrame:
    """Largest gap between samples in [lo, hi), the window's edges included, and how many exceed ``most``."""
    inside = df.where((F.col(at) >= lo) & (F.col(at) < hi)).select(*keys, F.col(at).alias("at"))
    edges = df.select(*keys).distinct().withColumn("at", F.explode(F.array(F.lit(lo), F.lit(hi))))
    gap = F.col("at") - F.lag("at").over(Window.partitionBy(*keys).orderBy("at"))
    return inside.unionByName(edges).withColumn("gap", gap).groupBy(*keys).agg(F.max("gap").alias("max_gap"), F.count_if(F.col("gap") > most).alias("n_long"))


def gap_broken_series(df: DataFrame, keys: Sequence[str], at: str, value: str, complete: Column, most: int) -> DataFrame:
    """The series with a null point just before a sample that follows a gap longer than ``most``, and null where a
    sample is incomplete."""
    df = df.withColumn("_gap", F.col(at) - F.lag(at).over(Window.partitionBy(*keys).orderBy(at)))
    point = F.struct(F.col(at).alias("at"), F.when(complete, F.col(value).cast("double")).alias("value"))
    broken = F.struct((F.col(at) - 1).alias("at"), F.lit(None).cast("double").alias("value"))
    points = F.when(F.col("_gap") > most, F.array(broken, point)).otherwise(F.array(point))
    return df.select(*keys, F.explode(points).alias("p")).select(*keys, "p.at", "p.value")


def first_last_max(df: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    """First, last and largest value by time (ties of time: the smaller value first)."""
    order = F.struct(at, value)
    return df.groupBy(*keys).agg(F.min(order).alias("_f"), F.max(order).alias("_l"), F.max(value).alias("max_value")).select(*keys, F.col(f"_f.{value}").alias("first_value"), F.col(f"_l.{value}").alias("last_value"), "max_value")


def censored_arrivals(snapshots: DataFrame, at: str, items: str) -> DataFrame:
    """Per item: hi, the snapshot that first held it, and lo, the snapshot before (null for the initial backlog). An item
    may be a struct, as (number, version): each version of it then arrives by itself."""
    first = snapshots.select(F.col(at).alias("hi"), F.explode(items).alias("item")).groupBy("item").agg(F.min("hi").alias("hi"))
    times = snapshots.select(F.col(at).alias("at")).distinct()
    before = ordered_index(times, [F.col("at")], "k")
    earlier = before.select(F.col("at").alias("lo"), (F.col("k") + 1).alias("k"))
    return first.join(before, first["hi"] == before["at"]).join(earlier, "k", "left").select("item", "lo", "hi")

