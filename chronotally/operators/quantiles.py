"""Exact quantiles by three rules. They differ on purpose and are not interchangeable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.operators.prefix import prefix_sums


def weighted_quantile(df: DataFrame, keys: Sequence[str], value: str, weight: Column, q: float) -> DataFrame:
    """First value whose running weight reaches max(1, ceil(total * q)). Equal values are added up first, so a hot
    key shuffles its distinct values only; however many these are, they are summed in ranges and never meet in one task."""
    return weighted_quantiles(df, keys, value, weight, {"quantile": q}).drop("total")


def weighted_quantiles(df: DataFrame, keys: Sequence[str], value: str, weight: Column, ranks: dict[str, float]) -> DataFrame:
    """total weight and several of weighted_quantile()'s quantiles by name, from one pass."""
    sums = df.groupBy(*keys, F.col(value).alias("value")).agg(F.sum(weight).alias("w"))
    run = prefix_sums(sums, keys, ["value"], {"run": F.col("w")}).withColumnRenamed("run_total", "total")
    first = lambda q: F.min(F.when(F.col("run") >= F.greatest(F.lit(1), F.ceil(F.col("total") * F.lit(q))), F.col("value")))
    return run.groupBy(*keys).agg(F.max("total").alias("total"), *[first(q).alias(name) for name, q in ranks.items()])


def _nth(df: DataFrame, keys: Sequence[str], value: str, rank: Column) -> DataFrame:
    """Value at 1-based ``rank`` (an expression over n) of the sorted values, from counts of distinct values."""
    sums = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("value")).agg(F.count("*").alias("c"))
    window = Window.partitionBy(*keys)
    run = sums.withColumns({"run": F.sum("c").over(window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("c").over(window)})
    return run.where(F.col("run") >= rank).groupBy(*keys).agg(F.min("value").alias("quantile"))


def report_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float) -> DataFrame:
    """sorted[min(n - 1, int(q * n))]."""
    return _nth(df, keys, value, F.least(F.col("n"), F.floor(F.lit(q) * F.col("n")) + 1))


def report_quantiles(df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, float]) -> DataFrame:
    """Several of report_quantile()'s quantiles by name, from one pass."""
    sums = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("value")).agg(F.count("*").alias("c"))
    window = Window.partitionBy(*keys)
    run = sums.withColumns({"run": F.sum("c").over(window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("c").over(window)})
    first = lambda q: F.min(F.when(F.col("run") >= F.least(F.col("n"), F.floor(F.lit(q) * F.col("n")) + 1), F.col("value")))
    return run.groupBy(*keys).agg(*[first(q).alias(name) for name, q in ranks.items()])


def replay_percentile(df: DataFrame, keys: Sequence[str], value: str, q: float) -> DataFrame:
    """sorted[int((n - 1) * q)]."""
    return _nth(df, keys, value, F.floor((F.col("n") - 1) * F.lit(q)) + 1)
