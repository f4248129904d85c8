"""Running sums and ranks over keys of any size: a distributed prefix sum.

Rows are dealt to ranges of (keys, order), so that a key with very many rows spreads over many ranges; a total per range and key
gives the ranges' offsets, and each range is summed by itself. No window ever holds a whole key or table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.operators.snapshots import checkpointed


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], amounts: Mapping[str, Column], *, ranges: int | None = None) -> DataFrame:
    """df with a running sum per entry of ``amounts``, over the key's rows up to and with a row in ``order``, and <name>_total over all
    rows of the key. Null amounts count as 0; null keys are a key. The order must be total: rows that it does not tell apart
    stay in one range and are summed in any order.

    The ranges are checkpointed, as their bounds come from a sample and both totals and sums must see the same ones."""
    n = ranges or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hidden = {name: f"_amount_{i}" for i, name in enumerate(amounts)}
    rows = df.withColumns({hidden[name]: F.coalesce(amount, F.lit(0)) for name, amount in amounts.items()})
    rows = checkpointed(rows.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()))
    totals = rows.groupBy(*keys, "_range").agg(*[F.sum(h).alias(h) for h in hidden.values()])
    one = Window.partitionBy(*(keys or [F.lit(0)]))  # a row per range
    before = one.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_range").alias("_r"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(h).over(before), F.lit(0)).alias(f"_before{h}") for h in hidden.values()], *[F.sum(h).over(one).alias(f"_total{h}") for h in hidden.values()],
    )
    here = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_run{h}": F.sum(h).over(here) for h in hidden.values()})
    match = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = rows.join(offsets, match)
    out = {name: F.col(f"_before{h}") + F.col(f"_run{h}") for name, h in hidden.items()} | {f"{name}_total": F.col(f"_total{h}") for name, h in hidden.items()}
    return rows.select(*[F.col(f"`{c}`") for c in df.columns if c not in out], *[c.alias(name) for name, c in out.items()])


def ordered_index(df: DataFrame, order: Sequence[Column], name: str = "index") -> DataFrame:
    """Position from 0 in one global order."""
    return prefix_sums(df, [], order, {name: F.lit(1).cast("long")}).drop(f"{name}_total").withColumn(name, F.col(name) - 1)


def budget_eviction(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], size: str, budget: int, *, fixed: Column | None = None) -> DataFrame:
    """Rows with ``evicted``: over all collections of a key, the first rows in eviction order go until what is left fits the
    budget. ``fixed`` rows count towards the budget but never go. Budgets are kept per key of any size."""
    stays = F.coalesce(fixed, F.lit(False)) if fixed is not None else F.lit(False)
    rows = prefix_sums(df, keys, order, {"_gone": F.when(~stays, F.col(size)), "_all": F.col(size)})
    left = F.col("_all_total") - (F.col("_gone") - F.when(stays, F.lit(0)).otherwise(F.coalesce(F.col(size), F.lit(0))))
    return rows.withColumn("evicted", ~stays & (left > budget)).select(*df.columns, "evicted")


def evicted_counts(rows: DataFrame, keys: Sequence[str], collection: str, size: str) -> DataFrame:
    """Per key and collection: rows and bytes evicted and kept, and whether the collection is still complete."""
    gone = F.col("evicted")
    return rows.groupBy(*keys, collection).agg(
        F.count_if(gone).alias("n_evicted"), F.coalesce(F.sum(F.when(gone, F.col(size))), F.lit(0)).alias("size_evicted"), F.count_if(~gone).alias("n_kept"), (F.count_if(gone) == 0).alias("complete")
    )
