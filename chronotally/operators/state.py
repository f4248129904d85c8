"""Latest state, deduplication, snapshots, retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order``: a partial aggregate, not a window."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(*order, F.struct(*rest).alias("_r"))).alias("_m")).select(*keys, "_m._r.*")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row per key by ``order``."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("_r")))
    return df.groupBy(*keys).agg(best.alias("_m")).select(*keys, "_m._r.*")


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns replaced by their last non-null value up to each row."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})


def snapshot_merge(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Field-wise merge of a key's snapshots: each column takes its value in the best snapshot that knows it."""
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns])


def assemble_frames(df: DataFrame) -> DataFrame:
    """Snapshots whose frames (source, epoch, sequence, snapshot, part, parts, digest) are all there and agree.

    state: complete, incomplete, conflict (a part came with two contents), or fenced (a newer complete one exists)."""
    by = ["source", "epoch", "sequence", "snapshot"]
    parts = df.groupBy(*by, "part").agg(F.min("parts").alias("lo"), F.max("parts").alias("hi"), F.count_distinct("digest").alias("n"))
    whole = parts.groupBy(*by).agg(F.min("lo").alias("lo"), F.max("hi").alias("parts"), F.count("*").alias("got"), F.min("part").alias("first"), F.max("part").alias("last"), F.max("n").alias("n"))
    ok = (F.col("lo") == F.col("parts")) & (F.col("got") == F.col("parts")) & (F.col("first") == 0) & (F.col("last") == F.col("parts") - 1)
    whole = whole.withColumn("state", F.when((F.col("n") > 1) | (F.col("lo") != F.col("parts")), "conflict").when(ok, "complete").otherwise("incomplete"))
    newest = whole.where("state = 'complete'").groupBy(F.col("source").alias("_s")).agg(F.max(F.struct("epoch", "sequence")).alias("_new"))
    whole = whole.join(newest, F.col("source") == F.col("_s"), "left")
    fenced = F.coalesce(F.struct("epoch", "sequence") < F.col("_new"), F.lit(False))
    return whole.select(*by, "parts", "got", F.when(fenced, "fenced").otherwise(F.col("state")).alias("state"))


def apply_snapshot(state: DataFrame, changes: DataFrame, keys: Sequence[str], deleted: str, *, full: bool) -> DataFrame:
    """State after a frame: a full one keeps only its own rows, a delta upserts and deletes."""
    live = changes.where(~F.col(deleted)).drop(deleted)
    if full:
        return live
    return state.join(changes.select(*keys).distinct(), list(keys), "left_anti").unionByName(live)


def changed_keys(old: DataFrame, new: DataFrame, id_: str, key: str) -> DataFrame:
    """Keys touched by rows that differ: of the old row and of the new row."""
    cols = [c for c in old.columns if c != id_]
    a = old.select(id_, F.struct(*cols).alias("_a"))
    b = new.select(id_, F.struct(*cols).alias("_b"))
    rows = a.join(b, id_, "full").where(~F.col("_a").eqNullSafe(F.col("_b")))
    touched = F.array_distinct(F.array_compact(F.array(F.col(f"_a.{key}"), F.col(f"_b.{key}"))))
    return rows.select(F.explode(touched).alias(key)).distinct()


def topn_retention(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limits: Mapping[str, int], by: str) -> DataFrame:
    """The newest rows per key, as many as the limit of its ``by`` value allows."""
    limit = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_r", rank).where(F.col("_r") <= F.coalesce(F.element_at(limit, F.col(by)), F.lit(0))).drop("_r")


def merge_cursors(a: DataFrame, b: DataFrame, key: str, at: str) -> DataFrame:
    """Union of two watermark tables with the earlier instant per key."""
    return a.select(key, at).unionByName(b.select(key, at)).groupBy(key).agg(F.min(at).alias(at))


def scope_filter(parents: DataFrame, children: DataFrame, allowed: DataFrame, scope: str, parent_key: str) -> tuple[DataFrame, DataFrame]:
    """Parents in allowed scopes and the children of those that stay."""
    kept = parents.join(allowed.select(scope).distinct(), scope, "left_semi")
    return kept, children.join(kept.select(parent_key).distinct(), parent_key, "left_semi")


def retention_filter(df: DataFrame, created: str, klass: str, lifetimes: Mapping[str, int], default: int, clock: int) -> DataFrame:
    """Rows younger than the lifetime of their class."""
    life = F.coalesce(F.element_at(F.create_map(*[x for k, v in lifetimes.items() for x in (F.lit(k), F.lit(v))]), F.col(klass)), F.lit(default))
    return df.where(F.col(created) >= F.lit(clock) - life)
