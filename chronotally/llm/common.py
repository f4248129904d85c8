"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.llm import buckets

#: Rows up to which a lookup table is broadcast; larger ones are joined by a salted shuffle.
BROADCAST_ROWS = 50_000
SALTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. One is only made up in a local session, as in tests;
    a cluster's session without one is an error, since its executors share no local folder."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="spark-checkpoints-")
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results, wherever the shared folder lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let the driver collect garbage, upon which Spark removes the files of shuffles that no plan refers to any more, and those
    of checkpoints if the session asks for it (spark.cleaner.referenceTracking.cleanCheckpoints). Worth it between two large parts of an operator, of which the second need not find the first one's files."""
    gc.collect()
    spark._jvm.System.gc()


def fresh_name(columns: Sequence[str], name: str) -> str:
    """``name`` with as many leading underscores as it takes to differ from all columns (Spark ignores case)."""
    known = {c.lower() for c in columns}
    while name.lower() in known:
        name = "_" + name
    return name


def with_columns(columns: Sequence[str], added: dict[str, Column], inside: str = "") -> list[Column]:
    """Columns to select: the given ones (of the struct ``inside``) but those that an added one replaces, then the added."""
    names, prefix = {c.lower() for c in added}, f"{inside}." if inside else ""
    return [F.col(f"{prefix}`{c}`") for c in columns if c.lower() not in names] + [column.alias(c) for c, column in added.items()]


def as_row(df: DataFrame) -> Column:
    """All columns as one struct, ``row``, so that names made up inside an operator cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def by_length(lengths: np.ndarray, chars: int = 2_000_000, rows: int = 4096) -> Iterator[np.ndarray]:
    """Indexes of a batch's texts, the longest first, in slices of bounded characters and rows, so that what a Python
    worker holds for a slice is bounded by bytes and not by a number of texts. A text longer than ``chars`` is a slice."""
    order = np.argsort(-lengths, kind="stable")
    start = 0
    while start < len(order):
        within = np.cumsum(lengths[order[start : start + rows]]) <= chars
        end = start + max(1, int(np.count_nonzero(within)))
        yield order[start:end]
        start = end


def join_lookup(rows: DataFrame, lookup: DataFrame, key: str, row_id: Column, n_entries: int) -> DataFrame:
    """Left-join ``lookup`` (one row per non-null ``key``) to ``rows``.

    ``n_entries`` is the measured size of ``lookup``. Up to BROADCAST_ROWS it is broadcast; beyond that
    each of its rows is repeated for every salt and the rows of a hot key are dealt over the salts."""
    if n_entries <= BROADCAST_ROWS:
        return rows.join(F.broadcast(lookup), key, "left")
    return join_few(rows, lookup, key, row_id)


def join_few(rows: DataFrame, lookup: DataFrame, key: str, row_id: Column) -> DataFrame:
    """Left-join ``lookup`` (one row per non-null ``key``, far fewer than rows) to ``rows``, of which one key may hold very
    many and any number none: rows are dealt over SALTS parts of their key, for each of which a lookup row is repeated."""
    salt = fresh_name([*rows.columns, *lookup.columns], "_salt")
    salted = lookup.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn(salt, F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int")).join(salted, [key, salt], "left").drop(salt)


def with_least_neighbour(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """Edges (u, v) with m, the least v of their u. Edges of one u are dealt over SALTS parts: least per part, then of the
    at most SALTS parts of a u, then back to the parts, so that a node with very many edges is not one task's work.
    ``parts`` bounds the tasks that read each exchange."""
    salted = edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    each = in_parts(salted.groupBy("u", "s").agg(F.min("v").alias("m")), parts)
    least = in_parts(each.groupBy("u").agg(F.collect_set("s").alias("all"), F.min("m").alias("m")), parts)  # SALTS entries at most
    least = least.select("u", F.explode("all").alias("s"), "m")
    return in_parts(salted.join(least, ["u", "s"]).select("u", "v", "m"), parts)


def in_parts(df: DataFrame, parts: int | None) -> DataFrame:
    """df in at most so many partitions, without a shuffle."""
    return df if parts is None else df.coalesce(parts)


def _components(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of the few edges of one partition."""
    edges = [batch[["u", "v"]].to_numpy(np.int64) for batch in batches]
    if edges:
        nodes, rows = np.unique(np.concatenate(edges), return_inverse=True)
        rows = rows.reshape(-1, 2)
        yield pd.DataFrame({"node": nodes, "component": nodes[buckets.forest(len(nodes), rows[:, 0], rows[:, 1])]})


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, *, rows_a_part: int | None = None) -> DataFrame:
    """Component of every node of an undirected edge table: (node, component = smallest node reachable).

    Alternates the large-star and small-star steps until the edges no longer change; a node with very many
    edges is dealt over tasks, and every round is checkpointed. With ``rows_a_part`` a round runs in as many tasks as its
    counted edges need, eight at least, and not in one per shuffle partition: most rounds are small, and every task
    leaves files in each of a round's exchanges. As soon as no more edges are left than one part takes, a single task finishes, as
    every further round would add its plans and tasks to what the driver keeps."""
    stars = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    stars, seen, parts = checkpointed(stars), None, None
    n = stars.count() if rows_a_part else 0
    for _ in range(max_rounds):
        if rows_a_part and n <= rows_a_part:
            return checkpointed(stars.coalesce(1).mapInPandas(_components, "node long, component long"))
        if rows_a_part:
            parts = max(8, -(-2 * n // rows_a_part))
            stars = in_parts(stars, parts)
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least_neighbour(both, parts).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        small = with_least_neighbour(in_parts(large.distinct(), parts), parts)
        pairs = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        stars = small.select(F.explode(pairs).alias("p")).select("p.u", "p.v").where("u <> v").distinct()
        stars = checkpointed(in_parts(stars, parts))
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen, n = now, now[0]
    else:
        raise RuntimeError("connected components did not settle")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
