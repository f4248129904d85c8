"""Embedding near-dedup by lattice hashing (operator 7).

Random projections to eight numbers are decoded to the nearest point of the E8 lattice, in TABLES tables. A
vector lives in the cell of its point and also visits the PROBES nearest neighbouring cells (the roots along
which its residue points most). Two vectors meet in a cell where one lives that the other one lives in or visits;
their cosine is then verified in double precision, if their labels are equal.

Exact copies are classed first. A crowded cell is cut into blocks and each pair of blocks is a unit of work. A pair
that meets in several cells counts in one of them only, which both vectors' cell lists tell, so that units return
link counts and spanning forests and never pairs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotally.llm import buckets, e8
from chronotally.llm.common import checkpointed, connected_components, join_few

COSINE = 0.93
TABLES, PROBES = 6, 5
#: Width of a lattice cell in units of the projections' spread. Measured for random pairs at cosine 0.93 in 64
#: dimensions: recall 0.99 with these tables and probes, and one unrelated pair in 800 meets in a table.
WIDTH = 1.25
BLOCK = 1024
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@functools.cache
def _projection(dims: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([5, dims])).standard_normal((TABLES, dims, 8))


def cells(vectors: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(homes, visits): 64-bit cell ids, TABLES columns and TABLES * PROBES columns, of unit vectors (rows)."""

    def ids(points: np.ndarray, table: int) -> np.ndarray:
        h = labels.astype(np.int64).view(np.uint64) * _C[0] + np.uint64(table * 1000 + vectors.shape[1])
        for k in range(8):
            h = (h ^ (h >> np.uint64(31))) * _C[1] + (2 * points[..., k]).astype(np.int64).view(np.uint64)
        return ((h ^ (h >> np.uint64(29))) * _C[2]).view(np.int64)

    homes, visits = [], []
    for t in range(TABLES):
        x = vectors @ _projection(vectors.shape[1])[t] / WIDTH
        point = e8.nearest(x)
        along = (x - point) @ e8.roots().T
        best = np.argsort(-along, axis=1, kind="stable")[:, :PROBES]
        homes.append(ids(point, t))
        visits += [ids(point + e8.roots()[best[:, k]], t) for k in range(PROBES)]
    return np.stack(homes, axis=1), np.stack(visits, axis=1)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component to 0.5 .. 1, which is exact and changes no cosine:
    squares of huge and of tiny components then stay within a double's range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _signed(rows: DataFrame) -> DataFrame:
    """node, kind (its label as text), homes, visits, vector (doubles as bytes) of each valid row."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dims = batch["embedding"].map(len)
            for d, part in batch.groupby(dims.to_numpy()):
                x = scaled(np.stack([np.asarray(v, dtype=np.float64) for v in part["embedding"]]))
                homes, visits = cells(x / np.linalg.norm(x, axis=1)[:, None], part["label"].to_numpy(np.int64))
                yield pd.DataFrame({"node": part["node"].to_numpy(), "kind": part["kind"].to_numpy(), "homes": list(homes), "visits": list(visits), "vector": [v.tobytes() for v in x]})

    kind = F.to_json(F.struct("label")).alias("kind")
    return rows.select("node", kind, F.xxhash64("label").alias("label"), "embedding").mapInPandas(sign, "node string, kind string, homes array<long>, visits array<long>, vector binary")


def _counts_here(cell: np.ndarray, p: np.ndarray, q: np.ndarray, homes: np.ndarray, visits: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Of pairs of rows that meet in ``cell``, those that count there: it is the first table's cell where they meet,
    a common home before a visited one, and the home of the smaller node if each visits the other."""
    where, open_ = np.zeros(len(p), np.int64), np.ones(len(p), bool)
    seen = visits.reshape(len(visits), TABLES, PROBES)
    for t in range(TABLES):
        hp, hq = homes[p, t], homes[q, t]
        p_visits, q_visits = (seen[p, t] == hq[:, None]).any(axis=1), (seen[q, t] == hp[:, None]).any(axis=1)
        meet = open_ & ((hp == hq) | p_visits | q_visits)
        first_home = np.where(nodes[p] < nodes[q], hp, hq)
        at = np.where(p_visits & q_visits, first_home, np.where(p_visits, hq, hp))
        where[meet], open_ = at[meet], open_ & ~meet
    return ~open_ & (where == cell[p])


def _compare(unit: pd.DataFrame, least: float) -> pd.DataFrame:
    unit = unit.drop_duplicates(["cell", "node"]).sort_values(["cell", "node"])
    n, cell, side = len(unit), unit["cell"].to_numpy(np.int64), unit["side"].to_numpy()
    nodes, copies = unit["node"].to_numpy(str), unit["copies"].to_numpy(np.int64)
    homes, visits = np.stack(unit["homes"].to_numpy()), np.stack(unit["visits"].to_numpy())
    dims = unit["vector"].map(len).to_numpy() // 8
    vectors = np.zeros((n, dims.max()))
    for k, v in enumerate(unit["vector"]):
        vectors[k, : dims[k]] = np.frombuffer(v)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    kinds = pd.factorize(unit["kind"])[0]  # a cell is named by a hash of the label too, which alone proves nothing
    links, root = np.zeros(n, np.int64), np.arange(n)
    found_p, found_q = [], []
    for p, q in buckets.pairs(cell, side, unit["i"].iat[0] != unit["j"].iat[0]):
        cosine = np.einsum("ij,ij->i", vectors[p], vectors[q]) / (norms[p] * norms[q])
        near = (cosine >= least) & (dims[p] == dims[q]) & (kinds[p] == kinds[q])
        p, q = p[near], q[near]
        if len(p):
            keep = _counts_here(cell, p, q, homes, visits, nodes)
            p, q = p[keep], q[keep]
            links += np.bincount(p, copies[q], n).astype(np.int64) + np.bincount(q, copies[p], n).astype(np.int64)
            found_p.append(p.astype(np.int32))
            found_q.append(q.astype(np.int32))
    if found_p:
        p, q = np.concatenate(found_p), np.concatenate(found_q)
        root = buckets.forest(n, p, q)
    some = links > 0
    return pd.DataFrame({"node": nodes[some], "links": links[some], "root": nodes[root][some]})


def link(rows: DataFrame, *, least: float = COSINE) -> DataFrame:
    """Links between vectors (vec_id, embedding, label) of equal label with a cosine of at least ``least``.

    One row per row: vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable by
    links, itself included), kept (vec_id = component_id). A vector that is null, empty or zero, or holds a null or
    a non-finite component, and one without a label, links with nothing. Vectors of different lengths never link, labels
    may be of any type that Spark can hash; repeated rows are copies that link with each other. Other columns are ignored; an empty table gives an empty result."""
    number = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", number.alias("embedding"))
    valid = F.coalesce(F.col("label").isNotNull() & finite, F.lit(False))
    rows = rows.withColumn("node", F.when(valid, F.md5(F.to_json(F.struct("label", "embedding")))))
    classes = rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = checkpointed(classes)
    signed = _signed(rows.where("node is not null").dropDuplicates(["node"]))  # rows of one node have equal labels and vectors
    at = signed.select("node", F.explode("homes").alias("cell")).withColumn("home", F.lit(1))
    at = at.unionByName(signed.select("node", F.explode("visits").alias("cell")).withColumn("home", F.lit(0)))
    at = checkpointed(at.distinct())
    used = at.groupBy("cell").agg(F.count("*").alias("n"), F.sum("home").alias("homes")).where("n > 1 and homes > 0")
    used = used.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = at.drop("home").join(used, "cell")
    bundles = max(1, math.ceil(at.count() / (2 * BLOCK)))
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = placed.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.when(F.col("blocks") == 1, F.pmod(F.col("cell"), F.lit(bundles))).otherwise(F.col("cell"))
    placed = placed.select("cell", "node", "side", (F.col("blocks") > 1).alias("crowded"), unit.alias("unit"), F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    fat = placed.join(signed, "node").join(classes.select("node", "copies"), "node")
    links = fat.groupBy("crowded", "unit", "i", "j").applyInPandas(lambda pdf: _compare(pdf, least), "node string, links long, root string")
    links = checkpointed(links)
    components = connected_components(links.where("node <> root"), "node", "root")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    joined = classes.join(components, "node", "left").join(counts, "node", "left")
    least_id = joined.where("component is not null").groupBy("component").agg(F.min("rep").alias("component_id"))
    # rows without a component get a key of their own, lest they all meet in one task
    joined = join_few(joined.withColumn("component", F.coalesce("component", "node")), least_id, "component", F.col("node")).select(F.col("node").alias("_node"), F.coalesce("component_id", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = rows.select("vec_id", "node").join(joined, F.coalesce("node", F.concat(F.lit("-"), "vec_id")) == F.col("_node"), "left")
    component = F.when(F.col("_node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
