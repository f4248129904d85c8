"""N-gram Jaccard join by MinHash banding (operator 10).

1. Texts are classed by content, so that exact copies cost nothing further. A text's set is its hashed
   word 5-grams (all its words, if it has fewer); MinHash minima are cut into bands, with band and row
   counts chosen for the target recall at the similarity threshold.
2. Classes are shuffled on band hashes. In each bucket, members whose bands agree in at least AGREEING
   places are joined by a spanning forest; connected components of these joints are the candidate groups. A
   passage that many texts share makes pairs agree in one band now and then, hardly ever in three, so that
   such texts do not run together into one group.
3. The texts of candidate groups alone are shingled again, and full sets are compared within each group,
   block by block: a large group is cut into blocks of bounded size, and each pair of blocks is a unit of
   work. A unit returns link counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotally.llm import buckets
from chronotally.llm.common import as_row, checkpointed, connected_components, join_few

N_WORDS = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.995
#: Bands in which a candidate pair must agree.
AGREEING = 3
#: MinHash minima that may be spent on a text.
MINIMA = 256
#: Most shingles and most texts in a block; a unit of work holds two blocks.
BLOCK_SHINGLES, BLOCK_TEXTS = 1 << 18, 1024
#: Rows of a bucket that one unit of the candidate search may hold twice.
BLOCK_ROWS = 2048
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def banding(similarity: float = SIMILARITY, recall: float = TARGET_RECALL, minima: int = MINIMA, agreeing: int = AGREEING) -> tuple[int, int]:
    """(bands, rows): the most rows a band may have so that a pair at the similarity agrees in ``agreeing`` of the
    minima // rows bands with the wanted probability; one row if none reaches it."""
    for rows in range(minima // agreeing, 0, -1):
        bands, p = minima // rows, similarity**rows
        missed = sum(math.comb(bands, k) * p**k * (1 - p) ** (bands - k) for k in range(agreeing))
        if 1 - missed >= recall:
            return bands, rows
    return minima, 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[0]
    return (h ^ (h >> np.uint64(29))) * _MIX[1]


@functools.cache
def _word_characters() -> np.ndarray:
    """Whether a code point belongs to words, as in the regular expression \\w."""
    return np.fromiter((chr(o).isalnum() or o == 95 for o in range(0x110000)), bool, 0x110000)


@functools.cache
def _powers(size: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, _MIX[3])])


def word_hashes(text: str) -> np.ndarray:
    """A hash of every run of word characters of the text: a polynomial of its mixed code points."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _word_characters()[code]
    first = inside & ~np.r_[False, inside[:-1]]
    code = code[inside].astype(np.uint64)
    if not len(code):
        return code
    starts = np.flatnonzero(first[inside])
    sizes = np.diff(np.r_[starts, len(code)])
    place = np.arange(len(code)) - np.repeat(starts, sizes)
    powers = _powers(1 << max(5, int(sizes.max() - 1).bit_length()))
    return _mixed(np.add.reduceat(_mixed(code + np.uint64(1)) * powers[place], starts) + sizes.astype(np.uint64))


def shingles(text: str | None, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams; of all words together if it has fewer; empty without words."""
    h = word_hashes(text.lower()) if text else np.empty(0, np.uint64)
    if not len(h):
        return h
    n = min(n, len(h))
    total = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        total = total * _MIX[2] + h[k : len(h) - n + 1 + k] * _MIX[k % 5] + (h[k : len(h) - n + 1 + k] >> np.uint64(31))
    return np.unique(_mixed(total))


@functools.cache
def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20_240_501))
    return rng.integers(0, 1 << 32, count, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, count, np.uint32)


def band_hashes(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A signed 64-bit hash per band of the set's minima."""
    a, b = _permutations(bands * rows)
    x = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 256):
        np.minimum(least, (x[at : at + 256, None] * a + b).min(axis=0), out=least)
    total = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        total = total * _MIX[2] + least.reshape(bands, rows)[:, k]
    return _mixed(total).view(np.int64)


def _classes(docs: DataFrame, bands: int, rows: int, n: int) -> DataFrame:
    """One row per distinct text with words: node (its md5), rep (smallest doc_id), copies, size, bands."""

    @F.pandas_udf("size int, bands array<long>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, signed = [], []
            for text in batch:  # one text's shingles at a time
                found = shingles(text if isinstance(text, str) else None, n)
                sizes.append(len(found))
                signed.append(band_hashes(found, bands, rows) if len(found) else np.zeros(bands, np.int64))
            yield pd.DataFrame({"size": sizes, "bands": signed})

    signed = docs.select("doc_id", F.md5("text").alias("node"), sign("text").alias("s"))
    least = [F.min(F.col("s.bands")[k]).alias(f"b{k}") for k in range(bands)]  # copies agree: their minimum is the value
    signed = signed.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min("s.size").alias("size"), *least)
    signed = signed.where("size > 0")  # not before: a filter on what sign gives goes below the selection, with a second pass of sign for it
    return signed.select("node", F.xxhash64("node").alias("key"), "rep", "copies", "size", F.array(*[f"b{k}" for k in range(bands)]).alias("bands"))


def _agree(unit: pd.DataFrame) -> pd.DataFrame:
    """Spanning forest of each bucket's members that agree in enough bands: (a, b)."""
    unit = unit.drop_duplicates(["hash", "key"]).sort_values(["hash", "key"])
    hashes, key, side = unit["hash"].to_numpy(np.int64), unit["key"].to_numpy(np.int64), unit["side"].to_numpy()
    bands = np.stack(unit["bands"].to_numpy()).astype(np.int32)
    some = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for p, q in buckets.pairs(hashes, side, unit["i"].iat[0] != unit["j"].iat[0]):
        near = np.count_nonzero(bands[p] == bands[q], axis=1) >= AGREEING
        some.append((p[near], q[near]))
    p, q = (np.concatenate(x) for x in zip(*some, strict=True))
    root = buckets.forest(len(unit), p, q)
    joined = root != np.arange(len(unit))
    return pd.DataFrame({"a": key[joined], "b": key[root[joined]]})


def _candidates(classes: DataFrame) -> DataFrame:
    """key, component of the classes that agree with another one in enough bands; key is a 64-bit hash of the node
    (should two nodes share one, they are only compared in vain)."""
    banded = classes.select("key", F.explode("bands").alias("hash"))
    full = banded.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    rows = banded.join(full.select("hash", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")), "hash")
    rows = rows.withColumn("side", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    bundles = max(1, math.ceil(classes.count() / 256))
    unit = F.when(F.col("blocks") == 1, F.pmod("hash", F.lit(bundles))).otherwise(F.col("hash"))
    rows = rows.select("key", "hash", "side", (F.col("blocks") > 1).alias("crowded"), unit.alias("unit"), F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    short = F.transform("bands", lambda x: F.shiftright(x, 32).cast("int"))
    rows = rows.join(classes.select("key", short.alias("bands")), "key")
    return connected_components(rows.groupBy("crowded", "unit", "i", "j").applyInPandas(_agree, "a long, b long"))


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as a dense matrix.

    Rare elements are counted pair by pair, common ones by products of indicator matrices."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    counts = np.diff(np.r_[starts, len(values)])
    out = np.zeros((n, n), np.float32)
    for df in np.unique(counts[(counts > 1) & (counts <= 48)]).tolist():
        members = owner[starts[counts == df][:, None] + np.arange(df)]
        i, j = np.triu_indices(df, 1)
        for at in range(0, len(members), max(1, 2_000_000 // len(i))):
            some = members[at : at + max(1, 2_000_000 // len(i))]
            flat = np.bincount((some[:, i] * n + some[:, j]).ravel(), minlength=n * n)
            out += flat.reshape(n, n).astype(np.float32)
    out += out.T
    common = np.flatnonzero(counts > 48)
    for at in range(0, len(common), 2048):
        some = common[at : at + 2048]
        column = np.repeat(np.arange(len(some)), counts[some])
        where = np.concatenate([np.arange(s, s + c) for s, c in zip(starts[some].tolist(), counts[some].tolist(), strict=True)])
        part = np.zeros((n, len(some)), np.float32)
        part[owner[where], column] = 1
        out += part @ part.T
    np.fill_diagonal(out, sizes)
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """Smallest index in each row's component of a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


_LINKS = "node string, links long, root string"


def _compare(unit: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links within a unit: node, links (texts and their copies), root (smallest node joined within the unit)."""
    out = []
    for _, rows in unit.groupby("component", sort=False):
        rows = rows.drop_duplicates("node").sort_values("node")
        if len(rows) < 2:
            continue
        sets = [np.frombuffer(b, np.uint64) for b in rows["found"]]
        common = intersections(sets)
        sizes = np.diag(common)
        linked = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-4
        np.fill_diagonal(linked, False)
        side = rows["side"].to_numpy()
        if rows["i"].iat[0] != rows["j"].iat[0]:  # two blocks: pairs within one are another unit's
            linked &= side[:, None] != side[None, :]
        links = linked @ rows["copies"].to_numpy(np.int64)
        some = links > 0
        nodes = rows["node"].to_numpy()
        out.append(pd.DataFrame({"node": nodes[some], "links": links[some], "root": nodes[forest(linked)][some]}))
    return pd.concat(out) if out else pd.DataFrame({"node": pd.Series(dtype=str), "links": pd.Series(dtype="int64"), "root": pd.Series(dtype=str)})


def _verified(docs: DataFrame, classes: DataFrame, groups: DataFrame, similarity: float, n: int) -> DataFrame:
    """node, links, root of each unit of work."""
    members = classes.drop("bands").join(groups.select(F.col("node").alias("key"), F.col("component").cast("string").alias("component")), "key")
    sizes = members.groupBy("component").agg(F.sum("size").alias("total"), F.count("*").alias("texts"))
    blocks = F.greatest(F.ceil(F.col("total") / BLOCK_SHINGLES), F.ceil(F.col("texts") / BLOCK_TEXTS)).cast("int")
    sizes = checkpointed(sizes.select("component", "total", blocks.alias("blocks")))
    small = sizes.where("blocks = 1").agg(F.sum("total")).first()[0] or 0
    bundles = max(1, math.ceil(small / BLOCK_SHINGLES))
    members = join_few(members, sizes.drop("total"), "component", F.col("key")).select(F.col("node").alias("_node"), F.col("rep").alias("_rep"), "copies", "component", "blocks")
    texts = docs.select(F.md5("text").alias("node"), "doc_id", "text")
    texts = texts.join(members, (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_rep")))

    @F.pandas_udf("binary")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingles(t, n).tobytes() for t in batch], dtype=object)

    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = texts.select("component", "node", "copies", "blocks", side.alias("side"), sets("text").alias("found"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(bundles)).cast("string")).otherwise(F.col("component"))
    rows = rows.select("component", "node", "copies", "side", "found", unit.alias("unit"), F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    return rows.groupBy("unit", "i", "j").applyInPandas(lambda pdf: _compare(pdf, similarity), _LINKS)


def link(docs: DataFrame, *, similarity: float = SIMILARITY, recall: float = TARGET_RECALL, n: int = N_WORDS) -> DataFrame:
    """Links between documents whose sets have a Jaccard similarity of at least ``similarity``.

    One row per row of docs: doc_id, node (md5 of the text), class_id (smallest doc_id reachable by links),
    n_links (other rows linked directly, copies included), kept (this row represents its class). A text without
    words, or null, links with nothing, represents itself and has its doc_id as class_id. Repeated rows are
    copies of each other; a null doc_id sorts last. Other columns are ignored; an empty table gives an empty result."""
    bands, rows = banding(similarity, recall)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    classes = checkpointed(_classes(docs, bands, rows, n))
    links = checkpointed(_verified(docs, classes, _candidates(classes), similarity, n))
    components = connected_components(links.where("node <> root"), "node", "root")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    first = F.struct(F.coalesce("rep", F.lit(2**63 - 1)).alias("order"), "rep", "node")
    joined = classes.select("node", "rep", "copies", first.alias("first")).join(components, "node", "left").join(counts, "node", "left")
    heads = joined.where("component is not null").groupBy("component").agg(F.min("first").alias("head"))
    # rows without a component get a key of their own, lest they all meet in one task
    joined = join_few(joined.withColumn("component", F.coalesce("component", "node")), heads, "component", F.col("node")).select("node", "rep", F.coalesce("head", "first").alias("head"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    joined = joined.select(F.col("node").alias("_node"), F.col("head.rep").alias("class_id"), F.col("head.node").alias("_head"), "links")
    keys = docs.select("doc_id", F.md5("text").alias("node"))
    out = keys.join(joined, F.coalesce("node", F.concat(F.lit("-"), "doc_id")) == F.col("_node"), "left")
    kept = F.col("_node").isNull() | ((F.col("node") == F.col("_head")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    class_id = F.when(F.col("_node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return out.select("doc_id", "node", class_id.alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), kept.alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without those that another one of their class represents; of repeated rows one stays.

    Texts without words stay too. All columns of docs stay as they are, whatever their names."""
    lost = link(docs, **options).where("node is not null").groupBy(F.col("doc_id").alias("id"), "node").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    lost = checkpointed(lost.where("not kept or n > 1"))
    rows = docs.select(as_row(docs), F.md5("text").alias("md5"))
    match = F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("md5") == F.col("node"))
    out = rows.join(lost, match, "left_anti")
    again = lost.where("kept and n > 1")
    if not again.isEmpty():
        out = out.unionByName(rows.join(again, match, "left_semi").withColumn("id", F.col("row.doc_id")).dropDuplicates(["id", "md5"]).drop("id"))
    return out.select("row.*")
