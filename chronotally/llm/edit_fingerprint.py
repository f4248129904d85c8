"""Document fingerprints by a randomised edit embedding (operator 6).

A shared random walk reads the text: at step j the walk stands on a character, emits it, and moves on if the
shared bit r(j, character) is 1. Walks of texts that differ by few edits fall back into step, so that the
Hamming distance of the emitted strings follows the edit distance. Every walk goes on to the end of its own text,
after about 2 n steps for n characters; it is kept at SAMPLES shared random steps in each octave [2**k, 2**(k+1)) of
steps, as four hash bits each, so that short and very long texts get fingerprints of fitting size. Bands of sampled
places select candidates among all documents, and verification compares whole fingerprints.

The randomness is a table of PERIOD steps by CLASSES character classes. Its rows are read in another order in every
period, so that walks that are a multiple of PERIOD apart see different bits. Characters of one class (1 in 255) look
alike to the walk: an edit that changes one into the other is not seen, which raises a likeness by that share of the
edits. Neither touches the rule that equal texts have equal fingerprints.
"""

from __future__ import annotations

import functools
import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotally.llm import buckets
from chronotally.llm.common import by_length, checkpointed, connected_components, join_few, release_shuffles, remove_folder, shared_folder

SAMPLES = 64
FIRST_OCTAVE = 5  # steps 0..31 form the first block
OCTAVES = 31
PERIOD = 8192  # rows of the table of shared bits
CLASSES = 256  # characters are hashed to classes
LIKENESS = 0.8
#: Share of the pairs at LIKENESS that the bands of one level shall find; most pairs share two levels.
TARGET_RECALL = 0.9
#: Chance that two unrelated texts agree in a sampled place: 1 in 16, and more as letters have different frequencies.
BY_CHANCE = 0.15
LADDER = np.array([1, *range(2, 32, 2), *range(32, 64 * 32, 16)])  # numbers of sampled steps that bands are drawn for
BLOCK_ROWS = 2000  # fingerprints of a bucket that are compared with as many in one task
PAIRS = 8000  # compared at a time
EDGES_A_TASK = 100_000  # links that a task of the search for components takes
CROWD = 64  # classes of a bucket beyond which they are compared with the smallest one first


def banding(n_classes: int, least: float = LIKENESS, recall: float = TARGET_RECALL) -> tuple[int, int]:
    """(bands, places): so many places that unrelated texts share a band less than once a document, and so many bands
    that a pair at the likeness shares one with the wanted probability."""
    places = max(8, math.ceil(math.log(max(2, n_classes)) / -math.log(BY_CHANCE)) + 1)
    agree = least * 15 / 16 + 1 / 16
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - agree**places))), places


class Walk:
    """The shared randomness: bits by (step, class), sampled steps in order, and the hash digit of a sampled class."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.Generator(np.random.PCG64(seed))
        self.bits = rng.integers(0, 2, (PERIOD, CLASSES), np.uint8)
        self.bits[:, 0] = 0  # class 0 is the end of the text: the walk stays there
        self.digits = rng.integers(1, 17, (PERIOD, CLASSES), np.uint8)
        self.digits[:, 0] = 0
        edges = [0] + [1 << k for k in range(FIRST_OCTAVE, OCTAVES + 1)]
        places = [np.sort(rng.choice(hi - lo, min(SAMPLES, hi - lo), replace=False) + lo) for lo, hi in zip(edges, edges[1:], strict=False)]
        self.sampled = np.concatenate(places)
        self.starts = np.cumsum([0] + [len(p) for p in places])
        self.widths, self.lows = np.diff(edges), np.array(edges[:-1])
        self.orders = np.r_[0, rng.integers(1, PERIOD, 1023)]

    def classes(self, text: str) -> np.ndarray:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return (code * np.uint32(2654435761) >> np.uint32(12)) % np.uint32(CLASSES - 1) + np.uint32(1)

    def row(self, step: int) -> int:
        """Row of the tables that a step reads: in every period another order of the rows."""
        period, within = divmod(step, PERIOD)
        return within ^ int(self.orders[period % len(self.orders)])

    def fingerprints(self, texts: list[str]) -> list[str]:
        """Walks of a slice of texts of like length advance together, each to its own text's end."""
        out: list[str] = [""] * len(texts)
        for some in by_length(np.array([len(t) for t in texts], np.int64)):
            for i, found in zip(some.tolist(), self._walked([texts[i] for i in some]), strict=True):
                out[i] = found
        return out

    def _walked(self, texts: list[str]) -> list[str]:
        codes = [x for t in texts for x in (self.classes(t).astype(np.uint8), np.zeros(1, np.uint8))]
        sizes = np.array([len(c) for c in codes[::2]], np.int64) + 1
        joined = np.concatenate(codes) if codes else np.empty(0, np.uint8)
        del codes
        position, rows = np.cumsum(sizes) - sizes, np.arange(len(texts))
        columns: list[np.ndarray] = []  # digits at a sampled step: 0 at the end, else 1 + digit
        wanted, step = iter([*self.sampled.tolist(), -1]), 0
        next_wanted = next(wanted)
        while len(rows):
            seen, row = joined.take(position), self.row(step)
            if next_wanted == step:
                column = np.zeros(len(texts), np.uint8)
                column[rows] = self.digits[row].take(seen)
                columns.append(column)
                next_wanted = next(wanted)
            if not step % 256:  # those at their end are set aside now and then
                going = seen > 0
                position, rows, seen = position[going], rows[going], seen[going]
            position += self.bits[row].take(seen)
            step += 1
        taken = np.stack(columns, axis=1) if columns else np.zeros((len(texts), 0), np.uint8)
        alphabet = np.frombuffer(b"0123456789abcdef", np.uint8)
        return [alphabet[x[: np.count_nonzero(x)] - 1].tobytes().decode() for x in taken]

    def likeness(self, a: str, b: str) -> float:
        """Estimated share of steps at which the two walks agree, of those of the longer walk, without agreement by chance."""
        n = min(len(a), len(b))
        if not n:
            return float(len(a) == len(b))
        na, nb = self.sampled[len(a) - 1] + 1, self.sampled[len(b) - 1] + 1
        same = np.frombuffer(a.encode(), np.uint8)[:n] == np.frombuffer(b.encode(), np.uint8)[:n]
        octaves = int(np.searchsorted(self.starts, n))
        starts = self.starts[:octaves]
        agree = np.add.reduceat(same, starts, dtype=np.float64) / np.diff(np.r_[starts, n])
        lows = self.lows[:octaves]
        both = np.clip(min(na, nb) - lows, 0, self.widths[:octaves])
        share = float((both * agree).sum()) / max(na, nb)
        return min(1.0, max(0.0, (share - 1 / 16) / (15 / 16)))

    def likenesses(self, digits: np.ndarray, sizes: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """likeness() of the pairs (p, q) of rows of a matrix of digits, of which each row has sizes[row], at least one."""
        least, columns = np.minimum(sizes[p], sizes[q]), np.arange(digits.shape[1])
        octaves = int(np.searchsorted(self.starts, digits.shape[1]))
        starts, ends, lows = self.starts[:octaves], np.minimum(self.starts[1 : octaves + 1], digits.shape[1]), self.lows[:octaves]
        same = (digits[p] == digits[q]) & (columns < least[:, None])
        counted = np.clip(np.minimum(ends, least[:, None]) - starts, 1, None)
        agree = np.add.reduceat(same, starts, axis=1, dtype=np.float64) / counted
        na, nb = self.sampled[sizes[p] - 1] + 1, self.sampled[sizes[q] - 1] + 1
        both = np.clip(np.minimum(na, nb)[:, None] - lows, 0, self.widths[:octaves])
        share = (both * agree).sum(axis=1) / np.maximum(na, nb)
        return np.clip((share - 1 / 16) / (15 / 16), 0.0, 1.0)

    @functools.cache  # noqa: B019  one walk a process
    def levels(self, size: int, least: float) -> list[int]:
        """Steps of LADDER that a fingerprint of ``size`` digits has bands for: from that of the shortest fingerprint which can
        be ``least`` like it to its own. Of two that can, the longer one so has the bands of the shorter one's own step."""
        if not size:
            return []
        shortest = 1 + int(np.searchsorted(self.sampled + 1, (least * 15 / 16 + 1 / 16) * (self.sampled[size - 1] + 1) - 1e-6))
        low, high = np.searchsorted(LADDER, [shortest, size], "right") - 1
        return LADDER[low : high + 1].tolist()

    @functools.cache  # noqa: B019
    def places(self, n: int, bands: int, places: int) -> np.ndarray:
        """bands x places shared random places of the first n, each drawn by the steps it stands for, as likeness weighs them."""
        counts = np.diff(self.starts)
        weight = np.repeat(self.widths / counts, counts)[:n]
        return np.random.Generator(np.random.PCG64([11, n])).choice(n, (bands, places), p=weight / weight.sum())

    def bands(self, fingerprint: str, bands: int, places: int, least: float = LIKENESS) -> list[bytes]:
        """Bit-sampled bands: the digits (four hash bits each) at shared random places among the first n, for each n of levels()."""
        digits = np.frombuffer(fingerprint.encode(), np.uint8)
        out = [b"%d:%d:%s" % (n, k, row.tobytes()) for n in self.levels(len(digits), least) for k, row in enumerate(digits[self.places(n, bands, places)])]
        return out or [b"0:0:" + digits.tobytes()]


_walk: list[Walk] = []


def walk() -> Walk:
    if not _walk:
        _walk.append(Walk())
    return _walk[0]


def packed(fingerprint: str) -> bytes:
    """Two digits a byte behind a byte that tells whether the last one is half used."""
    return bytes([len(fingerprint) % 2]) + bytes.fromhex(fingerprint + "0" * (len(fingerprint) % 2))


def unpacked(raw: bytes) -> str:
    return raw[1:].hex()[: 2 * (len(raw) - 1) - raw[0]]


def digits_of(prints: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(digits, sizes): a matrix of the digits of packed fingerprints and how many each of them has."""
    sizes = np.array([2 * (len(x) - 1) - x[0] for x in prints], np.int64)
    width = max((len(x) - 1 for x in prints), default=0)
    raw = np.frombuffer(b"".join(x[1:].ljust(width, b"\0") for x in prints), np.uint8).reshape(len(prints), width)
    return np.stack([raw >> 4, raw & 15], axis=2).reshape(len(prints), 2 * width), sizes


@F.pandas_udf(T.BinaryType())
def packed_fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([packed(f) for f in walk().fingerprints([t if isinstance(t, str) else "" for t in batch])], dtype=object)


_COMPARED = T.StructType([T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")] + [T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")])


@F.pandas_udf(_COMPARED)
def compared(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Fingerprints of texts and of their edited texts, and their likenesses; every distinct text of a batch is walked once."""
    w = walk()
    for texts, following in batches:
        texts, following = texts.tolist(), following.tolist()
        edited = [edited_text(a, b) for a, b in zip(texts, following, strict=True)]
        distinct = list(dict.fromkeys([*texts, *following, *edited]))
        found = dict(zip(distinct, w.fingerprints(distinct), strict=True))
        prints, after, next_ = ([found[t] for t in some] for some in (texts, edited, following))
        yield pd.DataFrame({
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], "fingerprint": prints, "edited_fingerprint": after,
            "near_edited": [w.likeness(a, b) for a, b in zip(prints, after, strict=True)], "near_next": [w.likeness(a, b) for a, b in zip(prints, next_, strict=True)],
        })


def edited_text(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many, or all, of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(rows: DataFrame, columns: list[str], *, marks: DataFrame | None = None, rows_in_part: int = 2000, most_parts: int = 20_000) -> DataFrame:
    """Add next_<column> of the next row by descending doc_id (after the last: of the first). Ties go by text, nulls come last.

    doc_ids are cut into ranges at approximate quantiles. The first row of every range is also sent, as a guest, to
    the range before it, so that each range finds its rows' successors by itself: one shuffle, no global window.
    ``marks`` (doc_id, mark) are dealt to the same ranges and give each row the mark of its doc_id, so that a narrow
    table costs no second shuffle of the rows. The driver holds the cuts and one doc_id per range."""
    order = F.coalesce("doc_id", F.lit(-(2**63)))
    parts = min(most_parts, -(-rows.count() // rows_in_part))
    cuts = np.empty(0, np.int64)
    if parts > 1:
        cuts = np.unique(rows.select(F.percentile_approx(order, [k / parts for k in range(1, parts)], 20 * parts)).first()[0])

    @F.pandas_udf("int")
    def part_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, at.to_numpy(np.int64), "right").astype(np.int32))

    parted = rows.select(order.alias("_order")).withColumn("_part", part_of("_order"))
    heads = {r["_part"]: r["head"] for r in parted.groupBy("_part").agg(F.max("_order").alias("head")).collect()}
    ranges = sorted(heads, reverse=True)
    head_of = np.array([heads[p] for p in ranges][::-1], np.int64)  # ascending
    before = np.array([ranges[k - 1] for k in range(len(ranges))][::-1], np.int32)  # the first range's head goes to the last range

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("p", T.IntegerType()), T.StructField("g", T.IntegerType())])))
    def places_of(at: pd.Series) -> pd.Series:
        """A row's own range, and as a guest (g = 1) the range before it if the row is its range's head."""
        at = at.to_numpy(np.int64)
        part = np.searchsorted(cuts, at, "right").tolist()
        k = np.minimum(np.searchsorted(head_of, at), len(head_of) - 1)
        guest = np.where(head_of[k] == at, before[k], -1).tolist()
        return pd.Series([[(p, 0), (g, 1)] if g >= 0 else [(p, 0)] for p, g in zip(part, guest, strict=True)], dtype=object)

    dealt = rows.withColumn("_order", order).withColumn("_e", F.explode(places_of("_order")))
    if marks is not None:
        noted = marks.withColumn("_order", order).withColumn("_e", F.struct(part_of("_order").alias("p"), F.lit(-1).alias("g")))
        dealt = dealt.unionByName(noted, allowMissingColumns=True)
    dealt = dealt.repartition(max(12, len(ranges)), "_e.p")
    if marks is not None:
        dealt = dealt.withColumn("mark", F.max("mark").over(Window.partitionBy("_e.p", "_order"))).where("_e.g >= 0")
    window = Window.partitionBy("_e.p").orderBy("_e.g", F.col("_order").desc(), "text")
    dealt = dealt.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns])
    return dealt.where("_e.g = 0").drop("_e", "_order")


def fingerprints(docs: DataFrame, *, least: float = LIKENESS) -> DataFrame:
    """Fingerprint every whole text and its edited text: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, and group_id: the smallest doc_id of the group that near_duplicates()
    finds for this document, its own if it is alone.

    A null text counts as empty; a text without a character has the fingerprint ''. Equal texts have equal
    fingerprints. Rows with one doc_id follow each other by text and share a group; a null doc_id has no group. A table
    of one row is its own successor. Other columns are ignored; an empty table gives an empty result."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    groups = near_duplicates(rows, least=least).withColumnRenamed("group_id", "mark")
    release_shuffles(docs.sparkSession)
    rows = with_next(rows, ["text"], marks=groups).withColumn("c", compared("text", "next_text"))
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "c.*", F.coalesce("mark", "doc_id").alias("group_id"))


@F.pandas_udf(T.BooleanType())
def _alike_pair(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    w = walk()
    for a, b, least in batches:
        out = np.zeros(len(a), bool)
        for at in range(0, len(a), PAIRS):
            digits, sizes = digits_of([*a[at : at + PAIRS], *b[at : at + PAIRS]])
            n = len(sizes) // 2
            out[at : at + n] = w.likenesses(digits, sizes, np.arange(n), np.arange(n, 2 * n)) >= least.iloc[at : at + n].to_numpy()
        yield pd.Series(out)


def _like(unit: pd.DataFrame, least: float) -> pd.DataFrame:
    """Spanning forest of each bucket's members that are alike: (a, b). Members that are known to be joined are not compared."""
    unit = unit.drop_duplicates(["band", "node"]).sort_values(["band", "node"])
    band, node, side, part = (unit[c].to_numpy(np.int64) for c in ("band", "node", "side", "part"))
    digits, sizes = digits_of(unit["f"].tolist())
    some = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for p, q in buckets.pairs(band, side, unit["i"].iat[0] != unit["j"].iat[0], PAIRS):
        apart = part[p] != part[q]
        p, q = p[apart], q[apart]
        if len(p):
            near = walk().likenesses(digits, sizes, p, q) >= least
            some.append((p[near], q[near]))
    p, q = (np.concatenate(x) for x in zip(*some, strict=True))
    root = buckets.forest(len(unit), p, q)
    joined = root != np.arange(len(unit))
    return pd.DataFrame({"a": node[joined], "b": node[root[joined]]})


def _once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first row of every node of a partition, so that many copies of a text leave a task once."""
    seen: set[int] = set()
    for batch in batches:
        batch = batch.drop_duplicates("node")
        new = ~batch["node"].isin(seen)
        seen.update(batch["node"][new].tolist())
        yield batch[new]


def _banded(bands: int, places: int, least: float):
    """Function for mapInPandas: (node, band) of every node of a partition, once; fingerprints without digits have none."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = walk()
        for batch in _once(batches):
            for at in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[at : at + BLOCK_ROWS]
                keys = [sorted({xxhash.xxh64_intdigest(x) - 2**63 for x in w.bands(unpacked(f), bands, places, least)}) if len(f) > 1 else [] for f in part["f"]]
                yield pd.DataFrame({"node": np.repeat(part["node"].to_numpy(np.int64), [len(k) for k in keys]), "band": np.array([x for k in keys for x in k], np.int64)})

    return rows


def near_duplicates(docs: DataFrame, *, least: float = LIKENESS) -> DataFrame:
    """Groups of texts with like fingerprints: doc_id, group_id (smallest doc_id of the group), for groups of two or more.

    Equal fingerprints are one class, named by 64 hash bits. Bands of sampled digits gather candidate classes, and pairs
    of a bucket are verified. A row with a null doc_id is in no group; a null text counts as empty; a doc_id with several
    texts takes the smallest of their groups."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/prints-{uuid.uuid4().hex}"
    found = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), packed_fingerprint(F.coalesce("text", F.lit(""))).alias("f"))
    found.withColumn("node", F.xxhash64("f")).write.parquet(path)
    found = spark.read.schema("doc_id long, f binary, node long").parquet(path)
    alike = _alike(found, least)
    release_shuffles(spark)
    near = connected_components(alike, rows_a_part=EDGES_A_TASK).withColumnRenamed("component", "root")
    rows = join_few(found.select("doc_id", "node"), near, "node", F.col("doc_id")).select("doc_id", F.coalesce("root", "node").alias("root"))
    heads = rows.groupBy("root").agg(F.min("doc_id").alias("group_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = join_few(rows, checkpointed(heads), "root", F.col("doc_id")).where("group_id is not null")
    groups = checkpointed(groups.groupBy("doc_id").agg(F.min("group_id").alias("group_id")))
    remove_folder(spark, path)
    return groups


def _alike(found: DataFrame, least: float) -> DataFrame:
    """(a, b) that connect classes which are alike; found holds doc_id, node and f.

    1. Rows (class, band) meet by bands in bundles, where bands of a single class are dropped; bands that a sample of one
       class in 64 shows to be very full are counted beforehand instead.
    2. In buckets of over CROWD classes all are verified against the smallest one. A bucket that these links connect is done.
    3. In all others every pair of classes that are not connected yet is verified, a large bucket in blocks of BLOCK_ROWS
       that are spread over tasks: quadratic work, and only spanning forests leave a task."""
    n_classes = found.select(F.approx_count_distinct("node")).first()[0]
    bands, places = banding(n_classes, least)
    once = found.select("node", "f").mapInPandas(_once, "node long, f binary")
    banded = found.select("node", "f").mapInPandas(_banded(bands, places, least), "node long, band long")
    sample = banded.where(F.pmod("node", F.lit(64)) == 0).distinct().groupBy("band").count().where(F.col("count") >= BLOCK_ROWS // 128)
    full = checkpointed(sample.select("band", F.lit(True).alias("full")))
    bundles = max(1, math.ceil(n_classes / 1024))

    def shared(unit: pd.DataFrame) -> pd.DataFrame:
        unit = unit[["node", "band"]].drop_duplicates()
        by = unit.groupby("band")["node"]
        unit = unit.assign(n=by.transform("size"), head=by.transform("min"))
        return unit[unit["n"] > 1]

    marked = banded.join(full, "band", "left")
    few = marked.where("full is null").groupBy(F.pmod("band", F.lit(bundles))).applyInPandas(shared, "node long, band long, n long, head long")
    many = checkpointed(marked.where("full").select("node", "band").distinct())
    counted = many.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("head"))
    rows = checkpointed(few.unionByName(join_few(many, counted, "band", F.col("node"))))
    prints = once.join(rows.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("f").alias("f"))  # equal nodes have equal f
    stars = rows.where((F.col("n") > CROWD) & (F.col("node") != F.col("head"))).select("node", "head").distinct().join(prints, "node")
    heads = prints.join(stars.select(F.col("head").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("head"), F.col("f").alias("g"))
    stars = join_few(stars, heads, "head", F.col("node")).where(_alike_pair("f", "g", F.lit(float(least))))
    links = checkpointed(stars.select(F.col("node").alias("a"), F.col("head").alias("b")))
    joined = connected_components(links, rows_a_part=EDGES_A_TASK).withColumnRenamed("component", "part")
    rows = rows.join(joined, "node", "left").withColumn("part", F.coalesce("part", "node"))
    open_ = rows.where(F.col("n") > CROWD).groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("band", F.lit(True).alias("open"))
    rows = rows.where(F.col("n") <= CROWD).unionByName(join_few(rows.where(F.col("n") > CROWD), open_, "band", F.col("node")).where("open").drop("open"))
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.when(F.col("blocks") == 1, F.pmod("band", F.lit(bundles))).otherwise(F.col("band"))
    rows = rows.select("node", "band", "part", "side", (F.col("blocks") > 1).alias("crowded"), unit.alias("unit"), F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    rest = rows.join(prints, "node").groupBy("crowded", "unit", "i", "j").applyInPandas(lambda unit: _like(unit, least), "a long, b long")
    return checkpointed(links.unionByName(rest))
