"""Periodic run detection by online dyadic square catching (operator 11).

Words arrive in order. For every power of two L, each completed block of L words (they lie end to end) is held by a
catcher for the periods q that L stands for. When a word is appended, the suffix of L words that it completes is
compared with the blocks that lie such a q before it; two equal ones are a caught match, which is extended to the left at
once and to the right for as long as appended words keep period q. A match that is long enough is a square, and squares
of one start and period merge into a run. Of the 2L - 1 words that any square's repeated part has at least, L are one of
the blocks, so no square is missed; an appended word meets at most three blocks of each L, so a text of n words takes
O(n log n) comparisons, done for many appended words at a time in NumPy. The texts of a slice are appended to one stream,
parted by numbers that no word has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotally.llm.common import by_length

#: A run has this many words at least, and two periods.
MIN_LENGTH = 12
#: Words appended at a time; more only need more memory.
SLAB = 1 << 17
WORD = r"[^\x20\x09-\x0D]+"

_PRIMES = (np.uint64(2**31 - 1), np.uint64(2**31 - 19))
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-spread bits of each number."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_length(period: int, min_length: int) -> int:
    """The largest power of two of which some aligned block lies in every stretch of a run that its period repeats."""
    return 1 << ((max(min_length - period, period) + 1) // 2).bit_length() - 1


class Suffixes:
    """The stream so far, with prefix hashes by which stretches of any length compare in constant time."""

    def __init__(self, longest: int, seed: int) -> None:
        self.n, self.longest = 0, longest
        self.words = np.empty(0, np.int64)
        rng = np.random.Generator(np.random.PCG64(seed))
        self.bases = [int(b) for b in rng.integers(1 << 20, 1 << 30, 2)]
        self.sums = [np.zeros(1, np.uint64) for _ in _PRIMES]
        self.powers = [np.ones(1, np.uint64) for _ in _PRIMES]

    def append(self, words: np.ndarray) -> None:
        spread, total = mixed(words), self.n + len(words)
        for k, prime in enumerate(_PRIMES):
            power = self.powers[k]
            while len(power) <= total:
                power = np.concatenate([power, power * np.uint64(pow(self.bases[k], len(power), int(prime))) % prime])
            self.powers[k] = power
            terms = (spread >> np.uint64(33 * k)) % prime * power[self.n : total] % prime
            self.sums[k] = np.concatenate([self.sums[k], (self.sums[k][-1] + np.cumsum(terms)) % prime])
        self.words, self.n = np.concatenate([self.words, words]), total

    def same(self, a: np.ndarray, q: np.ndarray, size: int) -> np.ndarray:
        """Whether the ``size`` words from a on equal those from a + q on."""
        found = np.ones(len(a), bool)
        for sums, powers, prime in zip(self.sums, self.powers, _PRIMES, strict=True):
            first, second = sums[a + size] + prime - sums[a], sums[a + q + size] + prime - sums[a + q]
            found &= first % prime * powers[q] % prime == second % prime
        return found

    def common(self, a: np.ndarray, q: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from a on (or up to a, which it excludes) equal those q words later."""
        most = np.minimum(self.n - a - q if forward else a, self.longest)
        size = np.zeros(len(a), np.int64)
        for step in (1 << k for k in reversed(range(int(most.max(initial=0)).bit_length()))):
            here = np.flatnonzero(size + step <= most)
            start = a[here] + size[here] if forward else a[here] - size[here] - step
            size[here[self.same(start, q[here], step)]] += step
        return size


class Catchers:
    """Runs of a stream of numbers, found while it is appended to; how it is cut into appends makes no difference.

    Periods over ``longest`` // 2 are not looked for: pass the length of the longest text of the stream."""

    def __init__(self, longest: int, min_length: int = MIN_LENGTH, seed: int = 1) -> None:
        self.min_length, self.text = min_length, Suffixes(longest, seed)
        periods: dict[int, list[list[int]]] = {}
        q, most = 1, longest // 2
        while q <= most:  # ranges of periods of the same block length; past min_length these are 2L - 1 to 4L - 2
            size = block_length(q, min_length)
            end = q if 2 * q <= min_length else min(most, 4 * size - 2)
            ranges = periods.setdefault(size, [])
            if ranges and ranges[-1][1] == q - 1:
                ranges[-1][1] = end
            else:
                ranges.append([q, end])
            q = end + 1
        self.periods = periods
        self.levels: dict[int, tuple[int, np.ndarray]] = {}  # L: first position that is kept, hash of the L words from each
        self.open = np.empty((3, 0), np.int64)  # start, end, period of matches that reach the last word
        self.runs: list[np.ndarray] = []

    def append(self, words: np.ndarray) -> None:
        old = self.text.n
        self.text.append(words)
        start, end, q = self.open
        found = [np.stack([start, end + self.text.common(end - q, q, True), q])]
        size, hashes, first = 1, mixed(words), old
        while True:  # the level of L: hashes of the L words from positions `first` on, each completed by an appended word
            base, kept = self.levels.get(size, (first, hashes[:0]))
            kept = np.concatenate([kept, hashes])
            for low, high in self.periods.get(size, ()):
                found += self._caught(size, base, kept, first, low, high)
            cut = max(0, len(kept) - 5 * size - self.min_length)
            self.levels[size] = base + cut, kept[cut:]
            size *= 2
            if size > max(self.periods, default=0) or self.text.n < size:
                break
            first = max(0, old - size + 1)
            half = kept[first - base :]
            left, right = half[: self.text.n - size - first + 1], half[size // 2 :]
            hashes = mixed(left * np.uint64(0xD6E8FEB86659FD93) + right)
        everything = np.unique(np.concatenate(found, axis=1), axis=1)
        ended = everything[1] < self.text.n
        self.open = everything[:, ~ended]
        self._keep(everything[:, ended])

    def _caught(self, size: int, base: int, hashes: np.ndarray, first: int, low: int, high: int) -> list[np.ndarray]:
        """start, end, period of matches of the windows from position ``first`` on with blocks low to high words before."""
        at = np.arange(max(first, low), base + len(hashes))
        if not len(at):
            return []
        here, nearest, shift = hashes[at - base], at - low, size.bit_length() - 1
        begin = -(-base >> shift) if base else 0  # the first block that is kept
        blocks = hashes[(begin << shift) - base :: size]
        nearest >>= shift
        hits = []
        for back in range((high - low) // size + 2):
            block = nearest - back
            some = np.flatnonzero(here == blocks[np.maximum(block - begin, 0)])
            some = some[block[some] >= begin]
            some = some[at[some] - (block[some] << shift) <= high]
            hits.append(np.stack([at[some] - (block[some] << shift), block[some]]))
        q, block = np.concatenate(hits, axis=1)
        order = np.lexsort([block, q])
        q, block = q[order], block[order]
        again = np.r_[False, (q[1:] == q[:-1]) & (block[1:] == block[:-1] + 1)][: len(q)]  # continues the match of the block before
        q, left = q[~again], block[~again] << shift
        return [np.stack([left - self.text.common(left, q, False), left + q + self.text.common(left, q, True), q])] if len(q) else []

    def _keep(self, matches: np.ndarray) -> None:
        start, end, q = matches
        self.runs.append(matches[:, end - start >= np.maximum(2 * q, self.min_length)])

    def finish(self) -> np.ndarray:
        """start, end and smallest period of every run, by start and period. Stretches with several periods are multiples
        of the smallest one's run, with the same ends."""
        self._keep(self.open)
        self.open = self.open[:, :0]
        start, end, q = np.unique(np.concatenate(self.runs, axis=1), axis=1)
        smallest = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][: len(start)]
        start, end, q = start[smallest], end[smallest], q[smallest]
        order = np.lexsort([q, start])
        return np.stack([start, end, q])[:, order]

    def exact(self, runs: np.ndarray) -> bool:
        """Whether all words of the runs repeat, and stop to repeat at their ends, by the words themselves."""
        words = self.text.words
        for s, e, q in runs.T.tolist():
            wider = s > 0 and words[s - 1] == words[s - 1 + q] or e < len(words) and words[e] == words[e - q]
            if wider or not np.array_equal(words[s : e - q], words[s + q : e]):
                return False
        return True


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH, slab: int = SLAB) -> np.ndarray:
    """start, end, period, text of all runs; each text is an array of numbers from 0 up. Hashes propose, words decide: in
    the unheard-of case that two stretches only share their hash, other hashes are taken."""
    sizes = np.array([len(t) for t in texts], np.int64) + 1
    stream = np.concatenate([x for i, t in enumerate(texts) for x in (t, np.array([-1 - i]))]).astype(np.int64) if texts else np.empty(0, np.int64)
    offsets, seed = np.cumsum(sizes) - sizes, 1
    while True:
        catchers = Catchers(int(sizes.max(initial=1)) - 1, min_length, seed)
        for at in range(0, max(1, len(stream)), slab):
            catchers.append(stream[at : at + slab])
        runs = catchers.finish()
        if catchers.exact(runs):
            break
        seed += 1
    text = np.searchsorted(offsets, runs[0], "right") - 1
    return np.stack([runs[0] - offsets[text], runs[1] - offsets[text], runs[2], text]) if len(text) else np.empty((4, 0), np.int64)


def _analysed(texts: pa.Array, min_length: int) -> tuple[pa.Array, pa.Array]:
    """runs and collapsed of a slice of texts."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    filled = pc.greater(pc.binary_length(words), 0)
    ends = np.r_[0, np.cumsum(filled.to_numpy(zero_copy_only=False))][lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    words = words.filter(filled)
    numbers = words.dictionary_encode().indices.to_numpy()
    found = runs_of([numbers[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], min_length)
    start, end, q, text = found
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, ends[text] + start + q, 1)
    np.add.at(marks, ends[text] + end, -1)
    kept = np.cumsum(marks)[:-1] == 0
    offsets = np.r_[0, np.cumsum(kept)][ends].astype(np.int32)
    collapsed = pc.binary_join(pa.ListArray.from_arrays(offsets, words.filter(pa.array(kept))), " ")
    counts = np.bincount(text, minlength=len(texts))
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, end - start, q)], ["start", "length", "period"])
    order = pa.array(np.argsort(text, kind="stable"))
    return pa.ListArray.from_arrays(np.r_[0, np.cumsum(counts)].astype(np.int32), runs.take(order)), collapsed


def find_runs(docs: DataFrame, *, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """The documents with ``runs`` (array of start, length and period in words, by start and period) and ``collapsed``
    (the words that stay if every run keeps its first period only, joined by one space).

    A run is a maximal stretch of at least min_length words that repeats its smallest period, twice at least. A null
    text counts as empty: no runs, collapsed ''. Texts are whole, however long: a task holds one slice of texts (2 million
    characters, or one text) and its memory is linear in that. Repeated rows are analysed each, ties cannot occur.
    Other columns pass through, whatever their names; input columns runs and collapsed are replaced; an empty table gives an
    empty result. Nothing is shuffled."""
    columns = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    place = [c.lower() for c in columns].index(text.lower())
    schema = T.StructType([docs.schema[c] for c in columns]).add("runs", RUNS).add("collapsed", T.StringType())

    def analyse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place).cast(pa.string())
            for some in by_length(pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)):
                rows = batch.take(pa.array(some))
                found = _analysed(column.take(pa.array(some)), min_length)
                yield pa.RecordBatch.from_arrays([*rows.columns, *found], names=[*columns, "runs", "collapsed"])

    return docs.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(analyse, schema)


# the query's fixed rules


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: of every tenth document (by crc32 of its id) the words from a = g % n on repeat with period p. A null
    doc_id is never planted."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    g, n = F.floor(h / 10), F.size("_w")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_w"), g.alias("_g"))
    rows = rows.withColumns({"_a": F.when(n > 0, F.col("_g") % n).cast("int"), "_n": n})
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    source = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    edited = F.array_join(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.get("_w", source(i))), " ")
    return rows.select("doc_id", F.when(F.col("_n") > 0, edited).otherwise(F.col("text")).alias("text"))


def digest(rows: DataFrame) -> DataFrame:
    """doc_id with the count, the longest run and hashes of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"), F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
    length, period = F.col("r.length"), -F.col("r.period")
    exponent: Column = F.floor(1000 * length / period).cast("long")
    return rows.select("doc_id", "n_runs", (-F.col("r.start")).alias("start"), length.alias("length"), period.alias("period"), exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
