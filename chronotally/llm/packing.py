"""Best-fit packing of token sequences, with dominance reduction (operator 8).

1. Every text is tokenised once, inside Spark tasks; a document longer than the capacity is cut into
   capacity-long pieces of which the first may be shorter. Full pieces are sequences of their own.
2. The instance is the histogram of piece lengths: at most ``capacity`` counters whatever the corpus
   size, so planning on the driver is bounded. ``plan`` applies the Martello-Toth dominance criterion to
   whole classes of equal lengths, fixes the dominating sets, and packs what is left by best fit
   decreasing. A plan line says "ranks lo..hi-1 of length L go to sequences s, s+1, ... at offset o".
3. Pieces get a rank within their length by a two-level count (length, chunk) -> offset, so that a hot
   length (a group of copies) is spread over chunks, and look their line up by binary search.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronotally.llm.common import checkpointed

CAPACITY = 2048
END_ID = 0
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Words between spaces whose ids a worker keeps.
WORD_CACHE = 120_000


class _WordIds(dict):
    """Word behind a space -> the ids of both as little-endian bytes. The first WORD_CACHE words stay."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        found = array("I", self.encode(" " + word)).tobytes()
        if len(self) < WORD_CACHE:
            self[word] = found
        return found


@functools.cache
def _tokenizer(path: str, ranks: str):
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    words = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, special, _WordIds(words.encode_ordinary)


def token_bytes(text: str | None, path: str, ranks: str) -> bytes:
    """The ids of the whole text as little-endian unsigned 32-bit numbers.

    This byte-level tokenizer never merges across a space that a non-space follows, so that words are looked
    up one by one; the same vocabulary as ranks gives the ids of new words. Texts with a special string or
    a run of spaces go through the tokenizer as a whole."""
    if not text:
        return b""
    encode, special, words = _tokenizer(path, ranks)
    if "  " in text or text[0] == " " or text[-1] == " " or any(s in text for s in special):
        return array("I", encode(text)).tobytes()
    first, *others = text.split(" ")
    return array("I", encode(first)).tobytes() + b"".join(map(words.__getitem__, others))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


PIECE_SCHEMA = "doc_key long, doc_id long, piece int, start long, length int, ids_crc32 long"


def pieces(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_key tells repeated doc_ids with different texts apart."""
    path, ranks = vocabulary(TOKENIZER), vocabulary(RANKS)
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, doc_id, text in zip(batch["doc_key"].array, batch["doc_id"].array, batch["text"].array, strict=True):
                ids = token_bytes(text if isinstance(text, str) else None, path, ranks) + end
                n, start = len(ids) // 4, 0
                length = n % capacity or capacity
                for piece in range(-(-n // capacity)):
                    rows.append((key, None if pd.isna(doc_id) else int(doc_id), piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    start, length = start + length, capacity
            out = pd.DataFrame(rows, columns=["doc_key", "doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    source = docs.select(F.xxhash64("doc_id", "text").alias("doc_key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInPandas(cut, PIECE_SCHEMA)


Packed = list[tuple[tuple[int, ...], int]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Packed:
    """Contents of sequences and how many of each: [((len, len, ...), count), ...].

    ``reduced`` fixes the sets that provably dominate, ``best_fit`` packs what is left."""
    fixed, rest = reduced(histogram, capacity)
    return fixed + best_fit(rest, capacity)


def reduced(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[Packed, Counter[int]]:
    """The Martello-Toth dominance criterion for sets of up to three pieces.

    A set dominates another one if the other's pieces can be placed, each whole, in the places of its own
    pieces. For each length, from the largest down, with ``room`` beside it, these sets are fixed:
      - the piece alone, if nothing fits beside it;
      - the pair with the largest fitting piece, if it fills the sequence or no two pieces fit in the room;
      - the triple (a, b) of the largest fitting piece a and the largest b beside it, if no three pieces
        fit in the room and no two pieces longer than b do.
    Each step serves as many equal pieces as there are; fewer pieces only mean fewer alternatives."""
    pool = Counter({n: c for n, c in histogram.items() if c > 0})
    fixed: Packed = []
    open_lengths = set(pool)

    def take(contents: tuple[int, ...]) -> None:
        count = min(pool[n] // k for n, k in Counter(contents).items())
        fixed.append((contents, count))
        for n in contents:
            pool[n] -= count
        for n in set(contents):
            if not pool[n]:
                del pool[n]
                open_lengths.discard(n)

    def smallest(k: int, above: int, but: int) -> int:
        """Sum of the k shortest pieces longer than ``above``, without one piece of length ``but``; too much if there are fewer."""
        total = 0
        for n in lengths[np.searchsorted(lengths, above, "right") :]:
            here = min(k, pool[int(n)] - (n == but))
            total, k = total + here * int(n), k - here
            if not k:
                return total
        return capacity + 1

    while open_lengths:
        big = max(open_lengths)
        lengths = np.array(sorted(pool))
        room = capacity - big
        fits = (int(n) for n in lengths[: np.searchsorted(lengths, room, "right")][::-1])
        a = next((n for n in fits if pool[n] > (n == big)), None)
        if a is None:
            take((big,))
        elif a == room or smallest(2, 0, big) > room:
            take((big, a))
        else:
            spare = pool - Counter([big, a])
            b = next((int(n) for n in lengths[: np.searchsorted(lengths, room - a, "right")][::-1] if spare[int(n)]), None)
            if b is not None and smallest(3, 0, big) > room and smallest(2, b, big) > room:
                take((big, a, b))
            else:
                open_lengths.discard(big)
    return fixed, pool


def best_fit(rest: Counter[int], capacity: int) -> Packed:
    """Best fit decreasing over classes of equal lengths: a piece goes to the fullest open sequence with room."""
    opened: dict[int, Packed] = defaultdict(list)  # free room -> contents and how many sequences hold them
    for n in sorted(rest, reverse=True):
        count = rest[n]
        while count:
            free = min((f for f, groups in opened.items() if f >= n and groups), default=None)
            if free is None:
                each = capacity // n
                full, over = divmod(count, each)
                if full:
                    opened[capacity - each * n].append(((n,) * each, full))
                if over:
                    opened[capacity - over * n].append(((n,) * over, 1))
                break
            contents, there = opened[free].pop()
            each = min(free // n, count)
            used = min(there, count // each)
            opened[free - each * n].append((contents + (n,) * each, used))
            if there > used:
                opened[free].append((contents, there - used))
            count -= used * each
    return [group for groups in opened.values() for group in groups]


def plan_lines(packed: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Lines (length, rank, sequence_id, offset), sorted; the line of rank r of a length is the last with rank <= r."""
    lines, used, sequence = [], Counter(), 0
    for contents, count in packed:
        offset = 0
        for n in contents:
            lines.append((n, used[n], sequence, offset))
            used[n] += count
            offset += n
        sequence += count
    return pd.DataFrame(lines, columns=["length", "rank", "sequence_id", "offset"]).sort_values(["length", "rank"]).reset_index(drop=True)


def ranked(parts: DataFrame, rows_in_chunk: int = 50_000) -> DataFrame:
    """Rank (from 0) of every piece within its length, by (length, chunk) counts and ranks within the chunk."""
    n = parts.count()
    chunks = max(8, -(-n // rows_in_chunk))
    parts = parts.withColumn("chunk", F.pmod(F.xxhash64("doc_key", "piece"), F.lit(chunks)))
    sizes = parts.groupBy("length", "chunk").count()
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "chunk").orderBy("doc_key", "piece", "doc_id")
    parts = parts.withColumn("_within", F.row_number().over(within) - 1)
    return parts.join(sizes, ["length", "chunk"]).withColumn("rank", F.col("base") + F.col("_within")).drop("chunk", "base", "_within")


def pack(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack whole documents (doc_id, text) into sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row per piece. A null or
    empty text is the end id alone. Repeated rows are packed as often as they stand; a null doc_id stays
    null. An empty table gives an empty result; other columns are ignored."""
    parts = checkpointed(pieces(docs, capacity=capacity, end_id=end_id))
    histogram = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}  # at most `capacity` rows
    lines = plan_lines(plan(histogram, capacity))
    keys = lines["length"].to_numpy(np.int64) << 44 | lines["rank"].to_numpy(np.int64)
    at_rank, at_seq, at_off = (lines[c].to_numpy(np.int64) for c in ("rank", "sequence_id", "offset"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rank = rank.to_numpy(np.int64)
        i = np.searchsorted(keys, length.to_numpy(np.int64) << 44 | rank, "right") - 1
        return pd.DataFrame({"sequence_id": at_seq[i] + rank - at_rank[i], "offset": at_off[i]})

    placed = ranked(parts).withColumn("_at", place("length", "rank"))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "_at.sequence_id", "_at.offset")
