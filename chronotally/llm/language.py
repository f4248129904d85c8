"""Language identification by cross-parsing entropy (operator 2).

Per language a suffix automaton of labelled text is built. A text is parsed against each automaton: take
the longest match of what is left, count a phrase, go on behind it. phrases * log2(training letters) /
letters estimates the cross entropy; the language with the smallest estimate (normalised phrase count)
wins. All texts of a slice advance together, one letter a step: moves by frequent letters lie in a dense table,
those by all others (scripts of thousands of letters) in sorted keys.

The training text is a bounded sample of whole rows: of each language the rows with the smallest hashes of doc_id, one
in each of SAMPLE_ROWS hash buckets, taken in hash order as long as they fit into TRAIN_LETTERS letters together.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.llm.common import by_length



SAMPLE_ROWS = 96
TRAIN_LETTERS = 40_000
#: Letters whose moves lie in the dense table; it only decides where a move is looked up.
DENSE = 96
UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that is never learned from (a null id too)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def normalise(text: str) -> str:
    """Lower-case letters with one space between runs of them and one at either end; '' if there is no letter."""
    runs = "".join([c if c.isalpha() else " " for c in text.lower()]).split()
    return f" {' '.join(runs)} " if runs else ""


def suffix_automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """Moves of every state of the suffix automaton: letter code -> next state. State 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[state] = clone
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
        last = state
    return moves


class CrossParser:
    """Parses batches of texts against one automaton per language.

    Letters of the training texts have codes by falling frequency; any other letter has the code ``n_codes``, which
    matches nothing. A table entry is (next state * width) * 2 + (1 if a new phrase starts there). Where a match cannot be
    extended, the entry leads where the root leads by this letter; a letter that the root lacks is a phrase of its own."""

    def __init__(self, texts: dict[str, str], dense: int = DENSE) -> None:
        self.languages = sorted(texts)
        counts: dict[str, int] = {}
        for text in texts.values():
            for c in text:
                counts[c] = counts.get(c, 0) + 1
        letters = sorted(counts, key=lambda c: (-counts[c], c))
        self.n_codes, self.dense = len(letters), min(dense, len(letters))
        self.width = self.dense + 1
        self.code = np.full(0x110000, self.n_codes, np.int32)
        for i, c in enumerate(letters):
            for form in {c, c.upper(), c.title()}:
                if len(form) == 1 and form.lower() == c:
                    self.code[ord(form)] = i
        self.space = letters.index(" ") if letters else 0
        for o in range(0x110000):
            if self.code[o] == self.n_codes and not chr(o).isalpha():
                self.code[o] = self.space
        tables, keys, targets, self.bits, base = [], [], [], [], 0
        self.starts = np.zeros((len(self.languages), 1), np.int64)
        self.roots = np.zeros((len(self.languages), max(1, self.n_codes)), np.int64)
        for row, lang in enumerate(self.languages):
            codes = self.code[np.frombuffer(texts[lang].encode("utf-32-le"), np.uint32)]
            moves = suffix_automaton(codes)
            between = len(moves)  # the state before the text and behind a letter that the root lacks
            sizes = np.array([len(m) for m in moves])
            state = np.repeat(np.arange(len(moves)), sizes)
            code = np.fromiter((c for m in moves for c in m), np.int64, int(sizes.sum()))
            target = np.fromiter((s for m in moves for s in m.values()), np.int64, int(sizes.sum()))
            root = np.full(self.n_codes, between)
            root[list(moves[0])] = list(moves[0].values())
            table = np.full((between + 1, self.width), -1)
            near = code < self.dense
            table[state[near], code[near]] = target[near]
            starts = table < 0
            led = np.where(starts, np.r_[root[: self.dense], between], table)
            tables.append(((led + base) * self.width * 2 + starts).ravel())
            keys.append((state[~near] + base) * self.n_codes + code[~near])
            targets.append((target[~near] + base) * self.width * 2)
            self.roots[row, : self.n_codes] = (root + base) * self.width * 2 + 1
            self.starts[row] = (base + between) * self.width
            base += between + 1
            self.bits.append(math.log2(max(2, len(codes))))
        self.table = np.concatenate(tables) if tables else np.empty(0, np.int64)
        self.keys, self.targets = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, targets))
        order = np.argsort(self.keys)
        self.keys, self.targets = self.keys[order], self.targets[order]
        if base * self.width * 2 < 2**31:
            self.table, self.starts = self.table.astype(np.int32), self.starts.astype(np.int32)

    def encode(self, text: str) -> np.ndarray:
        """Codes of the normalised text; empty if it has no letter."""
        codes = self.code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        gap = codes == self.space
        if gap.all():
            return codes[:0]
        keep = np.ones(len(codes), bool)
        keep[1:] = ~(gap[1:] & gap[:-1])
        codes = codes[keep]
        edge = np.array([self.space], np.int32)
        return np.concatenate([edge[: int(codes[0] != self.space)], codes, edge[: int(codes[-1] != self.space)]])

    def _rare_moves(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Entries of states (rows by language) for codes behind the dense ones."""
        key = (state // self.width).astype(np.int64) * self.n_codes + codes
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], self.roots[:, codes])

    def phrases(self, encoded: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) by language (columns). The longest texts come first, so that at
        every step the texts not yet at their end are a prefix of the batch."""
        n = len(encoded)
        lengths = np.array([len(x) for x in encoded], np.int64)
        order = np.argsort(-lengths, kind="stable")
        joined = np.concatenate([encoded[i] for i in order]) if n else np.empty(0, np.int32)
        some_rare = bool(((joined >= self.dense) & (joined < self.n_codes)).any())
        sizes = lengths[order]
        at = np.cumsum(sizes) - sizes
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if n else 0), "left")
        position = at.copy()
        state = np.repeat(self.starts, n, axis=1)
        count = np.zeros((len(self.languages), n), np.int64)
        for k in active.tolist():
            here = position[:k]
            codes = joined.take(here)
            entry = self.table.take(state[:, :k] + np.minimum(codes, self.dense))
            if some_rare:
                rare = np.flatnonzero((codes >= self.dense) & (codes < self.n_codes))
                if len(rare):
                    entry[:, rare] = self._rare_moves(state[:, rare], codes[rare])
            count[:, :k] += entry & 1
            np.right_shift(entry, 1, out=state[:, :k])
            here += 1
        found = np.empty((n, len(self.languages)), np.int64)
        found[order] = count.T
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        for some in by_length(np.array([len(t) if isinstance(t, str) else 0 for t in texts], np.int64)):
            encoded = [self.encode(texts[i]) if isinstance(texts[i], str) and texts[i] else self.code[:0] for i in some.tolist()]
            known = [k for k, x in enumerate(encoded) if len(x)]
            if not known:
                continue
            entropy = self.phrases([encoded[k] for k in known]) * np.array(self.bits)
            best = entropy.argmin(axis=1)  # the first in alphabetical order among equals
            ordered = np.sort(entropy, axis=1)
            second = ordered[:, 1] if ordered.shape[1] > 1 else np.full(len(known), np.inf)
            margin = 1 - ordered[:, 0] / second
            for row, k in enumerate(known):
                names[some[k]], scores[some[k]] = self.languages[best[row]], margin[row]
        return names, scores


@functools.cache
def _parser(texts: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(dict(texts))


def training_texts(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS, letters: int = TRAIN_LETTERS) -> dict[str, str]:
    """Normalised training text per language, from rows that are not held out. The sample is bounded: of a language and
    hash bucket the row with the smallest hash among those of at most ``letters`` characters, or else the shortest one;
    of several texts of a doc_id the smallest. Whole rows are taken in hash order while they fit, at least one."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    usable = usable.select("lang", "text", F.xxhash64(F.col("doc_id")).alias("h"), F.length("text").alias("n"))
    first = F.min(F.struct(F.greatest(F.col("n"), F.lit(letters)).alias("over"), "h", "n"))
    picked = usable.groupBy("lang", F.pmod("h", F.lit(sample_rows)).alias("bucket")).agg(first.alias("f")).select("lang", "f.h", "f.n").collect()
    if not picked:
        return {}
    wanted = F.broadcast(docs.sparkSession.createDataFrame([tuple(r) for r in picked], "lang string, h long, n int"))  # sample_rows a language
    sample = usable.join(wanted, ["lang", "h", "n"]).groupBy("lang", "h").agg(F.min("text").alias("text")).collect()
    texts: dict[str, str] = {}
    for row in sorted(sample, key=lambda r: (r["lang"], len(r["text"]) > letters, r["h"])):
        have, more = texts.get(row["lang"], ""), normalise(row["text"])
        if not have or len(have) + len(more) <= letters:
            texts[row["lang"]] = have + more
    return {lang: text for lang, text in texts.items() if text}


def identify(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS, letters: int = TRAIN_LETTERS) -> DataFrame:
    """Predict the language of every whole text: doc_id, held_out, lang_pred, score.

    score is 1 - best / second-best normalised phrase count (0: a tie). A null text, or one without a
    letter, is 'und' with score 0; so is every text if no row can be learned from. Repeated rows are
    predicted each; further columns are ignored; an empty table gives an empty result."""
    texts = tuple(sorted(training_texts(docs, sample_rows=sample_rows, letters=letters).items()))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(texts) if texts else None
        for batch in batches:
            names, scores = parser.predict(list(batch)) if parser else ([UNDETERMINED] * len(batch), np.zeros(len(batch)))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")
