"""Toxicity by a classifier chain (operator 5).

Categories are predicted one after the other by linear (logistic) models; each later model also gets the earlier
categories' probabilities as features. In training these come from out-of-fold predictions: the sample is cut into
FOLDS by hash, and the probability of a row comes from a model that was fitted without its fold, so that a later model
sees probabilities as uncertain as those it will be given. Every model chooses its features by the labels of its own
training rows alone, so that nothing of a fold's labels reaches the model that predicts it.

A text's features are the distinct runs of letters and of marks in it, in lower case, and the first three, four
and five letters of longer words; Spark's own functions make them. Models are fitted in tasks, those of the folds side by side, on
a bounded sample of labelled documents (SAMPLE_ROWS a class of the last category, by hash of doc_id), and applied to
every whole text. The driver holds weights, and neither texts nor features.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.llm.common import as_row, by_length, checkpointed, with_columns

SAMPLE_ROWS = 3000
#: Hash buckets of features.
WIDTH = 1 << 20
FOLDS = 4
#: Ridge penalty of a model, and the most steps of its fit.
RIDGE, STEPS = 1e-3, 200
#: Times that a row of the last category counts in fitting: a toxic document that stays is twice as bad as a clean one that goes.
EMPHASIS = 2.0
THRESHOLD = 0.5
#: A model keeps at most so many features: those whose count among the label's rows is over so many standard deviations
#: from what their count in all rows lets expect, the strongest first.
FEATURES, DEVIATIONS = 3000, 3.0
#: Features of texts that are scored at a time, so that a worker's memory does not follow a batch's rows.
FEATURES_AT_ONCE = 500_000
#: Partitions of the bounded sample.
SAMPLE_PARTS = 6
#: Runs of letters, and runs of what is neither letter, digit nor space.
TOKEN = r"\p{L}+|[^\p{L}\p{Nd}\s]+"


def categories() -> list[tuple[str, Column]]:
    """The chain: low quality first, then toxic."""
    return [("low_quality", F.col("quality") == 0), ("toxic", F.col("toxic") == 1)]


def featured(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, and x: the hash buckets of the text's features, each once (none of a null text)."""
    start = lambda n: F.transform(F.filter("found", lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))
    rows = rows.select(*keep, F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))).alias("found"))
    buckets = F.transform(F.concat("found", start(3), start(4), start(5)), lambda w: F.pmod(F.xxhash64(w), F.lit(WIDTH)).cast("int"))
    return rows.select(*keep, F.array_distinct(buckets).alias("x"))


@dataclass
class Linear:
    """A logistic model: weights of the known buckets, one per earlier category, and the intercept."""

    known: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    @functools.cached_property
    def dense(self) -> np.ndarray:
        """A weight per bucket; workers fill it in, it does not travel."""
        out = np.zeros(WIDTH)
        out[self.known] = self.weights
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "dense"}

    def probability(self, x: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
        rows = np.repeat(np.arange(len(x)), [len(b) for b in x])
        flat = np.concatenate([*x, np.empty(0, np.int32)]).astype(np.int32)
        z = np.bincount(rows, self.dense.take(flat), len(x)) + earlier @ self.earlier + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def telling(rows: np.ndarray, buckets: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The features a model keeps, from (row, bucket) pairs, each once, and the rows' labels."""
    rate = y.mean()
    if not 0 < rate < 1:
        return np.empty(0, np.int64)
    df = np.bincount(buckets, minlength=WIDTH)
    some = np.flatnonzero(df >= 2)
    df, hits = df[some], np.bincount(buckets[(y > 0)[rows]], minlength=WIDTH)[some]
    z = np.abs(hits - df * rate) / np.sqrt(df * rate * (1 - rate))
    some, z = some[z >= DEVIATIONS], z[z >= DEVIATIONS]
    return np.sort(some[np.argsort(-z, kind="stable")[:FEATURES]])


def fit_linear(x: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Linear:
    """Smallest mean weighted logistic loss plus RIDGE / 2 times the squared weights (not of the intercept), by L-BFGS."""
    n, k = len(y), earlier.shape[1]
    flat = np.concatenate([*x, np.empty(0, np.int32)]).astype(np.int32, copy=False)  # buckets and rows fit 32 bits
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(b) for b in x])
    known = telling(rows, flat, y)
    place = np.full(WIDTH, -1, np.int32)
    place[known] = np.arange(len(known))
    there = place[flat] >= 0
    rows, cols = rows[there].astype(np.int64), place[flat[there]].astype(np.int64)
    del flat, there, place  # most features are none of the model's: only the others' places stay for its steps
    d, share = len(known), weight / weight.sum()
    ridge = np.r_[np.full(d + k, RIDGE), 0.0]

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(rows, w[cols], n) + earlier @ w[d : d + k] + w[-1]
        error = share * (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y)
        loss = float(share @ (np.logaddexp(0, z) - y * z) + 0.5 * ridge @ (w * w))
        return loss, np.r_[np.bincount(cols, error[rows], d), error @ earlier, error.sum()] + ridge * w

    w, past = np.zeros(d + k + 1), []
    f, g = value(w)
    for _ in range(STEPS):
        if np.abs(g).max() < 1e-7:
            break
        step, alphas = -g, []
        for s, t in reversed(past):
            alphas.append(s @ step / (s @ t))
            step = step - alphas[-1] * t
        if past:
            step = step * (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (s, t), alpha in zip(past, reversed(alphas), strict=True):
            step = step + (alpha - t @ step / (s @ t)) * s
        size, slope = 1.0, g @ step
        while True:
            after, gradient = value(w + size * step)
            if after <= f + 1e-4 * size * slope or size < 1e-6:
                break
            size /= 2
        if after >= f:  # as good as a double can tell
            break
        s, t = size * step, gradient - g
        w, f, g = w + s, after, gradient
        if s @ t > 1e-16:
            past = [*past[-9:], (s, t)]
    return Linear(known, w[:d], w[d : d + k], float(w[-1]))


def _fitted(rows: DataFrame, k: int, label: str, folds: list[int]) -> dict[int, Linear]:
    """A model of the label for each number in ``folds``, on the rows that are not of that fold, each in a task of its own.
    rows: fold, weight, x, earlier (k probabilities) and the label; the sample is bounded, so a task holds it."""

    def fit_one(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        earlier = np.array(part["earlier"].tolist(), float).reshape(len(part), k)
        m = fit_linear(part["x"].tolist(), earlier, part[label].to_numpy(float), part["weight"].to_numpy(float))
        return pd.DataFrame({"model": [key[0]], "known": [m.known.astype(np.int64).tobytes()], "w": [np.r_[m.weights, m.earlier, m.intercept].tobytes()]})

    for_each = rows.withColumn("model", F.explode(F.array(*[F.lit(f) for f in folds]))).where("fold <> model")
    found = for_each.repartition(len(folds), "model").groupBy("model").applyInPandas(fit_one, "model int, known binary, w binary").collect()
    out = {f: Linear(np.empty(0, np.int64), np.empty(0), np.zeros(k), -700.0) for f in folds}  # a fold that holds all rows leaves nothing to learn
    for r in found:
        known, w = np.frombuffer(r["known"], np.int64), np.frombuffer(r["w"])
        out[r["model"]] = Linear(known, w[: len(known)], w[len(known) : -1], float(w[-1]))
    return out


@dataclass
class Chain:
    """The models in order, each of a category of ``names``."""

    names: list[str]
    models: list[Linear]

    def probabilities(self, x: list[np.ndarray]) -> np.ndarray:
        """A row per text and a column per category."""
        out = np.empty((len(x), len(self.names)))
        for some in by_length(np.array([len(b) for b in x], np.int64), FEATURES_AT_ONCE):
            here = [x[i] for i in some.tolist()]
            for k, model in enumerate(self.models):
                out[some, k] = model.probability(here, out[some, :k])
        return out


def _extended(models: dict[int, Linear], k: int) -> Column:
    """The earlier probabilities (k of them) with that of the model of the row's own fold behind them."""

    @F.pandas_udf("array<double>")
    def extended(fold: pd.Series, x: pd.Series, earlier: pd.Series) -> pd.Series:
        before = np.array(earlier.tolist(), float).reshape(len(x), k)
        p = np.zeros(len(x))
        for f in fold.unique().tolist():
            here = (fold == f).to_numpy()
            p[here] = models[f].probability([b for b, h in zip(x, here, strict=True) if h], before[here])
        return pd.Series(list(np.column_stack([before, p])), dtype=object)

    return extended("fold", "x", "earlier")


def fit_chain(rows: DataFrame, names: list[str], *, folds: int = FOLDS) -> Chain:
    """rows: x, weight, fold (from 0) and a 0/1 column per category. Each category's out-of-fold probabilities are
    written before the next model reads them."""
    models: list[Linear] = []
    rows = rows.withColumn("earlier", F.array().cast("array<double>"))
    for k, name in enumerate(names):
        last = k + 1 == len(names)
        found = _fitted(rows, k, name, [-1] if last else [-1, *range(folds)])
        models.append(found[-1])
        if not last:
            rows = checkpointed(rows.withColumn("earlier", _extended(found, k)))
    return Chain(names, models)


def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Chain | None:
    """Fit the chain on labelled documents; None if there is no usable row. Labels of one doc_id are merged by
    their maximum; rows with a null label, doc_id or text are not learned from; of several texts of one doc_id the
    smallest is. Every row weighs what its class holds in all labelled rows against the sample, times EMPHASIS if of the
    last category."""
    names = [n for n, _ in categories()]
    rows = labels.select("doc_id", *[c.cast("int").alias(n) for n, c in categories()]).dropna()
    rows = rows.groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names]).withColumn("h", F.xxhash64("doc_id"))
    totals = {r[0]: r[1] for r in rows.groupBy(names[-1]).count().collect()}  # two rows
    by_hash = lambda y: rows.where(F.col(names[-1]) == y).orderBy("h", "doc_id").limit(sample_rows)
    picked = by_hash(0).unionByName(by_hash(1))  # 2 * sample_rows short rows at most
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    texts = texts.groupBy("doc_id", "h", *names).agg(F.min("text").alias("text"))
    sample = featured(texts.withColumn("fold", F.pmod(F.xxhash64("h"), F.lit(FOLDS)).cast("int")), "text", ["fold", *names])
    sample = checkpointed(sample.coalesce(SAMPLE_PARTS))
    there = {r[0]: r[1] for r in sample.groupBy(names[-1]).count().collect()}
    if not there:
        return None
    scale = sum(totals[c] for c in there) / sum(there.values())
    weight = F.lit(0.0)
    for c, n in there.items():
        weight = F.when(F.col(names[-1]) == c, F.lit(totals[c] / n / scale * (EMPHASIS if c else 1))).otherwise(weight)
    return fit_chain(sample.withColumn("weight", weight), names)


def _scored(docs: DataFrame, chain: Chain | None, threshold: float) -> DataFrame:
    """row (all columns of a document), p_<category> of each category, is_toxic."""
    names = chain.names if chain else [n for n, _ in categories()]
    rows = docs.select(as_row(docs), "text")
    if chain:

        @F.pandas_udf(", ".join(f"p_{n} double" for n in names))
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame(chain.probabilities(batch.tolist()), columns=[f"p_{n}" for n in names])

        rows = featured(rows, "text", ["row"]).select("row", predict("x").alias("p")).select("row", "p.*")
    else:
        rows = rows.select("row", *[F.lit(0.0).alias(f"p_{n}") for n in names])
    toxic = (F.coalesce(F.length("row.text"), F.lit(0)) > 0) & (F.col(f"p_{names[-1]}") >= threshold)
    return rows.withColumn("is_toxic", toxic)


def score(docs: DataFrame, chain: Chain | None, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with p_<category> of each category and is_toxic (the last category's reaches the threshold).

    A null or empty text is never toxic; without a chain nothing is. Repeated rows are scored each, and an empty table
    gives an empty result. Other columns pass through, whatever their names; an input column with the name of an output
    is replaced."""
    rows = _scored(docs, chain, threshold)
    added = {c: F.col(c) for c in rows.columns if c.startswith("p_") or c == "is_toxic"}
    return rows.select(*with_columns(docs.columns, added, "row"))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score(docs, fit(docs, labels, **options))


def accepted(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that the chain does not reject, with their columns as they were."""
    return _scored(docs, fit(docs, labels, **options), threshold).where("not is_toxic").select("row.*")
