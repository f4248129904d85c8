"""What the pipeline's stages ask of a Python worker: each text once, and memory that a batch's rows do not set."""

import tracemalloc

import numpy as np

from chronotally.llm import ngram_join, toxicity


def test_texts_are_signed_once_and_those_without_words_stay_out(spark, tmp_path):
    rows = [(1, "a b c"), (2, "a b c"), (3, None), (4, ""), (5, " ?! "), (None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path := f"{tmp_path}/docs")
    classes = ngram_join._classes(spark.read.parquet(path), 4, 2, 5)
    assert classes._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert {(r["rep"], r["copies"], r["size"]) for r in classes.collect()} == {(1, 2, 1), (None, 1, 1)}


def peak(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def texts(n):
    rng = np.random.default_rng(7)
    y = (np.arange(n) % 2).astype(float)
    return [np.unique(np.r_[rng.integers(0, toxicity.WIDTH, 500), rng.integers(0, 200, 20) + 200 * int(c)]).astype(np.int32) for c in y], y


def test_scoring_takes_a_bounded_number_of_features_at_a_time():
    x, _ = texts(4000)
    x[1], x[2] = np.empty(0, np.int32), np.arange(toxicity.WIDTH, dtype=np.int32)  # one text alone may be longer
    known = np.arange(0, toxicity.WIDTH, 400)
    models = [toxicity.Linear(known, np.sin(known) / 9, np.zeros(0), 0.1), toxicity.Linear(known, np.cos(known) / 9, np.array([0.7]), -0.2)]
    for m in models:
        assert len(m.dense) == toxicity.WIDTH
    whole, _ = peak(lambda: np.concatenate([toxicity.Chain(["a", "b"], models).probabilities([b]) for b in x]))
    got, bytes_held = peak(lambda: toxicity.Chain(["a", "b"], models).probabilities(x))
    assert (got == whole).all()
    assert bytes_held < 32e6


def test_a_fit_holds_few_bytes_a_feature():
    x, y = texts(4000)
    model, bytes_held = peak(lambda: toxicity.fit_linear(x, np.zeros((len(x), 0)), y, np.ones(len(x))))
    assert len(model.known) and bytes_held < 32 * sum(map(len, x))
