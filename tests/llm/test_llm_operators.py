"""The training-data operators against brute force, exact round trips and held-out accuracy, and their edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronotally.llm import chat, e8, edit_fingerprint, language, lattice, licenses, lines, mixing, ngram_join, packing, toxicity
from chronotally.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, short and long texts, repeated rows, ties, an extra column with a clashing name."""
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    rows = [(1, "a b c d e f g\nshared line", "en", "s", 27, 1), (1, "a b c d e f g\nshared line", "en", "s", 27, 1), (2, None, "en", "s", None, 2), (3, "", None, None, 0, 3), (None, "x", "de", "s", 1, 4), (4, long, "fr", None, len(long), 5), (4, "y  z ", "fr", "t", 5, 6), (5, "%%% 123 \U0001f600", None, "t", 9, 7)]
    return spark.createDataFrame(rows, DOCS + ", `rank` int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def duck_rows(name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = con.execute(Q.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(str([float(f"{r[i]:.9g}") if isinstance(r[i], float) else r[i] for i in order]) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_queries_match_sql(spark, name):
    df = Q.queries()[name](spark, SF)
    columns, want = duck_rows(name)
    got = sorted(str([float(f"{r[c]:.9g}") if isinstance(r[c], float) else r[c] for c in columns]) for r in df.collect())
    assert sorted(df.columns) == columns and got == want


# 1 chat


def test_chat_collapse_keeps_maximal_and_smallest(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (5, 1, "user", "hi"), (2, 1, "assistant", "yo"), (6, 0, None, None), (None, 0, "user", "z"), (7, None, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit(1))
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"]) for r in chat.format_chats(df).collect()}
    assert got == {2: (2, 2), 4: (2, 1), 5: (1, 1), 6: (1, 1), None: (1, 1), 7: (1, 1)}
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_with_long_texts_shared_numbers_and_clashing_columns(spark):
    long = "x y " * 100_000
    rows = [(1, 0, "user", long), (2, 0, "user", long), (2, 1, "assistant", "yo"), (3, 0, "user", "a"), (4, 0, "user", "a"), (4, 0, "tool", "b"), (4, 1, "assistant", "c"), (5, 0, "user", "a"), (5, 0, "tool", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n_turns", F.lit("z")).withColumn("rendered", F.lit(1)).withColumn("s1", F.lit(2))
    got = {r["conv_id"]: (r["n_turns"], r["rendered"]) for r in chat.format_chats(df).collect()}
    assert {i: n for i, (n, _) in got.items()} == {2: 2, 3: 1, 4: 3} and got[2][1].count("x y ") == 100_000 and got[4][1].startswith("<|im_start|>tool\nb")


def test_chat_prefixes_run_over_blocks(spark):
    turns = [(c, t, "user", str(t)) for c, n in ((1, 2500), (2, 1500), (3, 2500)) for t in range(n)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert [(r["conv_id"], r["n_turns"], r["n_copies"]) for r in chat.format_chats(df).collect()] == [(1, 2500, 2)]


# 2 language


def brute_phrases(text, train):
    n, i = 0, 0
    while i < len(text):
        k = i + 1
        while k <= len(text) and text[i:k] in train:
            k += 1
        i = max(k - 1, i + 1)
        n += 1
    return n


def test_phrases_match_brute_force():
    rng = random.Random(3)
    train = {lang: language.normalise("".join(rng.choice(letters + "  ") for _ in range(300))) for lang, letters in (("a", "abc"), ("b", "bcd"))}
    parser = language.CrossParser(train)
    texts = ["".join(rng.choice("abcdz ") for _ in range(rng.randrange(1, 60))) + "a" for _ in range(50)]
    got = parser.phrases([parser.encode(t) for t in texts])
    assert got.tolist() == [[brute_phrases(language.normalise(t), train[lang]) for lang in ("a", "b")] for t in texts]


def test_language_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.95
    for r in language.identify(docs).limit(50).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1


def test_predictions_match_brute_force():
    rng = random.Random(13)
    train = {lang: language.normalise("".join(rng.choice(letters + "  ") for _ in range(400))) for lang, letters in (("a", "abcd"), ("b", "bcde"), ("c", "xyzé"))}
    texts = ["".join(rng.choice("abcdexyzÉ- ") for _ in range(rng.randrange(0, 80))) for _ in range(80)] + [None, "", "12 - 3", "日本"]
    names, scores = language.CrossParser(train, dense=3).predict(texts)
    assert (names, scores.tolist()) == (lambda n, s: (n, s.tolist()))(*language.CrossParser(train).predict(texts))
    for text, name, score in zip(texts, names, scores, strict=True):
        plain = language.normalise(text or "")
        if not plain:
            assert (name, score) == ("und", 0)
            continue
        entropy = {lang: brute_phrases(plain, t) * math.log2(len(t)) for lang, t in train.items()}
        best, second = sorted(entropy.values())[:2]
        assert name == min(entropy, key=lambda lang: (entropy[lang], lang)) and math.isclose(score, 1 - best / second, abs_tol=1e-12)


def test_scripts_of_three_thousand_letters_are_told_apart(spark):
    """Two languages over the same 3,000 letters, each with word pairs of its own."""
    rng = random.Random(31)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    words = {lang: ["".join(rng.choice(letters) for _ in range(2)) for _ in range(1500)] for lang in ("p", "q")}
    rows = [(i, "".join(rng.choice(words["pq"[i % 2]]) for _ in range(120)), "pq"[i % 2]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(df).where("held_out").collect()
    assert len(got) > 50 and sum(r["lang_pred"] == "pq"[r["doc_id"] % 2] for r in got) >= 0.97 * len(got)


def test_training_text_is_whole_rows(spark):
    rows = [(i, f"{'abcdefgh'[i % 8] * 30} {i}", "x") for i in range(60)] + [(900 + i, "long " * 500, "y") for i in range(9)] + [(i % 60, "zz", "x") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.training_texts(df, sample_rows=8, letters=200)
    assert set(found) == {"x", "y"} and set(found["y"].split()) == {"long"} and len(found["y"].split()) == 500
    assert len(found["x"]) <= 200 and all(len(w) == 30 or w == "zz" for w in found["x"].split())


def test_language_edges(odd, empty):
    got = {(r["doc_id"], r["lang_pred"]) for r in language.identify(odd.withColumnRenamed("rank", "lang_pred")).collect()}
    assert (2, "und") in got and (3, "und") in got and (5, "und") in got
    assert language.identify(empty).count() == 0


# 3 lines


def test_boilerplate_counts_copies_of_a_page_once(spark):
    rows = [(i, f"menu\nbody {i}", "h") for i in range(8)] + [(20 + i, "copied page\nsecond", "h") for i in range(30)] + [(90, "menu\nlone", "other"), (91, None, "h"), (92, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("host", F.lit("x"))
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in lines.drop_boilerplate(df, max_ratio=0.5).collect()}
    assert got[0] == ("body 0", 1) and got[20] == ("copied page\nsecond", 0) and got[90] == ("menu\nlone", 0) and got[91] == (None, 0) and got[92] == ("", 0)
    assert lines.drop_boilerplate(df.limit(0)).count() == 0


def test_boilerplate_on_a_few_per_cent_of_a_site_goes(spark):
    """Of 400 pages: a menu on all, section lines on 5, 4 and 2.5 %, and lines on 1.5 % (6 pages) and 1 page, which stay."""
    planted = {"menu": 400, "section a": 20, "section b": 16, "section c": 10, "said by a few": 6}
    rows = [(i, "\n".join([*(x for x, n in planted.items() if i < n), f"body {i}"]), "site") for i in range(400)]
    rows += [(1000 + i, f"section a\nother {i}" if i < 1 else f"other {i}", "small") for i in range(40)] + [(2000 + i, f"both\nown {i}", "tiny") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in lines.drop_boilerplate(df).collect()}
    want = {i: (f"said by a few\nbody {i}" if i < 6 else f"body {i}", sum(i < n for x, n in planted.items() if x != "said by a few")) for i in range(400)}
    assert got == want | {i: (text, 0) for i, text, _ in rows[400:440]} | {2000: ("own 0", 1), 2001: ("own 1", 1)}


def test_boilerplate_with_clashing_columns(spark):
    rows = [(i, f"menu\nbody {i}", "h", 100 + i, "a", "b", 7, i) for i in range(8)]
    names = "doc_id long, text string, source string, n_chars int, _host string, _bad string, n_lines int, here int"
    df = spark.createDataFrame(rows, names)
    got = lines.drop_boilerplate(df)
    assert got.columns == ["doc_id", "text", "source", "n_chars", "_host", "_bad", "here", "n_lines", "n_dropped"]
    assert {tuple(r) for r in got.collect()} == {(i, f"body {i}", "h", 100 + i, "a", "b", i, 2, 1) for i in range(8)}
    kept = lines.cleaned(df)
    assert kept.columns == df.columns and {tuple(r) for r in kept.collect()} == {(i, f"body {i}", "h", len(f"body {i}"), "a", "b", 7, i) for i in range(8)}
    assert lines.cleaned(df.limit(0)).count() == 0


def test_salted_lookup_gives_the_same(spark, docs, monkeypatch):
    from chronotally.llm import common

    want = sorted(map(str, lines.drop_boilerplate(docs).collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert sorted(map(str, lines.drop_boilerplate(docs).collect())) == want


# 4 licences


def brute_scan(text):
    lower = {c: c + 32 for c in range(65, 91)}
    words = re.findall(licenses.WORD, (text or "").translate(lower))
    base, every = [], []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        base += [(label, i, 1.0) for i in range(len(words)) if words[i : i + len(p)] == p]
    for label, notice, key in licenses.NOTICES:
        w, k = notice.split(), key.split()
        at = next(i for i in range(len(w)) if w[i : i + len(k)] == k)
        for s in range(-at, len(words)):
            if s + at >= 0 and words[s + at : s + at + len(k)] == k:
                share = sum(0 <= s + j < len(words) and words[s + j] == x for j, x in enumerate(w)) / len(w)
                every += [(label, s, share)] if share >= licenses.COVERAGE else []
    starts, names = [i for _, i, _ in base], lambda some: ",".join(sorted({x for x, _, _ in some}))
    every += base
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), names(base), names(every), max((x for _, _, x in every), default=0.0), len(every))


@pytest.fixture(scope="module")
def licensed():
    rng = random.Random(5)
    pool = "cc by nc 4 0 general public license version 3 all rights reserved licensed under the apache 2 gnu work is this mit released é".split()
    texts = [rng.choice([" ", ", ", "\n"]).join(rng.choice(pool).upper() if rng.random() < 0.2 else rng.choice(pool) for _ in range(rng.randrange(0, 80))) for _ in range(150)]
    for _, notice, _ in licenses.NOTICES * 6:  # notices with some words changed, left out at an end, or whole
        words = [rng.choice(pool) if rng.random() < rng.choice([0, 0.1, 0.25]) else w for w in notice.split()]
        texts.append(" ".join([rng.choice(pool) for _ in range(rng.randrange(4))] + words[rng.randrange(3) :] + ["end"] * rng.randrange(2)))
    return [*texts, None, "", "CC-BY cc by", " ".join(["the license all rights reserved"] * 4000)]


def test_license_places_match_brute_force(spark, licensed):
    df = spark.createDataFrame(list(enumerate(licensed)), "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("found", F.lit(2))
    for r in licenses.scan(df).collect():
        assert tuple(r)[1:] == pytest.approx(brute_scan(licensed[r["doc_id"]])), licensed[r["doc_id"]]


def test_idf_decides_the_lookups_and_no_result(spark, licensed):
    df = spark.createDataFrame(list(enumerate(licensed)), "doc_id long, text string")
    one = licenses.document_frequencies(df)
    assert one["license"] == sum("license" in re.findall(licenses.WORD, (t or "").lower()) for t in licensed)
    other = {w: 10_000 - n for w, n in one.items()}
    looked = lambda f: df.select("doc_id", F.array_intersect(licenses.words_of(F.col("text")), F.array(*[F.lit(w) for w in one])).alias("has")).select(F.transform(licenses.candidates(F.col("has"), f), lambda t: F.struct(t["label"], F.transform(t["looked"], lambda j: F.get(t["words"], j)))).alias("x"))
    sought = [[(t[0], tuple(t[1])) for r in looked(f).collect() for t in (r["x"] or [])] for f in (one, other)]
    assert sought[0] != sought[1] and sum(one[w] for _, ws in sought[0] for w in ws) < sum(one[w] for _, ws in sought[1] for w in ws)
    assert sorted(map(str, licenses.scan(df, one).collect())) == sorted(map(str, licenses.scan(df, other).collect()))


def test_license_edges(odd, empty):
    got = licenses.scan(odd.withColumnRenamed("rank", "has")).collect()
    assert len(got) == odd.count() and all(r["labels"] == "" and r["n_base"] == 0 and r["first_word"] is None for r in got)
    assert [r["n_words"] for r in got if r["doc_id"] == 1] == [9, 9] and {r["n_words"] for r in got if r["doc_id"] in (2, 3)} == {0}
    assert licenses.scan(empty).count() == 0


# 5 toxicity


def test_toxicity_on_rows_held_out_of_the_fit(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chain = toxicity.fit(docs, labels.where("doc_id % 3 <> 0"))
    got = toxicity.score(docs, chain).join(labels.where("doc_id % 3 = 0"), "doc_id").groupBy("toxic", "is_toxic").count().collect()
    n = {(r["toxic"], r["is_toxic"]): r["count"] for r in got}
    assert n.get((0, True), 0) <= 1 and n[1, True] >= 3 * n.get((1, False), 0)


def brute_features(text):
    words = set(re.findall(r"[^\W\d_]+|[^\w\s]+|_", (text or "").lower()))
    return words | {w[:n] + "*" for n in (3, 4, 5) for w in words if len(w) > n}


def brute_logistic(x, earlier, y, weight=None):
    """A function from (x, earlier) to probabilities: features by their deviation, then Newton's method on the mean logistic
    loss plus RIDGE / 2 times the squared weights; the intercept comes last."""
    rate, df, hits = y.mean(), x.sum(axis=0), y @ x
    kept = (df >= 2) & (np.abs(hits - df * rate) >= toxicity.DEVIATIONS * np.sqrt(np.maximum(df, 1) * rate * (1 - rate)))
    design = lambda x, earlier: np.column_stack([x[:, kept], earlier, np.ones(len(x))])
    z, sigmoid = design(x, earlier), lambda v: 1 / (1 + np.exp(-v))
    share = (weight if weight is not None else np.ones(len(y))) / (weight.sum() if weight is not None else len(y))
    w, ridge = np.zeros(z.shape[1]), np.r_[np.full(z.shape[1] - 1, toxicity.RIDGE), 0.0]
    for _ in range(100):
        p = sigmoid(z @ w)
        hessian = (z * (share * p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        w -= np.linalg.lstsq(hessian, z.T @ (share * (p - y)) + ridge * w, rcond=None)[0]
    return lambda x, earlier: sigmoid(design(x, earlier) @ w), w


def test_chain_matches_brute_force(spark):
    """Every probability of the chain, from features as sets of strings, folds, Newton fits and out-of-fold columns."""
    rng = random.Random(17)
    words = "red green blue stone paper water nasty awful garbage kind gentle morning evening".split()
    rows, labels = [], []
    for i in range(160):
        low, bad = rng.random() < 0.4, rng.random() < 0.4
        some = [rng.choice(words) for _ in range(8)] + (["###"] if low and rng.random() < 0.8 else []) + (["vile"] if bad and rng.random() < 0.7 else []) + (["junk"] if bad and low else [])
        rows.append((i, " ".join(some)))
        labels.append((i, int(not low), int(bad)))
    docs, truth = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: (r["p_low_quality"], r["p_toxic"]) for r in toxicity.classify(docs, truth).collect()}
    fold = {r[0]: r[1] for r in truth.select("doc_id", F.pmod(F.xxhash64(F.xxhash64("doc_id")), F.lit(toxicity.FOLDS))).collect()}
    names = sorted(set().union(*[brute_features(t) for _, t in rows]))
    x = np.array([[f in brute_features(t) for f in names] for _, t in rows], float)
    low, bad = (np.array(v, float) for v in ([1 - q for _, q, _ in labels], [t for _, _, t in labels]))
    folds, none = np.array([fold[i] for i, _ in rows]), np.zeros((len(rows), 0))
    weight = np.where(bad > 0, toxicity.EMPHASIS, 1.0)
    first, apart = brute_logistic(x, none, low, weight)[0](x, none), np.zeros(len(rows))
    for f in range(toxicity.FOLDS):
        out = folds == f
        apart[out] = brute_logistic(x[~out], none[~out], low[~out], weight[~out])[0](x[out], none[out])
    model, w = brute_logistic(x, apart[:, None], bad, weight)
    second = model(x, first[:, None])
    assert np.allclose([got[i] for i, _ in rows], np.stack([first, second], axis=1), atol=0.005)
    assert np.abs(apart - first).max() > 0.02 and abs(w[-2]) > 0.1  # the folds and the chain make a difference


def test_toxicity_edges(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 0, 1), (1, 1, 1), (4, 1, 0), (5, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.classify(odd, none).where("is_toxic").count() == 0
    assert toxicity.classify(odd, some).count() == odd.count()
    assert toxicity.classify(odd, some).where("doc_id in (2, 3) and is_toxic").count() == 0
    assert toxicity.classify(empty, some).count() == 0


def test_toxicity_with_clashing_columns(spark):
    rows = [(i, "vile text" if i % 2 else "kind text", "a", i, 9, 1) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, is_toxic string, p_toxic int, x int, fold int")
    labels = df.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    got = toxicity.classify(df, labels)
    assert got.columns == ["doc_id", "text", "x", "fold", "p_low_quality", "p_toxic", "is_toxic"] and all(r["is_toxic"] == bool(r["doc_id"] % 2) and r["x"] == 9 for r in got.collect())
    kept = toxicity.accepted(df, labels)
    assert kept.columns == df.columns and {tuple(r) for r in kept.collect()} == {r for r in rows if not r[0] % 2}


# 6 fingerprints


def scalar_walk(text):
    """The walk of one text, a character and a step at a time."""
    w = edit_fingerprint.walk()
    classes = [((ord(c) * 2654435761 % 2**32) >> 12) % (edit_fingerprint.CLASSES - 1) + 1 for c in text]
    wanted, at, step, out = set(w.sampled[: 64 * 20].tolist()), 0, 0, []
    while at < len(classes):
        period, within = divmod(step, edit_fingerprint.PERIOD)
        row = within ^ int(w.orders[period % len(w.orders)])
        if step in wanted:
            out.append(f"{w.digits[row, classes[at]] - 1:x}")
        at += int(w.bits[row, classes[at]])
        step += 1
    return "".join(out)


def test_walks_match_a_scalar_walk():
    rng = random.Random(12)
    texts = ["", "-", "a", "aa", "\U0001f600é", "x" * 30_000] + ["".join(rng.choice("abc \né") for _ in range(rng.randrange(1, 3000))) for _ in range(60)]
    assert edit_fingerprint.walk().fingerprints(texts) == [scalar_walk(t) for t in texts]


def test_a_text_has_one_fingerprint_wherever_it_stands(spark):
    """Alone, beside a long text, and over several partitions."""
    walk, short = edit_fingerprint.walk(), ["-", "ab", "tiny text", "q" * 9]
    alone = [walk.fingerprints([t])[0] for t in short]
    assert walk.fingerprints([*short, "long " * 20_000])[: len(short)] == alone
    rows = [(i, short[i % 4] if i % 7 else "long " * 3000) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = edit_fingerprint.fingerprints(df).collect()
    for r in got:
        text = rows[r["doc_id"]][1]
        assert r["fingerprint"] == (alone[short.index(text)] if text in short else walk.fingerprints([text])[0])
        assert r["near_edited"] == 1 or r["edited_sha256"] != hashlib.sha256(text.encode()).hexdigest()
    assert len({(r["fingerprint"], r["group_id"]) for r in got}) == 5


def test_edited_texts_follow_the_contract(spark, docs):
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in Q.op6_edit_fingerprints(spark, SF).collect()}
    for k, (i, text) in enumerate(rows):
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[(k + 1) % len(rows)][1][:half]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(text)
        assert got[i]["fingerprint"] == scalar_walk(text) and got[i]["edited_fingerprint"] == scalar_walk(edited)
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.97


def test_likeness_falls_with_edits():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    walk = edit_fingerprint.walk()
    near = []
    for k in (0, 5, 40, 400):
        other = list(text)
        for _ in range(k):
            other[rng.randrange(len(other))] = "z"
        near.append(walk.likeness(*walk.fingerprints([text, "".join(other)])))
    assert near[0] == 1 and near == sorted(near, reverse=True) and near[1] > 0.9 > near[3]
    assert walk.likeness("", "") == 1 and walk.likeness("", walk.fingerprints(["a"])[0]) == 0


def test_next_row_over_many_ranges(spark):
    ids = [i * 3 % 1009 for i in range(1, 500)]
    df = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i // 2) for i in ids if i % 5 == 0], "doc_id long, mark long")
    got = {r["doc_id"]: (r["next_text"], r["mark"]) for r in edit_fingerprint.with_next(df, ["text"], marks=marks, rows_in_part=40).collect()}
    order = sorted(ids, reverse=True)
    assert got == {i: (str(order[(k + 1) % len(order)]), i // 2 if i % 5 == 0 else None) for k, i in enumerate(order)}


def test_fingerprint_edges(odd, empty):
    got = edit_fingerprint.fingerprints(odd.withColumnRenamed("rank", "mark")).collect()
    assert len(got) == odd.count() and all(0 <= r["near_next"] <= 1 for r in got)
    assert {r["group_id"] for r in got if r["doc_id"] == 1} == {1} and {r["group_id"] for r in got if r["doc_id"] is None} == {None}
    assert edit_fingerprint.fingerprints(empty).count() == 0
    assert edit_fingerprint.fingerprints(odd.where("doc_id = 5")).first()["near_next"] == 1


def test_fingerprint_groups(spark):
    text = " ".join(f"word{i * 7 % 101}" for i in range(300))
    rows = [(1, text), (2, text), (3, text.replace("word14 ", "other ", 1)), (4, "something else " * 90), (5, None), (6, "")]
    groups = {r["doc_id"]: r["group_id"] for r in edit_fingerprint.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5}


def like_pairs(texts):
    walk = edit_fingerprint.walk()
    prints = walk.fingerprints(texts)
    digits, sizes = edit_fingerprint.digits_of([edit_fingerprint.packed(f) for f in prints])
    p, q = np.triu_indices(len(texts), 1)
    some = walk.likenesses(digits, np.maximum(sizes, 1), p, q) >= edit_fingerprint.LIKENESS
    return [(int(i), int(j)) for i, j in zip(p[some], q[some], strict=True)]


def test_fingerprint_groups_match_brute_force(spark, monkeypatch):
    """Texts of one template at a likeness of about 0.7 with near copies of some, and copies cut to 0.83 to 0.87 of the length."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    template, texts = [word() for _ in range(80)], []
    for _ in range(120):
        words = [word() if rng.random() < 0.12 else w for w in template]
        texts += [" ".join(words), " ".join([*words[:-3], word(), *words[-2:]])]
    for n in range(30, 2400, 37):
        text = "".join(rng.choice("abcdefgh ") for _ in range(n))
        texts += [text, text[: int(n * rng.uniform(0.83, 0.87))]]
    rng.shuffle(texts)
    near = like_pairs(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = list(range(len(texts)))
    for _ in range(20):
        for i, j in near:
            root[i] = root[j] = min(root[i], root[j])
    for block in (edit_fingerprint.BLOCK_ROWS, 20):  # the second one also makes bands crowded
        monkeypatch.setattr(edit_fingerprint, "BLOCK_ROWS", block)
        group = {r["doc_id"]: r["group_id"] for r in edit_fingerprint.near_duplicates(df).collect()}
        assert sum(group.get(i, -1) == group.get(j, -2) for i, j in near) >= 0.95 * len(near) > 150
        assert all(root[i] == root[g] for i, g in group.items())


def test_recall_of_the_bands_at_the_threshold():
    """Pairs whose likeness is 0.8 to 0.85: at least nine of ten share a band."""
    rng, walk = random.Random(21), edit_fingerprint.walk()
    bands, places = edit_fingerprint.banding(250_000)
    hit = n = 0
    while n < 300:
        text = list("".join(rng.choice("etaoinshrdlu ") for _ in range(rng.randrange(200, 3000))))
        other = list(text)
        for _ in range(max(1, int(len(text) * rng.uniform(0.002, 0.03)))):
            other[rng.randrange(len(other))] = "z"
        f, g = walk.fingerprints(["".join(text), "".join(other)])
        if 0.8 <= walk.likeness(f, g) < 0.85:
            n += 1
            hit += bool(set(walk.bands(f, bands, places)) & set(walk.bands(g, bands, places)))
    assert hit >= 0.9 * n


def test_likenesses_of_many_pairs():
    rng, walk = random.Random(6), edit_fingerprint.walk()
    base = "".join(rng.choice("abcdef ") for _ in range(900))
    prints = walk.fingerprints([base[: rng.randrange(1, 900)] + "x" * rng.randrange(40) for _ in range(40)])
    digits, sizes = edit_fingerprint.digits_of([edit_fingerprint.packed(f) for f in prints])
    assert sizes.tolist() == [len(f) for f in prints] and all("".join(f"{d:x}" for d in row[:n]) == f for row, n, f in zip(digits, sizes, prints, strict=True))
    p, q = np.triu_indices(40, 1)
    assert np.allclose(walk.likenesses(digits, sizes, p, q), [walk.likeness(prints[i], prints[j]) for i, j in zip(p, q, strict=True)])


# 7 embeddings


def brute_links(rows):
    by = collections.defaultdict(list)
    for i, v, label in rows:
        ok = label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if ok:
            by[label, len(v)].append((i, np.array(v, float)))
    links, parent = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for some in by.values():
        for a in range(len(some)):
            for b in range(a):
                (i, x), (j, y) = some[a], some[b]
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    p, q = find(i), find(j)
                    parent[max(p, q)] = min(p, q)
    return {i: (links[i], find(i)) for i in links}


def test_lattice_links_match_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(30):
        centre = rng.standard_normal(64)
        for _ in range(12):
            rows.append((len(rows), (centre + rng.standard_normal(64) * rng.choice([0.0, 0.05, 0.15, 0.2])).tolist(), int(c % 3)))
    rows += [(1000, None, 1), (1001, [0.0] * 64, 1), (1002, [1.0, None], 1), (1003, [float("nan")] * 64, 1), (1004, [1.0] * 64, None), (1005, [1.0] * 8, 1), (1006, [1.0] * 16, 1), (1007, [2.0] * 8, 1), (1008, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit(1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.link(df).collect()}
    want = brute_links(rows)
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want) and all(got[i] == (0, i) for i in (1000, 1001, 1002, 1003, 1004, 1006, 1008)) and got[1005] == got[1007] == (1, 1005)
    assert lattice.link(df.limit(0)).count() == 0


def test_crowded_cells_are_cut_into_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(64)
    rows = [(i, (centre + rng.standard_normal(64) * 0.05).tolist(), 1) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(lattice, "BLOCK", 7)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.link(df).collect()} == brute_links(rows)


def test_lattice_recall_at_the_threshold(spark):
    """Pairs at a cosine of 0.93 to 0.935, which must be found in at least nine of ten cases, and of 0.925 to 0.93, which never link."""
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for k in range(600):
        x, y = rng.standard_normal(64), rng.standard_normal(64)
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = 0.93 + (0.001 + 0.004 * rng.random()) * (1 if k % 2 else -1)
        rows += [(2 * k, x.tolist(), k % 3), (2 * k + 1, (c * x + math.sqrt(1 - c * c) * y).tolist(), k % 3)]
        want[2 * k] = k % 2
    got = {r["vec_id"]: r["n_links"] for r in lattice.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert all(got[i] == 0 for i, near in want.items() if not near)
    assert sum(got[i] for i, near in want.items() if near) >= 0.9 * sum(want.values())


def test_lattice_compares_labels_themselves():
    """Should two labels share a cell's id, their vectors still do not link."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1, 16)).repeat(4, axis=0)
    homes, visits = lattice.cells(x / np.linalg.norm(x, axis=1)[:, None], np.zeros(4, np.int64))
    unit = pd.DataFrame({"cell": homes[:, 0], "node": list("abcd"), "kind": ["x", "y", "x", "y"], "side": 0, "i": 0, "j": 0, "copies": 1, "homes": list(homes), "visits": list(visits), "vector": [v.tobytes() for v in x]})
    found = lattice._compare(unit, 0.93)
    assert sorted(zip(found["node"], found["links"], found["root"], strict=True)) == [("a", 1, "a"), ("b", 1, "b"), ("c", 1, "a"), ("d", 1, "b")]


def test_lattice_of_many_repeated_rows(spark):
    rows = [(7, [1.0, 2.0], "l")] * 300 + [(8, [1.0, 2.0], "m")] + [(9, [1.0, 2.001], "l")]
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in lattice.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert got == {(7, 300, 7, True), (8, 0, 8, True), (9, 300, 7, False)}


def test_lattice_of_huge_tiny_and_repeated_vectors(spark):
    base = np.random.default_rng(3).standard_normal(64)
    other = base + 0.01
    rows = [(1, (base * 1e200).tolist(), "a"), (2, (other * 1e200).tolist(), "a"), (3, (base * 1e-200).tolist(), "a"), (4, (base * 1e300).tolist(), "b"), (5, base.tolist(), "b"), (5, base.tolist(), "b"), (6, [1e-310] * 64, "c"), (7, [2e-310] * 64, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("node", F.lit(1))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in lattice.link(df).collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 2, 4, True), (5, 2, 4, False), (5, 2, 4, False), (6, 1, 6, True), (7, 1, 6, False)]


def test_e8_points_are_nearest():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 8)) * 2
    p = e8.nearest(x)
    d = ((x - p) ** 2).sum(axis=1)
    assert d.max() <= 1 + 1e-9
    for root in e8.roots():
        assert (((x - p - root) ** 2).sum(axis=1) >= d - 1e-9).all()


# 8 packing


def test_tokens_equal_the_tokenizers(docs):
    path, ranks = packing.vocabulary(packing.TOKENIZER), packing.vocabulary(packing.RANKS)
    encode = packing._tokenizer(path, ranks)[0]
    odd = ["a<|endoftext|>b", "l'été ×÷ ²³ 'll I'LL\r\n\t  x  ", "  \n \n a", "日本語 text", "a \n b", "a\n\n b c \t d", "x 's y", " a", "a ", "a   b", " x y", "\x1c a b"]
    for text in odd + [r["text"] for r in docs.limit(100).collect()]:
        assert packing.token_bytes(text, path, ranks) == np.array(encode(text), "<u4").tobytes(), text


def test_packing_round_trip(spark, docs, odd):
    path, ranks = packing.vocabulary(packing.TOKENIZER), packing.vocabulary(packing.RANKS)
    for df in (docs, odd):
        rows = packing.pack(df).collect()
        by_seq = collections.defaultdict(list)
        for r in rows:
            by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in by_seq.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 2048
        want = collections.Counter()
        for r in df.collect():
            ids = packing.token_bytes(r["text"], path, ranks) + bytes(4)
            n, start = len(ids) // 4, 0
            for piece in range(-(-n // 2048)):
                length = n % 2048 or 2048 if piece == 0 else 2048
                want[r["doc_id"], piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])] += 1
                start += length
            assert start == n
        assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
        assert len(by_seq) <= 1.02 * sum(r["length"] for r in rows) / 2048 + 2
    assert packing.pack(docs.limit(0)).count() == 0


def best_bins(sizes, capacity):
    """Fewest bins by exhaustive search."""
    best = [len(sizes)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                put(i + 1, bins[:k] + [bins[k] + sizes[i]] + bins[k + 1 :])
        put(i + 1, bins + [sizes[i]])

    put(0, [])
    return best[0]


def test_reduction_never_costs_a_bin():
    rng = random.Random(9)
    for _ in range(150):
        sizes = sorted((rng.randrange(1, 21) for _ in range(rng.randrange(1, 10))), reverse=True)
        fixed, rest = packing.reduced(collections.Counter(sizes), 20)
        assert sum(n for _, n in fixed) + best_bins(sorted(rest.elements(), reverse=True), 20) == best_bins(sizes, 20)
        assert collections.Counter(x for c, n in fixed for x in c for _ in range(n)) + rest == collections.Counter(sizes)


# 9 mixing


def test_counts_follow_poisson(spark):
    rows = [(i, "big" if i % 10 else "small") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string").withColumn("rate", F.lit("x"))
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    got = mixing.copies(df, weights).groupBy("source").agg(F.count("*").alias("n"), F.max("rate").alias("rate")).collect()
    for r in got:
        want = 5000 if r["source"] == "big" else 15_000
        assert abs(r["n"] - want) < 5 * math.sqrt(want)
    counts = mixing.copies(df, weights).where("source = 'small'").groupBy("doc_id").count()
    n = {r["count"]: r["docs"] for r in counts.groupBy("count").agg(F.count("*").alias("docs")).collect()}
    rate = 7.5
    for k in range(4, 12):
        want = 2000 * math.exp(-rate) * rate**k / math.factorial(k)
        assert abs(n.get(k, 0) - want) < 5 * math.sqrt(want)


def test_large_rates_are_sums_of_draws(spark):
    df = spark.createDataFrame([(1, "tiny")] + [(i, "rest") for i in range(2, 2002)], "doc_id long, source string")
    weights = spark.createDataFrame([("tiny", 1.0), ("rest", 1.0)], "source string, weight double")
    assert abs(mixing.copies(df, weights).where("source = 'tiny'").count() - 1000) < 5 * math.sqrt(1000)


def test_mixing_edges(odd, empty):
    got = mixing.copies(odd).collect()
    assert {r["source"] for r in got} <= {None, "s", "t"} and mixing.mix(empty).count() == 0
    clash = odd.withColumnRenamed("rank", "rate").withColumn("copy", F.lit("c")).withColumn("cdf", F.lit(0)).withColumn("_source", F.lit("u"))
    assert mixing.mix(clash).columns == [*odd.columns[:-1], "cdf", "_source", "rate", "copy"]
    same = mixing.mix(clash, counted=False)
    assert same.columns == clash.columns and sorted(r["rate"] for r in same.collect()) == sorted(r["rank"] for r in got)


# 10 join


def brute_jaccard(rows, least=0.8):
    sets = {}
    for i, text in rows:
        words = re.findall(r"\w+", (text or "").lower())
        n = min(5, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    links, parent = {i: 0 for i in sets}, {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            x, y = sets[i], sets[j]
            if x and y and len(x & y) >= least * len(x | y) - 1e-9:
                links[i], links[j] = links[i] + 1, links[j] + 1
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: (find(i), links[i]) for i in ids}


def planted(n_groups=8, copies=15):
    rng = random.Random(8)
    rows = []
    for _ in range(n_groups):
        words = [f"w{rng.randrange(500)}" for _ in range(120)]
        for _ in range(copies):
            other = list(words)
            for _ in range(rng.randrange(3)):
                other[rng.randrange(len(other))] = "changed"
            rows.append((len(rows), " ".join(other)))
    return rows + [(900, None), (901, ""), (902, "one two"), (903, "one  TWO"), (904, "!!"), (905, "one two three")]


def test_links_match_brute_force(spark):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x"))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.link(df).collect()}
    assert got == brute_jaccard(rows)
    kept = {r["doc_id"] for r in ngram_join.keep_one(df).collect()}
    assert kept == {i for i, (c, _) in brute_jaccard(rows).items() if i == c}
    assert ngram_join.keep_one(df).columns == df.columns


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    rows = planted(2, 40)
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 6)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.link(df).collect()} == brute_jaccard(rows)


def test_banding_reaches_its_recall():
    for s in (0.8, 0.9):
        bands, rows = ngram_join.banding(s)
        p = s**rows
        assert bands * rows <= ngram_join.MINIMA and 1 - sum(math.comb(bands, k) * p**k * (1 - p) ** (bands - k) for k in range(3)) >= 0.995


def test_join_edges(odd, empty):
    got = ngram_join.link(odd).collect()
    assert len(got) == odd.count() and sorted(r["n_links"] for r in got if r["doc_id"] == 1) == [1, 1]
    clash = odd.withColumn("_kept", F.lit("x")).withColumn("_md5", F.lit("y")).withColumn("id", F.lit(1)).withColumn("node", F.lit("z"))
    assert sorted(map(str, ngram_join.keep_one(clash).drop("_kept", "_md5", "id", "node").collect())) == sorted(map(str, ngram_join.keep_one(odd).collect()))
    assert {(r["_kept"], r["_md5"], r["id"], r["node"]) for r in ngram_join.keep_one(clash).collect()} == {("x", "y", 1, "z")}
    kept = ngram_join.keep_one(odd)
    assert kept.count() == odd.count() - 1 and kept.columns == odd.columns
    assert ngram_join.link(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0


def test_word_hashes_stand_for_words():
    rng = random.Random(40)
    texts = ["".join(rng.choice("aab_é1 ,\n-ßİ٣") for _ in range(rng.randrange(0, 60))).lower() for _ in range(300)] + ["x" * 5000, "", "--", "\ud800a"]
    by_word = collections.defaultdict(set)
    for text in texts:
        words = re.findall(r"\w+", text)
        found = ngram_join.word_hashes(text).tolist()
        assert len(found) == len(words)
        for w, h in zip(words, found, strict=True):
            by_word[w].add(h)
    assert all(len(h) == 1 for h in by_word.values()) and len(set().union(*by_word.values())) == len(by_word) > 500


def test_few_edges_are_joined_in_one_task_and_many_in_rounds(spark):
    from chronotally.llm.common import connected_components

    edges = [(k, k + 1) for k in range(300) if k % 50 != 49] + [(7, 7), (-5, 290)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {k: -5 if k >= 250 else k - k % 50 for k in range(301)} | {-5: -5}
    want[300] = want[299] if (299, 300) in edges else 300
    want = {k: c for k, c in want.items() if any(k in e and e[0] != e[1] for e in edges)}
    context = spark.sparkContext
    for rows, most_jobs in ((1000, 25), (100, None)):
        context.setJobGroup(f"components-{rows}", "")
        got = {r["node"]: r["component"] for r in connected_components(df, rows_a_part=rows).collect()}
        assert got == want
        jobs = len(context.statusTracker().getJobIdsForGroup(f"components-{rows}"))
        assert most_jobs is None or jobs < most_jobs
    assert connected_components(df.where("a > 1000"), rows_a_part=10).count() == 0
