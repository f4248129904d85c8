"""Periodic runs, WARC archives and Merkle manifests against plain versions, with odd and hostile input."""

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronotally.llm import merkle, periodic, warc
from chronotally.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    rows = [(1, "a b " * 9, "en", "s", 27, 1), (1, "a b " * 9, "en", "s", 27, 1), (2, None, "en", "s", None, 2), (3, "", None, None, 0, 3), (None, "x", "de", "s", 1, 4), (None, "x y", "de", "s", 3, 4), (4, long, "fr", None, len(long), 5), (4, "y \t z\x0b\n", "fr", "t", 5, 6), (5, "%% 1 \U0001f600", "", "t", 9, 7), (-(2**63), "m", "en", "t", 1, 8), (2**63 - 1, "m", "en", "t", 1, 9)]
    return spark.createDataFrame(rows, DOCS + ", slot int")


# 11 periodic runs


def plain_runs(words, least=12):
    """All maximal stretches with period q, the smallest q of each."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q) and i > start:
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def random_text(rnd, n):
    words = [rnd.randrange(rnd.choice([1, 2, 3, 60])) for _ in range(n)]
    if n and rnd.random() < 0.6:
        a, p = rnd.randrange(n), rnd.randint(1, n)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_equal_brute_force_however_words_are_appended():
    rnd = random.Random(11)
    for _ in range(60):
        texts = [random_text(rnd, rnd.choice([0, 1, 11, 12, 40, 150])) for _ in range(rnd.randint(0, 5))]
        least = rnd.choice([12, 12, 2, 30])
        want = [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t, least)]
        for slab in (1 << 17, 1, 17):
            s, e, q, t = periodic.runs_of([np.array(x, np.int64) for x in texts], least, slab)
            assert sorted(zip(t.tolist(), s.tolist(), (e - s).tolist(), q.tolist(), strict=True)) == want


def test_runs_of_structured_words():
    thue = [bin(i).count("1") % 2 for i in range(4096)]  # no overlaps: squares only
    fib = "a"
    nxt = "ab"
    while len(nxt) < 600:
        fib, nxt = nxt, nxt + fib
    for words in (thue[:700], [ord(c) for c in nxt[:600]], [0] * 500, list(range(300)) * 2):
        s, e, q, _ = periodic.runs_of([np.array(words, np.int64)])
        assert list(zip(s.tolist(), (e - s).tolist(), q.tolist(), strict=True)) == plain_runs(words)
    s, e, q, _ = periodic.runs_of([np.tile(np.arange(70_000), 3)])
    assert (s.tolist(), e.tolist(), q.tolist()) == ([0], [210_000], [70_000])


def plain_op11(rows):
    out = []
    for doc, text in rows:
        words = re.findall(periodic.WORD, text or "")
        n, h = len(words), zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed, kept = "".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_op11_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") < 6000)
    got = periodic.digest(periodic.find_runs(periodic.planted(docs)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_op11([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert Q.op11_periodic_runs(spark, SF).where("n_runs > 0").count() > 5


def test_op11_plants_any_number_of_words(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, " ".join(str(j) for j in range(k * k))) for k, i in enumerate(ids)]
    got = periodic.digest(periodic.find_runs(periodic.planted(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert sorted(map(tuple, got.collect()), key=str) == plain_op11(rows)


def test_runs_of_odd_rows(spark, odd):
    got = periodic.find_runs(odd.withColumn("Runs", F.lit(1)).withColumn("row", F.lit("r")))
    assert got.columns == [*odd.columns, "row", "runs", "collapsed"]
    rows = {(r["doc_id"], r["text"] is None, r["n_chars"]): r for r in got.collect()}
    assert got.count() == odd.count() and rows[1, False, 27]["collapsed"] == "a b" and [tuple(x) for x in rows[1, False, 27]["runs"]] == [(0, 18, 2)]
    assert (rows[2, True, None]["runs"], rows[2, True, None]["collapsed"]) == ([], "") and rows[4, False, 5]["collapsed"] == "y z"
    assert len(rows[4, False, len(" ".join(f"word{i % 977}" for i in range(20_000)))]["collapsed"].split()) == 977
    assert periodic.find_runs(odd.limit(0)).count() == 0


# 12 WARC


def plain_op12(rows, least=1000):
    body = {i: (h or "").encode() for i, (_, h) in enumerate(rows)}
    out = []
    for i, (page, _) in enumerate(rows):
        same = [rows[j][0] for j in body if body[j] == body[i]] if len(body[i]) >= least else [page]
        winner = max((p for p in same if p is not None), default=None)
        again = len(same) > 1 and winner is not None and page != winner
        out.append((page, len(body[i]), hashlib.sha1(body[i]).hexdigest(), "revisit" if again else "response", winner if again else None, None))
    return sorted(out, key=str)


PAGES = [
    (1, "x" * 1000), (2, "x" * 1000), (3, "x" * 999), (4, "x" * 999), (5, None), (6, ""), (7, "WARC/1.1\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\nWARC/1." * 40), (7, "é\U0001f600\r\n" * 2000), (7, "é\U0001f600\r\n" * 2000),
    (None, "y" * 3000), (None, "y" * 3000), (8, "y" * 2000), (None, "y" * 2000), (9, "0\r\n\r\n" * 700), (10, "z" * 100_000), (11, "z" * 100_000), (12, "z" * 100_001), (13, "WARC/1."), (14, "\r\n\r\n"),
]


@pytest.mark.parametrize("segment,chunk", [(32 * 1024, 8192), (100, 7), (1, 1000)])
def test_op12_odd_pages_come_back(spark, segment, chunk):
    pages = PAGES if segment > 1 else PAGES[2:6] + PAGES[13:14]
    df = spark.createDataFrame([(p, f"http://h/{p}\r\nX-Key: 99", h, "row") for p, h in pages], "page_id long, url string, html string, `key` string").repartition(3)
    got = warc.round_trip(df, segment=segment, chunk=chunk)
    assert sorted(map(tuple, got.collect()), key=str) == plain_op12(pages)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_archives_give_back_whole_payloads(spark, tmp_path):
    df = spark.createDataFrame([(p, f"http://h/{i}", h) for i, (p, h) in enumerate(PAGES)], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"), segment=5000)
    rows = warc.read_archives(spark, str(tmp_path / "a")).collect()
    got = {r["headers"]["warc-target-uri"]: r["payload"] for r in rows if r["headers"]["warc-type"] == "response"}
    assert len(rows) == len(PAGES) and all(r["problem"] is None for r in rows)
    assert all(bytes(v) == (PAGES[int(uri.rsplit("/", 1)[1])][1] or "").encode() for uri, v in got.items()) and len(got) == len(PAGES) - 3


def record(kind, ident, block, **more):
    fields = {"WARC-Type": kind, "WARC-Record-ID": ident, "Content-Type": "application/http; msgtype=response", **{k.replace("_", "-"): v for k, v in more.items()}, "Content-Length": str(len(block))}
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_reader_takes_foreign_archives_and_reports_faults(spark, tmp_path):
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n"
    body = head + b"4;ext=1\r\nWARC\r\n3\r\n/1.\r\n0\r\nTrailer: 1\r\n\r\n"
    cut = lambda ident, *parts, total=len(body): [record("response" if k == 0 else "continuation", ident if k == 0 else f"{ident}-{k}", p, WARC_Segment_Number=str(n), **({} if k == 0 else {"WARC_Segment_Origin_ID": ident}), **({"WARC_Segment_Total_Length": str(total)} if p == parts[-1][1] else {})) for k, (n, p) in enumerate(parts)]
    a = cut("<a>", (1, body[:50]), (2, body[50:60]), (3, body[60:]))
    b = cut("<b>", (1, body[:50]), (3, body[50:]))
    c = cut("<c>", (1, body[:50]), (2, body[50:]), total=1)
    d = [record("response", "<d>", head + b"5\r\nab"), record("warcinfo", "<e>", b"software: x", Content_Type="application/warc-fields"), record("response", "<f>", b"HTTP/1.1 200 OK\r\n\r\nplain", WARC_Payload_Digest="sha1:" + "0" * 40)]
    files = {"1": [a[2], d[0], b[1], c[1]], "2": [a[1], d[1], b[0]], "3": [a[0], d[2], c[0], record("response", "<g>", body)[:-60]]}
    for name, records in files.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))  # a member a record
    got = {r["headers"]["warc-record-id"]: (r["payload"] and bytes(r["payload"]), r["problem"]) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got["<a>"] == (b"WARC/1.", None) and got["<b>"] == (None, "segments missing or repeated") and got["<c>"] == (None, "total length differs")
    assert got["<d>"] == (None, "bad chunk") and got["<e>"] == (b"software: x", None) and got["<f>"] == (b"plain", "payload digest differs") and got["<g>"][1] == "truncated" and len(got) == 7


# 13 Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_op13(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: sha(*[field(r[c]) for c in ("doc_id", "source", "lang")], field(None if r["n_chars"] is None else r["n_chars"] + more), field(r["text"]))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for x in by.values():
        x.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {x: levels([leaf(r) for r in by[x]]) for x in langs}
    top, out = levels([trees[x][-1][0] for x in langs]), []
    path = lambda tree, i: [((t[(i >> j) ^ 1] if (i >> j) ^ 1 < len(t) else ""), (i >> j) & 1) for j, t in enumerate(tree[:-1])]
    for k, lang in enumerate(langs):
        for i, r in enumerate(by[lang]):
            steps = path(trees[lang], i) + path(top, k)
            h = leaf(r, int(r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0))
            for s, left in steps:
                h = sha(s, h) if left else sha(h, s)
            out.append((r["doc_id"], leaf(r), trees[lang][-1][0], top[-1][0], sha(*[s for s, _ in steps]), h, h == top[-1][0]))
    return sorted(map(str, out))


def audit(df):
    return sorted(str(tuple(r)) for r in merkle.audited(df).collect())


def test_op13_odd_rows_and_repeated_ids(spark, odd):
    assert audit(odd) == plain_op13(odd.collect())
    assert audit(odd.limit(0)) == []
    assert audit(odd.limit(1)) == plain_op13(odd.limit(1).collect())


@pytest.mark.parametrize("n", [2, 1024, 1025, 2049])
def test_op13_sizes_round_array_borders(spark, n):
    rows = [(i * 7919 % 100_003, str(i), "en", "s", i) for i in range(n)]
    df = spark.createDataFrame(rows, DOCS)
    assert audit(df) == plain_op13(df.collect())


def test_op13_sparse_ids_hot_ids_and_many_groups(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice([None, 5, rnd.randrange(-(2**63), 2**63)]), rnd.choice(["x", None, "é"]) if rnd.random() < 0.5 else str(rnd.random()), rnd.choice([None, "", "a", "\U0001f600", "￿", str(rnd.randrange(40))]), None, rnd.choice([None, 1])) for _ in range(900)]
    df = spark.createDataFrame(rows + rows[:30] + [(5, "t", "a", "s", 1)] * 1500, DOCS)
    assert audit(df) == plain_op13(df.collect())


def test_manifest_places_and_other_groups(spark, odd):
    rows = merkle.manifest(odd, group="source", columns=("doc_id", "text")).collect()
    assert sorted((str(r["source"]), r["slot"]) for r in rows) == [(s, i) for s, n in (("None", 2), ("s", 5), ("t", 4)) for i in range(n)]
    assert len({r["root"] for r in rows}) == 1
