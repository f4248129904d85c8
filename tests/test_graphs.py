"""Graphs in log rounds and distributed prefix sums against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from chronotally.operators import graphs as G
from chronotally.operators import prefix as P
from chronotally.operators import quantiles as Q

BUILDS = "repo string, id long, base long, head long, item long, failed boolean"


@pytest.fixture
def rounds(monkeypatch):
    """Counts checkpoints, of which a round of doubling has one."""
    n, real = [0], G.checkpointed

    def counted(df):
        n[0] += 1
        return real(df)

    monkeypatch.setattr(G, "checkpointed", counted)
    return n


def plain_chains(rows):
    node, out = {}, {}
    for scope, i, base, head, item, failed in rows:
        if head is not None and ((scope, head) not in node or i < node[scope, head][0]):
            node[scope, head] = (i, base, item, failed)
    for scope, i, base, _, item, failed in rows:
        path, seen, at = [(item, failed)], {i}, (scope, base)
        while at in node and node[at][0] not in seen:
            i2, b2, m2, f2 = node[at]
            path.append((m2, f2))
            seen.add(i2)
            at = (scope, b2)
        out[i] = ([m for m, _ in path][::-1], len(path), any(f for _, f in path[1:]))
    return out


def test_chains_with_cycles_forks_and_scopes(spark):
    r = random.Random(0)
    rows = [(r.choice("rq"), i, r.randrange(60) if r.random() < 0.9 else None, r.randrange(60), i * 10, r.random() < 0.1) for i in range(80)]
    df, want = spark.createDataFrame(rows, BUILDS), plain_chains(rows)
    got = G.queue_chain(df, "repo", "id", "base", "head", "item", "failed").collect()
    assert {x["id"]: (x["chain"], x["position"], x["ahead_failed"]) for x in got} == want
    got = G.queue_chain(df, "repo", "id", "base", "head", "item", "failed", listed=False).collect()
    assert {x["id"]: (x["position"], x["ahead_failed"]) for x in got} == {i: v[1:] for i, v in want.items()}


def test_a_chain_of_ten_thousand_takes_few_rounds(spark, rounds):
    n = 10_000
    df = spark.range(1, n + 1).select(F.lit("r").alias("repo"), "id", (F.col("id") - 1).alias("base"), F.col("id").alias("head"), F.col("id").alias("item"), (F.col("id") == 5000).alias("failed"))
    got = {r["id"]: (r["position"], r["ahead_failed"]) for r in G.queue_chain(df, "repo", "id", "base", "head", "item", "failed", listed=False).collect()}
    assert got == {i: (i, i > 5000) for i in range(1, n + 1)} and rounds[0] <= 18


def test_landings_of_random_histories(spark):
    r = random.Random(1)
    parents = [(r.choice("rq"), r.randrange(40), r.randrange(40)) for _ in range(45)]
    pushes = [(r.choice("rq"), r.randrange(40), r.randrange(1000)) for _ in range(8)]
    own, moving = {}, True
    for s, c, at in pushes:
        own[s, c] = min(at, own.get((s, c), at))
    best = dict(own)
    while moving:
        moving = False
        for s, c, p in parents:
            if (s, c) in best and best[s, c] < best.get((s, p), 10**9):
                best[s, p], moving = best[s, c], True
    tested = spark.createDataFrame([(s, c) for s in "rq" for c in range(40)], "repo string, sha long")
    found = G.ancestor_landings(tested, spark.createDataFrame(parents, "repo string, sha long, parent long"), spark.createDataFrame(pushes, "repo string, sha long, pushed_at long"), "repo")
    assert {(x["repo"], x["sha"]): (x["landed_at"], x["source"]) for x in found.collect()} == {k: (v, "push" if own.get(k) == v else "ancestor-bound") for k, v in best.items()}


def test_a_straight_history_lands_in_few_rounds(spark, rounds):
    n = 3000
    parents = spark.range(1, n).select(F.lit("r").alias("repo"), F.col("id").alias("sha"), (F.col("id") - 1).alias("parent"))
    pushes = spark.createDataFrame([("r", n - 1, 7), ("r", 100, 3)], "repo string, sha long, pushed_at long")
    got = {r["sha"]: (r["landed_at"], r["source"]) for r in G.ancestor_landings(spark.range(n).select(F.lit("r").alias("repo"), F.col("id").alias("sha")), parents, pushes, "repo").collect()}
    assert got == {i: (3 if i <= 100 else 7, "push" if i in (100, n - 1) else "ancestor-bound") for i in range(n)} and rounds[0] <= 20


def test_reachable_over_lines_cycles_and_branches(spark, rounds):
    r = random.Random(2)
    links = [(r.randrange(70), r.randrange(70)) for _ in range(75)] + [(i, i + 1) for i in range(1000, 2000)] + [(2000, 1500), (5000, 5001), (5001, 5000)]
    roots = [r.randrange(70) for _ in range(3)] + [999, 1000, 1700]
    seen, todo = set(roots), list(roots)
    children = {}
    for a, b in links:
        children.setdefault(a, []).append(b)
    while todo:
        for b in children.get(todo.pop(), []):
            if b not in seen:
                seen.add(b)
                todo.append(b)
    found = G.reachable_set(spark.createDataFrame([(x,) for x in roots], "node long"), spark.createDataFrame(links, "p long, c long"), "node", "p", "c")
    assert sorted(x["node"] for x in found.collect()) == sorted(seen) and rounds[0] <= 40


def test_prefix_sums_of_a_hot_key_over_many_ranges(spark):
    r = random.Random(3)
    rows = [(r.choice([None, "hot", "hot", "hot", "hot", "cold"]), r.randrange(50), i, r.choice([None, r.randrange(9)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o long, i long, v long").repartition(5)
    want, sums = {}, {}
    for k, o, i, v in sorted(rows, key=lambda x: (x[0] or "", x[1], x[2])):
        sums[k] = sums.get(k, 0) + (v or 0)
        want[i] = sums[k]
    found = P.prefix_sums(df, ["k"], ["o", "i"], {"s": F.col("v")}, ranges=16)
    got = found.collect()
    assert {x["i"]: x["s"] for x in got} == want and all(x["s_total"] == sums[x["k"]] for x in got) and len(got) == len(rows)
    plan = found._jdf.queryExecution().toString()
    assert "Window" in plan and plan.count("_range") > 3
    index = P.ordered_index(df, [F.col("o").desc(), F.col("i")], "ix").collect()
    assert [x["i"] for x in sorted(index, key=lambda x: x["ix"])] == [x[2] for x in sorted(rows, key=lambda x: (-x[1], x[2]))] and [x["ix"] for x in sorted(index, key=lambda x: x["ix"])] == list(range(3000))


def test_eviction_over_collections_keeps_the_fixed(spark):
    r = random.Random(4)
    rows = [(r.choice("st"), r.choice(["batches", "events", "tasks", "inputs"]), i, r.randrange(1, 9)) for i in range(400)]
    rank = {"events": 0, "tasks": 1, "inputs": 2, "batches": 3}
    want = {}
    for s in "st":
        left = sum(x[3] for x in rows if x[0] == s)
        for x in sorted((x for x in rows if x[0] == s), key=lambda x: (rank[x[1]], x[2])):
            want[x[2]] = x[1] != "batches" and left > 300
            left -= x[3] if want[x[2]] else 0
    df = spark.createDataFrame(rows, "source string, collection string, id long, size long").withColumn("rank", F.element_at(F.create_map(*[F.lit(y) for kv in rank.items() for y in kv]), F.col("collection")))
    found = P.budget_eviction(df, ["source"], ["rank", "id"], "size", 300, fixed=F.col("collection") == "batches")
    assert {x["id"]: x["evicted"] for x in found.collect()} == want and any(want.values())
    counts = {(x["source"], x["collection"]): (x["n_evicted"], x["complete"]) for x in P.evicted_counts(found, ["source"], "collection", "size").collect()}
    assert counts == {(s, c): (n := sum(want[x[2]] for x in rows if x[:2] == (s, c)), n == 0) for s in "st" for c in rank}


def test_quantile_of_one_key_of_distinct_values(spark):
    df = spark.range(20_000).select(F.lit("k").alias("k"), (F.col("id") * 7919 % 20_011).alias("v"))
    values = sorted(i * 7919 % 20_011 for i in range(20_000))
    got = Q.weighted_quantiles(df, ["k"], "v", F.lit(1), {"median": 0.5, "p90": 0.9}).first()
    assert (got["median"], got["p90"], got["total"]) == (values[9999], values[17_999], 20_000)
