"""Golden cases and properties of the operators."""

import random

from pyspark.sql import functions as F

from chronotally.functions import columns as C
from chronotally.operators import activity as A
from chronotally.operators import graphs as G
from chronotally.operators import intervals as I
from chronotally.operators import joins as J
from chronotally.operators import metrics as M
from chronotally.operators import quality as V
from chronotally.operators import reports as R
from chronotally.operators import snapshots as N
from chronotally.operators import state as S


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_touching_intervals_do_not_overlap(spark):
    df = spark.createDataFrame([("x", 0, 10), ("x", 10, 20), ("x", 5, 5)], "k string, a long, b long")
    assert values(I.peak_concurrency(df, ["k"], "a", "b", 100), "peak") == [(1,)]


def test_interval_ending_on_an_edge_stays_in_its_bucket(spark):
    df = spark.createDataFrame([(0, 600), (600, 601)], "a long, b long")
    assert values(I.interval_buckets(df, "a", "b", 600), "bucket", "lo", "hi") == [(0, 0, 600), (600, 600, 601)]


def test_peaks_match_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), a, a + rng.randrange(0, 50)) for a in (rng.randrange(0, 300) for _ in range(200))]
    df = spark.createDataFrame(rows, "k string, a long, b long")
    want = {}
    for k, a, b in rows:
        for bucket in range(a - a % 60, b, 60):
            for t in range(max(a, bucket), min(b, bucket + 60)):
                want[bucket, k, t] = want.get((bucket, k, t), 0) + 1
    peak = {}
    for (bucket, k, _), n in want.items():
        peak[bucket, k] = max(peak.get((bucket, k), 0), n)
    assert values(I.peak_concurrency(df, ["k"], "a", "b", 60), "bucket", "k", "peak") == sorted((b, k, n) for (b, k), n in peak.items())


def test_sampling_cutover_drops_weight_zero(spark):
    df = spark.createDataFrame([(0, 1200, 600, 3.0), (0, 1200, 600, 0.0)], "a long, b long, cut long, w double")
    assert values(I.sampling_cutover(df, "a", "b", "cut", "w"), "part_start", "part_end", "part_weight") == [(0, 600, 3.0), (600, 1200, 1.0), (600, 1200, 1.0)]


def jobs(spark, rows):
    return spark.createDataFrame(rows, "id long, kind string, conclusion string, created long, started long, ended long, assigned boolean, weight int")


def random_jobs(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = rng.randrange(0, 10**12)
        s = a + rng.randrange(0, 10**9)
        out.append((i, rng.choice("xyz"), rng.choice(["success", "failure", "cancelled"]), a, s, s + rng.randrange(0, 10**10), rng.random() > 0.2, rng.choice([1, 2])))
    return out


def test_incremental_metrics_equal_recomputing(spark):
    before, after = random_jobs(1, 120), random_jobs(1, 100) + random_jobs(2, 40)[:20]
    a, b = (M.contributions(jobs(spark, x), step=7_200_000_000) for x in (before, after))
    got = M.summed(M.summed(a).unionByName(M.diff_contributions(a, b)))
    key = lambda df: {tuple(str(r[k]) for k in M.KEY): round(r["amount"], 6) for r in df.collect()}
    assert key(got) == key(M.summed(b))


def test_deltas_count_once_per_receipt(spark):
    """A receipt that came twice counts once, and both of its rows of one key do."""
    d = "day date, bucket long, metric string, value double, amount double"
    state = spark.createDataFrame([("r0", 1, None, 1, "m", 0.0, 1.0)], "receipt string, delivery int, " + d)
    rows = [("r1", n, None, 1, "m", 0.0, x) for n in (1, 2) for x in (2.0, 3.0)] + [("r2", 7, None, 1, "m", 0.0, 3.0), ("r2", 7, None, 1, "m", 0.0, 3.0)]
    delta = spark.createDataFrame(rows, "receipt string, delivery int, " + d)
    assert values(M.apply_deltas(state, delta, "receipt", "delivery"), "amount") == [(12.0,)]


def test_features_of_null_and_repeated_rows(spark):
    left = spark.createDataFrame([(1, "a", 10, None), (1, "a", 10, None), (2, "a", 4, "x"), (3, None, 10, "y"), (4, "a", None, "z"), (5, "b", 10, "w")], "id long, k string, known long, note string")
    features = spark.createDataFrame([("a", 5, 1, 0.5), ("a", 9, 1, 0.9), ("a", 9, 2, None), ("a", 11, 3, 1.1), (None, 1, 4, 0.1), ("b", None, 5, 0.2)], "k string, available long, fid long, feature double")
    got = J.pit_feature_join(left, features, ["k"], "known", "available", ["fid"])
    assert got.columns == ["id", "k", "known", "note", "available", "fid", "feature"]
    assert sorted((r["id"], r["fid"] or 0) for r in got.collect()) == [(1, 2), (1, 2), (2, 0), (3, 0), (4, 0), (5, 0)]


def test_group_cost_follows_overlap_age_and_dependency(spark):
    rows = [("g", 1, ["a", "b"], 10, 0, False), ("g", 2, ["b", "c", "b"], 20, 250, False), ("g", 3, [], 5, 900, None), ("g", 4, None, 5, None, True), ("h", 1, ["a"], 10, 0, False)]
    df = spark.createDataFrame(rows, "g string, m int, modules array<string>, w int, behind int, dep boolean")
    got = values(R.group_overlap_cost(df, "g", "m", "modules", "w", behind="behind", dependency="dep", fixed=100, per_work=2, multiplier=3), "g", "members", "work", "cost")
    work = 10 + 20 * (1 - 0.5 * 0.5) * 1.5 + 5 * 2 + 5
    assert got == [("g", 4, work, (100 + 2 * work) * 3), ("h", 1, 10.0, 120.0)]
    assert values(R.group_overlap_cost(df, "g", "m", "modules", "w", overlap=1), "work")[-1] == (10 + 20 * 0.5 + 5 + 5,)


def test_linear_fits(spark):
    rows = [("a", x, 2 * x + 7) for x in (1, 2, 3, 10)] + [("b", x, 100 - x) for x in range(5)] + [("c", 1, 5), ("c", 1, 6), ("c", 1, 7), ("d", 1, 2), ("d", 2, 3), ("e", 1, 1), ("e", 2, 1), ("e", 4, 3), ("e", None, 9)]
    df = spark.createDataFrame(rows, "k string, x int, y int")
    assert values(R.linear_fit(df, ["k"], "x", "y"), "k", "n", "intercept", "slope") == [("a", 4, 7.0, 2.0), ("b", 5, 98.0, 0.0), ("c", 3, 1.0, 0.0), ("d", 2, 1.0, 0.0), ("e", 3, 1.0, round(5 / 7, 9))]


def test_triggers_of_dispatches(spark):
    title = f"bors branch=main batch=7 head={'a' * 40} base={'b' * 40}"
    rows = [("repository_dispatch", title, "staging.yml", None, "bors_staging"), ("repository_dispatch", title.replace("main", "dev"), "staging.yml", None, "bors_unknown"), ("repository_dispatch", None, "staging.yml", "", "bors_unknown"), ("repository_dispatch", title, "other.yml", None, "repository_dispatch"), ("repository_dispatch", title, None, None, "repository_dispatch"), ("repository_dispatch", title, "staging.yml", "given", "given"), ("pull_request_target", None, None, None, "pr"), (None, None, None, None, "")]
    df = spark.createDataFrame(rows, "event string, title string, workflow string, given string, want string")
    got = df.withColumn("got", C.derive_trigger(*[F.col(c) for c in ("event", "title", "workflow", "given")], "staging.yml")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_backlog_states(spark):
    """Held ones keep their place, settled ones are stuck, zombies go stale after a day, superseded attempts do not count."""
    hour, day = A.HOUR, A.DAY
    clock = 100 * day
    runs = [  # run, attempt, status, verified, created
        (1, 1, "queued", True, clock - 2 * hour), (2, 1, "in_progress", True, clock - 2 * hour), (3, 1, "pending", True, clock - 9 * day), (4, 1, "queued", True, clock - hour), (5, 1, "queued", True, clock - 3 * day),
        (6, 1, "in_progress", True, clock - 3 * day), (6, 2, "completed", True, clock), (7, 1, "in_progress", False, clock - 3 * day), (8, 1, "odd", None, clock - hour), (9, 1, "in_progress", True, clock - 3 * day), (10, 1, "queued", False, clock - 3 * day),
    ]
    jobs = [(2, True, False, True, clock - hour), (5, True, False, False, clock - 2 * day), (5, True, False, False, clock - 3 * day), (7, True, False, False, None), (9, True, False, False, clock - hour), (1, False, False, False, clock - hour)]
    r = spark.createDataFrame([(*x, x[4], None, "c") for x in runs], "run long, attempt int, status string, verified boolean, created long, updated long, started long, category string")
    j = spark.createDataFrame([(x[0], 1, *x[1:]) for x in jobs], "run long, attempt int, active boolean, estimated boolean, in_progress boolean, created long")
    got = dict(values(A.workflow_backlog(r, j, "category", clock), "run", "state"))
    assert got == {1: "stuck", 2: "in_progress", 3: "pending", 4: "queued", 5: "stale", 7: "pending", 8: "unconfirmed", 9: "pending", 10: "stale"}


def test_a_queued_job_never_runs(spark):
    rows = [(1, "x", "cancelled", 0, 10, 10**9, False, 1)]
    got = {r["metric"] for r in M.contributions(jobs(spark, rows), step=600_000_000).collect()}
    assert got == {"jobs/x", "queued/x"}


def test_frames_are_fenced_and_conflicts_seen(spark):
    cols = "source string, epoch long, sequence long, snapshot string, part int, parts int, digest string"
    rows = [("s", 1, 1, "old", 0, 1, "a"), ("s", 1, 2, "new", 0, 2, "a"), ("s", 1, 2, "new", 1, 2, "b"), ("s", 1, 3, "part", 0, 2, "a"), ("s", 1, 4, "odd", 0, 1, "a"), ("s", 1, 4, "odd", 0, 1, "b")]
    assert values(S.assemble_frames(spark.createDataFrame(rows, cols)), "snapshot", "state") == [("new", "complete"), ("odd", "conflict"), ("old", "fenced"), ("part", "incomplete")]


def test_queue_chain_stops_at_a_cycle_and_keeps_scopes_apart(spark):
    rows = [("r", 1, "a", "b", 41, False), ("r", 2, "b", "c", 42, False), ("q", 3, "b", "c", 43, False), ("r", 4, "x", "y", 44, True), ("r", 5, "y", "x", 45, False)]
    df = spark.createDataFrame(rows, "repo string, id long, base string, head string, item long, failed boolean")
    got = {r["id"]: (r["chain"], r["ahead_failed"]) for r in G.queue_chain(df, "repo", "id", "base", "head", "item", "failed").collect()}
    assert got == {1: ([41], False), 2: ([41, 42], False), 3: ([43], False), 4: ([45, 44], False), 5: ([44, 45], True)}


def test_queue_chain_of_any_length(spark):
    n = 200
    df = spark.createDataFrame([("r", i, i - 1, i, i, i == 2) for i in range(1, n + 1)], "repo string, id long, base long, head long, item long, failed boolean").coalesce(1)
    got = {r["id"]: (r["chain"], r["position"], r["ahead_failed"]) for r in G.queue_chain(df, "repo", "id", "base", "head", "item", "failed").collect()}
    assert got == {i: (list(range(1, i + 1)), i, i > 2) for i in range(1, n + 1)}


def test_landings_pass_through_ancestors_and_cycles(spark):
    tested = spark.createDataFrame([("r", "B"), ("r", "C"), ("q", "B")], "repo string, sha string")
    parents = spark.createDataFrame([("r", "C", "B"), ("r", "B", "C")], "repo string, sha string, parent string")
    pushes = spark.createDataFrame([("r", "C", 75)], "repo string, sha string, pushed_at long")
    assert values(G.ancestor_landings(tested, parents, pushes, "repo"), "sha", "landed_at", "source") == [("B", 75, "ancestor-bound"), ("C", 75, "push")]


def test_journal_replay_and_inversions(spark):
    df = spark.createDataFrame([(1, 60, 101, 1), (2, 70, 102, 1), (3, 65, 101, 1), (4, 190, 101, -1)], "id long, at long, item long, delta int").withColumn("k", F.lit(1))
    assert values(N.replay_journal(df, ["k"], "id", "item", "delta"), "id", "live") == [(1, 1), (2, 2), (3, 2), (4, 1)]
    assert values(N.clock_inversions(df, ["k"], "id", "at").where("uncertain"), "id", "monotone") == [(3, 70)]


def test_wilson_of_nothing_is_unknown(spark):
    p, lo, hi = C.wilson(F.lit(0), F.col("id"))
    assert spark.range(1).select(p.alias("p"), lo.alias("l"), hi.alias("h")).first() == (None, None, None)


def test_strict_validation_tells_null_from_missing(spark):
    spec = {"a": V.Field("integer", low=1), "b": V.Field("string", required=False, nullable=True)}
    rows = [('{"a":1}', None), ('{"a":null}', "null:a"), ("{}", "missing:a"), ('{"a":0}', "range:a"), ('{"a":1,"c":2}', "unknown:c"), ('{"a":"x"}', "type:a"), ("[]", "not-an-object"), (None, "not-an-object")]
    df = spark.createDataFrame(rows, "p string, want string").withColumn("got", V.reasons(F.col("p"), spec))
    assert [(r["got"]) for r in df.collect()] == [w for _, w in rows]
