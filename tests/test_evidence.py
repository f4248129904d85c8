"""Costs, cohorts, journals and public steps against plain loops and hand-made rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chronotally.functions import columns as C
from chronotally.operators import reports as R
from chronotally.operators import sequence as S
from chronotally.operators import snapshots as N

JOURNAL = "q string, id long, at long, kind string, input_id long, number long, members array<long>, withdrawn array<long>, against_main boolean, key string, value string"


def row(q, id_, at, kind, number=None, members=None, withdrawn=None, against=None, input_id=None, key=None, value=None):
    return (q, id_, at, kind, input_id, number, members, withdrawn, against, key, value)


def replayed(rows, lo, hi, step):
    """Samples by a loop over one journal in its order."""
    live, last, changes, unsure = set(), 0, [], []
    for r in sorted(rows, key=lambda r: r[1]):
        _, _, at, kind, _, number, members, withdrawn, against, *_ = r
        if kind not in ("approved", "landed", "withdrawn", "problem-anticipated", "probe-missing-source") and not (kind == "probe-conflict" and against):
            continue
        if kind == "landed" and not (members or withdrawn):
            continue
        if at < last:
            unsure.append((at, last))
        last = max(last, at)
        if kind == "approved":
            live.add(number)
        elif kind == "landed":
            live -= set(members or []) | set(withdrawn or [])
        else:
            live.discard(number)
        changes.append((last, len(live)))
    out = {}
    for tick in range(lo, hi + 1, step):
        now = [n for at, n in changes if at <= tick]
        out[tick] = (now[-1] if now else 0, not any(a <= tick <= b for a, b in unsure))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_samples_of_random_journals_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = []
    for q in ("a", "b"):
        clock = 0
        for k in range(1, 120):
            clock += rng.randrange(0, 40)
            at = max(0, clock - rng.choice([0, 0, 0, 0, 130]))
            kind = rng.choice(["approved"] * 4 + ["landed", "withdrawn", "problem-anticipated", "probe-missing-source", "probe-conflict", "setting", "else"])
            some = lambda n: [rng.randrange(12) for _ in range(rng.randrange(n))]  # noqa: B023, E731
            rows.append(row(q, k, at, kind, rng.randrange(12), some(4), rng.choice([None, some(2)]), rng.choice([None, True, False])))
    df = spark.createDataFrame(rows, JOURNAL)
    got = {(r["queue"], r["tick"]): (r["waiting"], r["complete"]) for r in N.queue_samples(df.withColumnRenamed("q", "queue"), ["queue"], 0, 2400, 60).collect()}
    want = {(q, t): v for q in ("a", "b") for t, v in replayed([r for r in rows if r[0] == q], 0, 2400, 60).items()}
    assert got == want
    assert any(not c for _, c in want.values())


GOOD = [row("q", 1, 5, "setting", key="publication_enabled", value="true"), row("q", 2, 6, "approved", 10, input_id=1), row("q", 3, 7, "approved", 11, input_id=2), row("q", 4, 8, "landed", members=[10]), row("q", 5, 9, "probe-conflict", 11, against=False)]
INPUTS = [("q", 1, 10, "o/a", "landed"), ("q", 2, 11, "o/a", "waiting")]
BATCHES = [("q", 7, "open", "o/a")]


def violations(spark, journal=GOOD, inputs=INPUTS, batches=BATCHES, members=(), until=20, captured=30):
    i = spark.createDataFrame(inputs, "q string, id long, number long, repository string, state string")
    b = spark.createDataFrame(batches, "q string, id long, state string, repository string")
    m = spark.createDataFrame(list(members), "q string, batch_id long, number long, removed boolean, withdrawn boolean")
    found = N.journal_violations(spark.createDataFrame(journal, JOURNAL), i, b, N.expected_backlog(i, m, b, ["q"]), ["q"], repository="o/a", until=until, captured=captured)
    return sorted((r["violation"], r["item"]) for r in found.collect())


def test_every_reason_to_refuse_a_journal(spark):
    assert violations(spark) == []
    assert violations(spark, GOOD[1:]) == [("start", None), ("window", None)]
    assert violations(spark, [*GOOD[:3], *GOOD[4:]]) == [("final-set", 10), ("hole", None)]
    assert violations(spark, [*GOOD, GOOD[4]]) == [("duplicate", None)]
    assert violations(spark, inputs=[INPUTS[0], ("q", 2, 12, "o/a", "waiting")]) == [("approval", 2), ("final-set", 11), ("final-set", 12)]
    assert violations(spark, inputs=INPUTS[:1]) == [("approval", 2), ("final-set", 11)]
    assert violations(spark, inputs=[*INPUTS, ("q", 3, 12, "o/a", "landed")]) == [("approval", 3)]
    assert violations(spark, batches=[("q", 7, "open", "o/b")]) == [("repository", None)]
    assert violations(spark, until=4) == [("window", None)]
    assert violations(spark, until=31) == [("window", None)]
    assert violations(spark, [row("q", 1, 5, "setting", key="publication_enabled", value="false"), *GOOD[1:]]) == [("window", None)]
    assert violations(spark, members=[("q", 7, 99, False, False), ("q", 7, 98, True, False), ("q", 7, 97, False, True), ("q", 8, 96, False, False)]) == [("final-set", 99)]
    assert violations(spark, [*GOOD, row("q", 6, 9, "probe-conflict", 11, against=True)]) == [("final-set", 11)]


def test_costs_count_an_item_once_and_keep_what_is_unattributed(spark):
    builds = [(1, "queue", True, "success", [5, 6]), (2, "queue", True, "success", [6, None]), (3, "queue", False, "failure", [9]), (4, "bors", False, "cancelled", None), (5, "bors", None, None, [])]
    post = [(6, "queue"), (7, None), (8, None)]
    jobs = [(1, 60), (1, 30), (2, None), (3, 10), (6, 5), (7, 7), (9, 100)]
    frames = (spark.createDataFrame(builds, "run int, engine string, landed boolean, conclusion string, members array<int>"), spark.createDataFrame(post, "run int, engine string"), spark.createDataFrame(jobs, "run int, run_s long"))
    got = {r["engine"]: (r["runs"], r["items"], r["validation_s"], r["post_s"], r["total_s"], r["per_item"], r["failed"], r["cancelled"]) for r in R.engine_costs(*frames, ["run"]).collect()}
    assert got == {"queue": (3, 2, 100, 5, 105, 52.5, 1, 0), "bors": (2, 0, 0, 0, 0, None, 0, 1), None: (0, 0, 0, 7, 7, None, 0, 0)}


def test_cohorts_count_only_what_was_accounted_for(spark):
    full = {"command_accounting_scope": "reaped-descendants", "command_cpu_user_s": 2, "command_cpu_system_s": 0.5, "command_max_process_rss_bytes": 100, "sampler_cpu_s": 0.25, "host_cpu_busy_fraction": 0.5, "samples": 3.0, "missing": []}
    seen = [
        (1, "present", json.dumps(full)), (2, "present", json.dumps(full | {"command_accounting_scope": "shell", "missing": ["load"], "host_cpu_busy_fraction": 0.9, "command_max_process_rss_bytes": 500})),
        (3, "expired", json.dumps(full | {"command_cpu_user_s": -1, "samples": True, "host_cpu_busy_fraction": "x", "missing": True})), (4, "present", "broken"), (5, None, None),
    ]
    attempts = spark.createDataFrame([(k, None if k < 5 else "late") for k in range(1, 7)], "run int, cohort string")
    jobs = spark.createDataFrame([(1, "8x16", "vm"), (1, "", "vm"), (2, None, "vm"), (2, "8x16", None), (3, "8x16", None), (3, "vm", None), (4, "8x16", "x"), (4, "vm", "x"), (5, None, None)], "run int, runner_size string, runner_kind string")
    got = {(r["cohort"], r["sizes"]): r.asDict() for r in R.resource_cohorts(attempts, jobs, spark.createDataFrame(seen, "run int, coverage string, payload string"), ["run"], ["cohort"]).collect()}
    assert set(got) == {(None, "8x16,vm"), ("late", "unknown")}
    one = got[None, "8x16,vm"]
    assert [one[c] for c in ("attempts", "covered", "partial", "incomplete", "samples", "cpu_s", "rss_bytes", "sampler_s", "busy")] == [4, 3, 1, 2, 6, 2.5, 100.0, 0.75, 0.9]
    assert [got["late", "unknown"][c] for c in ("attempts", "covered", "samples", "cpu_s", "rss_bytes", "busy")] == [2, 0, 0, None, None, None]


@pytest.mark.parametrize(("live", "ended"), [(0, 0), (0, 5), (0, 30), (2, 30), (13, 4), (12, 1)])
def test_public_steps(spark, live, ended):
    steps = [(f"s{k}\x01", 1, 2 if k >= live else None, "" if k % 2 else "failure") for k in range(live + ended)]
    random.Random(1).shuffle(steps)
    df = spark.createDataFrame([(steps,)], "s array<struct<name:string,started:int,completed:int,conclusion:string>>")
    got = [tuple(x) for x in df.select(C.public_steps(F.col("s")).alias("p")).first()["p"]]
    rest = [s for s in steps if s[2] is not None]
    want = ([s for s in steps if s[2] is None] + rest[max(0, len(rest) - 11) :])[:12]
    assert got == [(n.replace("\x01", " "), a, b, c or None) for n, a, b, c in want]


def test_versions_arrive_by_themselves(spark):
    rows = [(10, [(1, "a")]), (20, [(1, "a"), (2, "a")]), (30, [(1, "b")]), (40, [(1, "a")])]
    df = spark.createDataFrame(rows, "tm int, items array<struct<item:int,version:string>>")
    got = {(r["item"]["item"], r["item"]["version"]): (r["lo"], r["hi"]) for r in S.censored_arrivals(df, "tm", "items").collect()}
    assert got == {(1, "a"): (None, 10), (2, "a"): (10, 20), (1, "b"): (20, 30)}
