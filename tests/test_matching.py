"""Containment joins, jobs of slots and two-level ready times against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from chronotally.operators import joins as J


@pytest.mark.parametrize("gram", [1, 3, 6])
def test_containment_equals_brute_force(spark, gram):
    r = random.Random(gram)
    word = lambda n: "".join(r.choice("ab-") for _ in range(n))
    names = [word(r.randrange(0, 14)) for _ in range(60)] + ["aé\U0001f600b", "%_[x]", "%_[x]", None]
    needles = [word(r.randrange(1, 8)) for _ in range(40)] + ["", "\U0001f600", "_[", "zzz", None, "ab", "ab"]
    left = spark.createDataFrame(list(enumerate(needles)), "i long, needle string")
    right = spark.createDataFrame(list(enumerate(names)), "j long, name string")
    found = J.containment_join(left, right, "needle", "name", gram=gram)
    want = sorted((i, j) for i, x in enumerate(needles) for j, n in enumerate(names) if x is not None and n is not None and x in n)
    assert sorted((x["i"], x["j"]) for x in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert J.containment_join(left.limit(0), right, "needle", "name").count() == 0


def test_jobs_of_slots(spark):
    jobs = [
        ("j1", "bench warm-16 run", "completed", "success", "m", 100, [(40,), (30,)]), ("j2", "bench warm-32", "completed", "failure", "m", 100, [(10,)]), ("j3", "bench cold-16 a", "completed", "success", "m", 100, [(10,)]), ("j4", "bench cold-16 b", "completed", "success", "m", 100, [(10,)]),
        ("j5", "bench late-16", "in_progress", None, None, None, [(10,)]), ("j6", "bench bare-16", "completed", "success", "", 100, [(10,)]), ("j7", "bench idle-16", "completed", "success", "m", 100, [(None,)]), (None, None, "completed", "success", "m", 100, []),
    ]
    slots = [("warm-16", "success"), ("warm-32", "success"), ("cold-16", "success"), ("late-16", "success"), ("bare-16", "success"), ("idle-16", "success"), ("gone-16", "missing")]
    j = spark.createDataFrame(jobs, "job string, name string, job_status string, job_conclusion string, runner_name string, completed long, steps array<struct<started:long>>")
    got = {r["slot"]: (r["status"], r["job"], r["job_coverage"], r["job_elapsed_s"], r["job_unit_minutes"]) for r in J.attach_jobs(spark.createDataFrame(slots, "slot string, status string"), j, "slot", F.lit(6)).collect()}
    assert got == {
        "warm-16": ("success", "j1", "completed", 70, 7.0), "warm-32": ("failed-job", "j2", "completed", 90, 9.0), "cold-16": ("success", None, "missing-or-ambiguous", None, None), "late-16": ("failed-job", "j5", "in_progress", None, None),
        "bare-16": ("success", "j6", "completed", None, None), "idle-16": ("success", "j7", "completed", None, None), "gone-16": ("missing", None, "missing-or-ambiguous", None, None),
    }


def test_golden_latency(spark):
    """Ready at 01:00, on the main line at 01:15."""
    landed = spark.createDataFrame([(42, "d", "bors", 75)], "pr long, version string, engine string, at long")
    ready = spark.createDataFrame([(42, "d", 60), (42, "d", 70)], "pr long, version string, seen long")
    got = J.landing_latencies(landed, ready, item="pr", version="version", engine="engine", at="at", seen="seen", loose="queue").first()
    assert got["at"] - got["ready"] == 15


def test_ready_times_equal_a_plain_loop(spark):
    r = random.Random(8)
    landed = [(r.choice([None, *range(6)]), r.choice([None, "a", "b", "c"]), r.choice(["queue", "bors"]), r.randrange(100), i) for i in range(120)]
    ready = [(r.choice([None, *range(6)]), r.choice([None, "a", "b", "d"]), r.randrange(100)) for _ in range(25)]
    first = {}
    for pr, v, at in ready:
        if pr is not None:
            first[pr, v] = min(at, first.get((pr, v), at))
    want = {}
    for pr, v, engine, at, i in landed:
        exact = first.get((pr, v)) if v is not None else None
        any_ = [t for (p, _), t in first.items() if p == pr and t <= at]
        want[i] = exact if exact is not None else max(any_, default=None) if engine == "queue" else None
    a, b = spark.createDataFrame(landed, "pr long, version string, engine string, at long, i long"), spark.createDataFrame(ready, "pr long, version string, seen long")
    names = dict(item="pr", version="version", engine="engine", at="at", seen="seen", loose="queue")
    assert {x["i"]: x["ready"] for x in J.ready_times(a, b, **names).collect()} == want
    best = {}
    for pr, _v, engine, at, i in sorted(landed, key=lambda x: (x[3], x[2])):
        if want[i] is not None and want[i] <= at and (pr not in best or (at, engine, want[i]) < best[pr]):
            best[pr] = at, engine, want[i]
    assert {x["pr"]: (x["at"], x["engine"], x["ready"]) for x in J.landing_latencies(a, b, **names).collect()} == best
