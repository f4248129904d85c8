"""Sequential acceptance and retraction against plain loops, in batch and as a stream."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from chronotally.operators import folds
from chronotally.operators import live as L
from chronotally.plans import live_queries
from chronotally.streaming import streams

RECORD = ["status", "updated", "kind", "runner", "steps", "host"]
SCHEMA = "key string, arrival long, status string, updated double, kind string, runner string, steps array<struct<name:string>>, host string"
MERGE = folds.Merge(fill={"kind": "unknown", "runner": None, "steps": None}, learn=("host", "kind", ("unknown", "self-hosted"), ("runner",)))


def plain_deliveries(rows, window):
    last, out = {}, {}
    for key, at, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        out[i] = key not in last or at - last[key] > window
        if out[i]:
            last[key] = at
    return out


def plain_sequence(rows, interval, lifetime):
    last, out = {}, {}
    for key, at, session, q, i in sorted(rows, key=lambda r: (r[0], r[1], r[4])):
        old = last.get(key)
        if old and at - old[0] > lifetime:
            old = None
        out[i] = None if not old else "interval" if at - old[0] < interval else "superseded" if session != old[1] or q <= old[2] else None
        if out[i] is None:
            last[key] = (at, session, q)
    return out


def plain_bindings(rows, lifetime, clock):
    bound = {}
    for key, at, machine, instance, slot, i in sorted(rows, key=lambda r: (r[0], r[1], r[5])):
        if machine is None or instance is None:
            continue
        old = bound.get(key)
        if old and at - old["seen"] > lifetime:
            old = None
        if old and (old["machine"], old["instance"]) != (machine, instance):
            continue
        bound[key] = {"machine": machine, "instance": instance, "slot": slot, "since": old["since"] if old else at, "seen": at}
    return {(k, b["machine"], b["instance"], b["slot"], b["since"], b["seen"]) for k, b in bound.items() if b["seen"] >= clock - lifetime}


def plain_merge(old, new):
    """The record after an observation, written out case by case."""
    rank = lambda r: {"completed": 3, "in_progress": 2}.get(r["status"], 1)
    if old is None:
        return new
    waits = old["status"] == "in_progress" and new["status"] in ("pending", "waiting")
    state = dict(old)
    if new["updated"] >= old["updated"] and (waits or rank(new) >= rank(old)):
        state = dict(new)
        state["steps"] = new["steps"] if new["steps"] or old["steps"] is None else old["steps"]
        state["runner"] = new["runner"] or old["runner"]
        state["kind"] = old["kind"] if new["kind"] == "unknown" else new["kind"]
    if state["kind"] in ("unknown", "self-hosted") and new["host"]:
        state |= {"kind": new["host"], "host": new["host"]} | ({"runner": new["runner"]} if new["runner"] else {})
    return state


def random_records(seed, keys=30, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(keys)}"
        rows.append((key, i, rnd.choice(["queued", "pending", "waiting", "in_progress", "in_progress", "completed"]), float(rnd.randrange(60)), rnd.choice(["unknown", "self-hosted", "github"]), rnd.choice([None, "m1", "m2"]), rnd.choice([None, [], [("build",)]]), rnd.choice([None, None, "north"])))
    return rows


def folded(rows):
    """(key, arrival) -> (before, after) and the last record of every key."""
    names, state, pairs = SCHEMA.split(", "), {}, {}
    for row in sorted(rows, key=lambda r: r[1]):
        new = dict(zip(RECORD, row[2:], strict=True))
        new["steps"] = [list(s) for s in new["steps"]] if new["steps"] is not None else None
        pairs[row[0], row[1]] = state.get(row[0]), plain_merge(state.get(row[0]), new)
        state[row[0]] = pairs[row[0], row[1]][1]
    assert len(names) == len(RECORD) + 2
    return pairs, state


def plain_struct(r):
    return None if r is None else {c: ([list(s) for s in r[c]] if c == "steps" and r[c] is not None else r[c]) for c in RECORD}


def test_deliveries_are_taken_again_after_the_window(spark):
    day = 86_400
    df = spark.createDataFrame([("x", 0), ("x", 10 * day), ("x", 14 * day), ("x", 15 * day), ("x", 20 * day), ("y", 3), ("y", 3)], "id string, at long")
    got = [(r["id"], r["at"] // day, r["accepted"]) for r in folds.dedupe_deliveries(df, ["id"], "at", ["at"], window=14 * day).collect()]
    assert sorted(got) == [("x", 0, True), ("x", 10, False), ("x", 14, False), ("x", 15, True), ("x", 20, False), ("y", 0, False), ("y", 0, True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_sequential_acceptance_equals_plain_loops(spark, seed):
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(20)}"
    rows = [(key(), rnd.randrange(200), rnd.randrange(3), rnd.randrange(40), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, at long, session long, q long, i long").repartition(7)
    got = {r["i"]: r["accepted"] for r in folds.dedupe_deliveries(df, ["k"], "at", ["at", "i"], window=25).collect()}
    assert got == plain_deliveries([(r[0], r[1], r[4]) for r in rows], 25)
    got = {r["i"]: (r["accepted"], r["refusal"]) for r in folds.sequence_guard(df, ["k"], "at", "session", "q", ["i"], interval=10, lifetime=60).collect()}
    want = plain_sequence(rows, 10, 60)
    assert got == {i: (v is None, v) for i, v in want.items()} and set(want.values()) == {None, "interval", "superseded"}
    seen = [(r[0], r[1], rnd.choice(["m1", "m2", None]), rnd.choice(["a", "b"]), r[3], r[4]) for r in rows[:200]]
    df = spark.createDataFrame(seen, "k string, at long, machine string, instance string, slot long, i long").repartition(5)
    got = {tuple(r) for r in folds.sticky_mapping(df, "k", "at", ["machine", "instance"], ["slot"], ["i"], clock=200, lifetime=15).collect()}
    assert got == plain_bindings(seen, 15, 200) and got


def test_an_expired_binding_gives_way(spark):
    day = 86_400
    rows = [("r", 0, "m1", 1), ("r", 5 * day, "m2", 2), ("r", 29 * day, "m2", 3), ("r", 31 * day, "m2", 4), ("q", 0, "m1", 5), ("q", 20 * day, "m1", 6), ("q", 45 * day, "m2", 7)]
    df = spark.createDataFrame(rows, "runner string, at long, machine string, i long")
    found = folds.sticky_mapping(df, "runner", "at", ["machine"], [], ["i"], clock=46 * day, lifetime=30 * day)
    assert {(r["runner"], r["machine"], r["since"] // day, r["seen"] // day) for r in found.collect()} == {("r", "m2", 31, 31), ("q", "m1", 0, 20)}


def test_folds_of_odd_tables(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), ("a", 1, "z")], "k string, at long, accepted string")
    got = folds.dedupe_deliveries(df, ["k"], "at", ["at"], window=5)
    assert got.columns == ["k", "at", "accepted"] and sorted((str(r["k"]), r["at"], r["accepted"]) for r in got.collect()) == [("None", 1, True), ("None", 2, False), ("a", 1, True)]
    assert folds.dedupe_deliveries(df.limit(0), ["k"], "at", ["at"], window=5).count() == 0
    with pytest.raises(ValueError):
        folds.with_fold(df, ["nope"], [], [], folds.delivery_step(1), "accepted boolean")


@pytest.mark.parametrize("seed", [3, 4])
def test_records_merge_as_a_plain_loop(spark, seed):
    rows = random_records(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    pairs, last = folded(rows)
    got = folds.state_changes(df, ["key"], ["arrival"], RECORD, MERGE).collect()
    assert {(r["key"], r["arrival"]): (plain_struct(r["before"]), plain_struct(r["after"])) for r in got} == pairs
    state = {r["key"]: {c: r[c] for c in ("status", "updated", "kind", "runner", "host")} for r in folds.latest_state(df, ["key"], ["arrival"], RECORD, MERGE).collect()}
    assert state == {k: {c: v[c] for c in ("status", "updated", "kind", "runner", "host")} for k, v in last.items()}


def test_signed_records_leave_the_last_ones(spark):
    rows = random_records(5)
    changes = folds.state_changes(spark.createDataFrame(rows, SCHEMA), ["key"], ["arrival"], RECORD, MERGE)
    left = collections.Counter()
    for r in folds.signed_records(changes).collect():
        left[r["key"], json.dumps(plain_struct(r["record"]), sort_keys=True)] += r["sign"]
    assert {k: n for k, n in left.items() if n} == {(k, json.dumps(v, sort_keys=True)): 1 for k, v in folded(rows)[1].items()}


def counted(rows):
    """key, values along and record -> how often it is added less how often it is taken back."""
    left = collections.Counter()
    for r in rows:
        left[r["key"], json.dumps(r["along"]), json.dumps(plain_struct(r["record"]), sort_keys=True)] += r["sign"]
    return {k: n for k, n in left.items() if n}


@pytest.mark.parametrize(("seed", "batch", "moves"), [(6, 10_000, 0), (6, 3, 0), (7, 10_000, 4), (7, 3, 4), (8, 1, 2)])
def test_net_records_are_the_signed_ones_without_pairs_that_cancel(spark, seed, batch, moves):
    """Batches that end within a key, and values along that change while records do or do not."""
    rnd = random.Random(seed)
    df = spark.createDataFrame([(*r, [(rnd.randrange(moves), rnd.choice(["a", None]) if moves > 2 else "a")] if moves else None) for r in random_records(seed)], f"{SCHEMA}, along array<struct<n:long,t:string>>").repartition(5)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, batch)
    try:
        net = folds.net_records(df, ["key"], ["arrival"], RECORD, MERGE, along=["along"])
        assert net.schema["record"].dataType.simpleString() == folds.record_type(df, RECORD)
        got = net.collect()
    finally:
        spark.conf.set(size, before)
    signed = folds.signed_records(folds.state_changes(df, ["key"], ["arrival"], RECORD, MERGE)).select("key", "along", "record", "sign").collect()
    assert counted(got) == counted(signed) and len(got) < len(signed) and any(r["sign"] < 0 for r in signed)
    if not moves:
        assert len(got) == len({r["key"] for r in signed}) and {r["sign"] for r in got} == {1}
    else:
        assert any(r["sign"] < 0 for r in got)


def test_net_records_of_odd_tables(spark):
    shape, key = "k string, n long, status string, updated double, note string, flag boolean, tags array<string>, at timestamp, size decimal(9,2)", ["status", "updated", "note", "flag", "tags", "at", "size"]
    rows = [(None, 1, "queued", 1.0, "x", True, ["t"], None, None), (None, 2, "queued", None, "late", None, None, None, None), (None, 3, "completed", 2.0, "", False, [], None, None), ("a", 1, None, float("nan"), None, None, [None], None, None), ("a", 2, "queued", float("nan"), None, None, None, None, None)]
    merge = folds.Merge(fill={"note": None, "flag": None, "tags": None, "size": None})
    df = spark.createDataFrame(rows, shape)
    got = {r["k"]: r["record"] for r in folds.net_records(df, ["k"], ["n"], key, merge).collect()}
    assert got[None].asDict() == dict(status="completed", updated=2.0, note="x", flag=True, tags=["t"], at=None, size=None)
    assert got["a"]["status"] == "queued" and got["a"]["tags"] == [None]
    assert folds.net_records(df.limit(0), ["k"], ["n"], key, merge).count() == 0
    with pytest.raises(ValueError):
        folds.net_records(df, ["k"], ["n"], ["nope"], merge)


def test_retractions_derive_no_rows_that_cancel(spark):
    """Of a job that was seen five times one record is left to derive rows from, and records do not pass through JSON."""
    seen = live_queries.observations(spark, "/root/testdata/sf0.001").where("id < 200")
    run = [c for c in seen.columns if c not in (*live_queries.JOB, "id", "k", "arrival")]
    assert seen.count() == 1000 and folds.net_records(seen, ["id"], ["arrival"], live_queries.JOB, L.JOB_MERGE, along=run).count() == 200
    plan = live_queries.live_retractions(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "to_json" not in plan


def test_stream_of_changes_equals_recomputing_from_the_last_records(spark, tmp_path):
    """A shuffled stream in several micro-batches: its signed metric rows add up to the metrics of the last records."""
    base, rnd = 1_760_000_000.0, random.Random(9)
    observed = []
    for i in range(12):
        created = base + 100 * i
        done = dict(id=i, status="completed", updated=created + 500, name="sandboxed-build", kind="self-hosted", conclusion=rnd.choice(["success", "failure", "cancelled"]), created=created, started=created + 30, completed=created + 400 + i, assigned=True, estimated=False, weight=1.0, failure=None, steps=[])
        running = done | dict(status="in_progress", updated=created + 100, conclusion=None, completed=None)
        observed += [done | dict(status="queued", updated=created, conclusion=None, completed=None, started=None, assigned=False), running, done, running | dict(updated=created + 90)][: rnd.randint(1, 4)]
    rnd.shuffle(observed)
    columns = ["status", "updated", "name", "kind", "conclusion", "created", "started", "completed", "assigned", "estimated", "weight", "failure", "steps", "host"]
    folder = tmp_path / "observed"
    folder.mkdir()
    for k in range(4):
        (folder / f"{k}.json").write_text("\n".join(json.dumps(o | {"arrival": n, "trigger": "pr", "at": "2025-10-10T00:00:00Z"}) for n, o in enumerate(observed) if n % 4 == k))
    schema = "id long, arrival long, at timestamp, trigger string, status string, updated double, name string, kind string, conclusion string, created double, started double, completed double, assigned boolean, estimated boolean, weight double, failure string, steps array<struct<name:string,started:double,completed:double,conclusion:string>>, host string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    changes = streams.stream_latest_state(stream, ["id"], "arrival", columns, L.JOB_MERGE, "at", "30 days")
    query = changes.writeStream.format("memory").queryName("changed").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    run = {"trigger": "pr", "workflow": L.Names.workflow, "run_status": "in_progress", "run_failure": None}
    typed = lambda df: df.withColumns({k: F.lit(v).cast("string") for k, v in run.items()} | {"run_updated": F.lit(0.0), "sampling": F.lit(None).cast("struct<until:double,weight:double>"), "phases": F.lit(None).cast("array<struct<phase:string,seconds:double>>")})
    until = base + 4000
    got = collections.defaultdict(float)
    found = spark.table("changed").collect()
    assert len(found) == len(observed) and any(not r["accepted"] for r in found)
    for r in L.signed_contributions(typed(spark.table("changed")), until).collect():
        got[r["day"], r["bucket"], r["metric"], r["value"]] += r["amount"]
    last = {}
    for r in sorted(found, key=lambda r: (r["id"],)):
        last.setdefault(r["id"], []).append(r)
    ends = {i: [r["after"] for r in rows if not any(q["before"] == r["after"] and q["before"] != q["after"] for q in rows)] for i, rows in last.items()}
    assert all(len({str(x) for x in e}) == 1 for e in ends.values())
    final = spark.createDataFrame([(i, e[0]) for i, e in ends.items()], f"id long, r {folds.record_type(stream, columns)}").select("id", "r.*")
    want = collections.defaultdict(float)
    for r in L.job_contributions(typed(final.withColumn("trigger", F.lit("pr"))), until).collect():
        want[r["day"], r["bucket"], r["metric"], r["value"]] += r["amount"]
    assert {k: round(v, 6) for k, v in got.items() if abs(v) > 1e-9} == {k: round(v, 6) for k, v in want.items() if abs(v) > 1e-9} and want
