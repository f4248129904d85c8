"""Frames as a change log against a plain replay that changes one state frame by frame."""

import random

import pytest
from pyspark.sql import functions as F

from chronotally.operators import changelog as L

FRAMES = "source string, arrival long, epoch long, sequence long, snapshot string, base_epoch long, base_sequence long, whole boolean, digest string, complete array<string>"
CHANGES = "source string, snapshot string, collection string, id string, data string"


def replay(frames, changes):
    """status of every arrival; state after, and keys touched by, every commit."""
    status, states, marks, live, last, seen, n = {}, {}, {}, {}, {}, {}, {}
    for f in sorted(frames, key=lambda x: x[1]):
        s, arrival, epoch, seq, snap, be, bs, whole, digest, complete = f
        old, newest = last.get(s), seen.get(s)
        if old and old[0] == (epoch, seq) and old[1] == snap:
            status[arrival] = "repeated" if old[2] == digest else "changed"
        elif be is not None and (not old or old[0] != (be, bs)):
            status[arrival] = "resync"
        elif newest and (epoch, seq) < newest[0]:
            status[arrival] = "superseded"
        elif newest and (epoch, seq) == newest[0] and snap != newest[1]:
            status[arrival] = "conflict"
        elif old and old[0][0] == epoch and seq <= old[0][1]:
            status[arrival] = "committed before"
        else:
            seen[s] = (epoch, seq), snap
            status[arrival] = "committed" if whole else "incomplete"
        if status[arrival] != "committed":
            continue
        last[s], n[s] = ((epoch, seq), snap, digest), n.get(s, 0) + 1
        before, state = dict(live.get(s, {})), live.setdefault(s, {})
        mine = {}
        for s2, snap2, c, i, data in changes:
            if (s2, snap2) == (s, snap):
                mine[c, i] = max((x for x in (mine.get((c, i)), data) if x is not None), default=None)
        if complete is not None:
            for k in [k for k in state if k[0] in complete and k not in mine]:
                del state[k]
        for k, data in mine.items():
            if data is None:
                state.pop(k, None)
            else:
                state[k] = data
        states[s, n[s]] = dict(state)
        marks[s, n[s]] = {x[0] for k in before.keys() | state.keys() if before.get(k) != state.get(k) for x in (before.get(k), state.get(k)) if x}
    return status, states, marks


@pytest.mark.parametrize("seed", [1, 2])
def test_state_after_every_commit_equals_a_replay(spark, seed):
    r = random.Random(seed)
    frames, changes, place = [], [], {"a": (1, 0), "b": (1, 0)}
    for arrival in range(150):
        s = r.choice("ab")
        old = place[s]
        new = r.choice([(old[0], old[1] + 1)] * 8 + [(old[0] + 1, 0), old, (old[0], max(0, old[1] - 1))])
        base = r.choice([old] * 6 + [None, (old[0], old[1] + 5)])
        snap, complete = (f"{s}{arrival}" if r.random() < 0.9 or not frames else frames[-1][4]), (r.choice([["x", "y"], ["x"], []]) if base is None else None)
        f = (s, arrival, *new, snap, *(base or (None, None)), r.random() < 0.9, r.choice(["d", "d", "e"]), complete)
        if snap in {x[4] for x in frames}:
            f = (*frames[-1][:1], arrival, *frames[-1][2:8], f[8], frames[-1][9])
        frames.append(f)
        place[f[0]] = max(place[f[0]], new) if f[4] == snap and f[7] else place[f[0]]
        if sum(x[4] == f[4] for x in frames) == 1:
            changes += [(f[0], f[4], r.choice("xyz"), str(r.randrange(6)), r.choice([None, "A1", "A2", "B1", "C1"])) for _ in range(r.randrange(6))]
    status, states, marks = replay(frames, changes)
    found = L.commit_frames(spark.createDataFrame(frames, FRAMES).repartition(3), ["arrival"])
    rows = found.collect()
    assert {x["arrival"]: x["status"] for x in rows} == status and len(set(status.values())) >= 5
    versions = L.entity_versions(spark.createDataFrame(changes, CHANGES), found.where("status = 'committed'")).cache()
    for (s, n), want in states.items():
        got = [x for x in versions.collect() if x["source"] == s and x["since"] <= n and (x["until"] is None or x["until"] > n)]
        assert {(x["collection"], x["id"]): x["data"] for x in got} == want and len(got) == len(want)
    last = {s: max(n for t, n in states if t == s) for s in "ab"}
    got = {(x["source"], x["collection"], x["id"]): x["data"] for x in L.state_at(versions).collect()}
    assert got == {(s, *k): v for s in "ab" for k, v in states[s, last[s]].items()}
    half = {s: (n + 1) // 2 for s, n in last.items()}
    at = L.state_at(versions, F.when(F.col("source") == "a", half["a"]).otherwise(half["b"])).collect()
    assert {(x["source"], x["collection"], x["id"]): x["data"] for x in at} == {(s, *k): v for s, n in half.items() for k, v in states[s, n].items()}
    got = {}
    for x in L.touched(versions, F.substring("data", 1, 1), "batch").collect():
        got.setdefault((x["source"], x["commit"]), set()).add(x["key"])
    assert got == {k: v for k, v in marks.items() if v}


def test_a_rejected_delta_changes_nothing(spark):
    frames = [("s", 1, 1, 1, "f1", None, None, True, "d", ["x"]), ("s", 2, 1, 3, "f3", 1, 2, True, "d", None), ("s", 3, 1, 2, "f2", 1, 1, True, "d", None), ("s", 4, 1, 2, "f2", 1, 1, True, "d", None), ("s", 5, 1, 2, "f2", 1, 1, True, "other", None), ("s", 6, 1, 1, "old", None, None, True, "d", ["x"])]
    found = L.commit_frames(spark.createDataFrame(frames, FRAMES), ["arrival"])
    assert [x["status"] for x in found.orderBy("arrival").collect()] == ["committed", "resync", "committed", "repeated", "changed", "superseded"]
    changes = [("s", "f1", "x", "1", "a"), ("s", "f1", "x", "2", "b"), ("s", "f3", "x", "1", None), ("s", "f2", "x", "2", None), ("s", "f2", "x", "3", "c")]
    state = L.state_at(L.entity_versions(spark.createDataFrame(changes, CHANGES), found.where("status = 'committed'")))
    assert {(x["id"], x["data"]) for x in state.collect()} == {("1", "a"), ("3", "c")}
    empty = found.limit(0)
    assert L.entity_versions(spark.createDataFrame(changes, CHANGES), empty.where("status = 'committed'")).count() == 0


def test_orphans_and_old_versions_are_pruned(spark):
    children = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (1, None), (None, 1)], "batch long, version long")
    parents = spark.createDataFrame([(1, 2), (3, 1)], "batch long, version long")
    got = {(x["batch"], x["version"]): x["pruned"] for x in L.prune_orphans(children, parents, ["batch"], "version").collect()}
    assert got == {(1, 1): "version", (1, 2): None, (2, 1): "orphan", (1, None): None, (None, 1): "orphan"}


def test_the_next_full_frame_is_a_running_minimum(spark):
    """A frame from each row to the end is summed anew for every row: quadratic in a source's commits."""
    commits = spark.createDataFrame([("s", str(n), n, ["A"] if n % 3 == 0 else None) for n in range(1, 10)], "source string, snapshot string, commit long, complete array<string>")
    changes = spark.createDataFrame([("s", "1", "A", "x", "1"), ("s", "1", "B", "x", "1"), ("s", "4", "A", "y", "1")], CHANGES)
    found = L.entity_versions(changes, commits)
    assert "unboundedfollowing" not in found._jdf.queryExecution().analyzed().toString().lower()
    assert sorted(tuple(r) for r in found.select("collection", "id", "since", "until").collect()) == [("A", "x", 1, 3), ("A", "y", 4, 6), ("B", "x", 1, None)]
