"""Activity partials: any split of the jobs merges to one pass, and reads as a plain count at any clock."""

import random

import pytest

from chronotally.operators import partials as A

JOBS = "id long, pool string, build boolean, active boolean, running boolean, created long, started long, completed long, result string, part long, half long"
CLOCK = 200 * A.DAY + 1234 * A.MINUTE + 17


def random_jobs(seed, n=500):
    r = random.Random(seed)
    when = lambda days: CLOCK - r.randrange(int(days * A.DAY))
    rows = []
    for i in range(n):
        done = r.random() < 0.5
        running = not done and r.random() < 0.4
        created = None if r.random() < 0.05 else when(3)
        rows.append((i, r.choice(["a", "a", "a", "b", None]), r.choice([True, False, None]), not done, running, created, when(2) if running else None, when(1.5) + r.randrange(A.HOUR) if done else None, r.choice(["success", "failure", "timed_out", "cancelled", "skipped", "odd", None]) if done else None, r.randrange(7), r.randrange(2)))
    return rows


def plain(rows, clock, read):
    """The report of one pass over the jobs, computed at ``clock`` and read at ``read``."""
    out = {}
    for scope in ("all", "builds"):
        for pool in {r[1] for r in rows}:
            mine = [r for r in rows if r[1] == pool and (scope == "all" or r[2])]
            if not mine:
                continue
            stale = lambda at: at is not None and at // A.HOUR * A.HOUR + A.HOUR <= read - A.DAY
            waits = sorted([r for r in mine if r[3] and not r[4]], key=lambda r: (r[5] is not None, r[5] or 0, r[0]))
            named, running = waits[:20], [r for r in mine if r[3] and r[4]]
            live, old = [r for r in named if not stale(r[5])], [r for r in named if stale(r[5])]
            done = [r for r in mine if r[7] is not None and r[7] <= clock]
            through, windows = read // A.MINUTE * A.MINUTE, []
            for w in A.WINDOWS:
                inside = [r for r in done if r[7] >= clock // A.MINUTE * A.MINUTE - A.DAY and through - w <= r[7] // A.MINUTE * A.MINUTE < through]
                kind = lambda r: "failure" if r[8] == "timed_out" else r[8] if r[8] in A.RESULTS else "other"
                windows.append((w // 1_000_000, len(inside), *[sum(kind(r) == k for r in inside) for k in A.RESULTS]))
            n_live = sum(not stale(r[5]) for r in waits)
            first = lambda x: x[0][0] if x else None
            oldest = min(running, key=lambda r: (r[6], r[5] is not None, r[5] or 0, r[0]), default=[None])[0]
            latest = min(done, key=lambda r: (-r[7], r[0]), default=[None])[0]
            out[pool, scope] = (len(running), n_live, len(waits) - n_live, oldest, first(live), not live and n_live > 0, first(old), latest, tuple(windows))
    return out


def found(df):
    return {(r["pool"], r["scope"]): (*[r[c] for c in ("running", "waiting", "stale_waiting", "oldest_running", "oldest_waiting", "oldest_unknown", "oldest_stale_waiting", "latest_completion")], tuple(tuple(w) for w in r["windows"])) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_merges_to_one_pass_at_any_clock(spark, seed):
    rows = random_jobs(seed)
    df = spark.createDataFrame(rows, JOBS)
    one = A.partials(df, [], CLOCK).cache()
    split = A.partials(df, ["part", "half"], CLOCK)
    twice = A.merged(A.merged(split, ["part"])).cache()
    for later in (0, 5 * A.HOUR, 2 * A.DAY):
        want = plain(rows, CLOCK, CLOCK + later)
        assert found(A.report(one, CLOCK + later)) == want
        assert found(A.report(twice, CLOCK + later)) == want
    as_text = lambda p: sorted(str(r.asDict(recursive=True)) for r in p.select(*sorted(p.columns)).collect())
    assert as_text(one) == as_text(twice)


def test_the_oldest_live_job_is_unknown_behind_named_stale_ones(spark):
    old = [(i, "a", False, True, False, CLOCK - 3 * A.DAY + i, None, None, None, i % 3, 0) for i in range(25)]
    live = [(100, "a", False, True, False, CLOCK - A.HOUR, None, None, None, 1, 0)]
    got = A.report(A.merged(A.partials(spark.createDataFrame(old + live, JOBS), ["part"], CLOCK)), CLOCK).first()
    assert (got["waiting"], got["stale_waiting"], got["oldest_waiting"], got["oldest_unknown"], got["oldest_stale_waiting"]) == (1, 25, None, True, 0)


def test_incomplete_partials_make_the_merge_partial(spark):
    df = spark.createDataFrame(random_jobs(3, 60), JOBS)
    parts = A.partials(df, ["part"], CLOCK).withColumn("complete", A.F.col("part") != 2)
    cover = {(r["pool"], r["scope"]): r["coverage"] for r in A.report(A.merged(parts), CLOCK).collect()}
    here = {(r["pool"], s) for r in df.where("part = 2").collect() for s in (("all", "builds") if r["build"] else ("all",))}
    assert all((v == "partial") == (k in here) for k, v in cover.items())
    assert A.report(A.merged(parts.limit(0)), CLOCK).count() == 0
