"""Day summaries of metric rows against a plain version, series with known values, and machines that become known."""

import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from chronotally.operators import live as L
from chronotally.operators import summaries as S
from tests.test_live import FIELDS, T, job, summed, table

ROWS = "day date, bucket long, metric string, value double, amount double"
D1, D2 = datetime.date(2026, 10, 18), datetime.date(2026, 10, 19)


def plain(rows):
    """Measures and fleet of metric rows, by going through them one after the other."""
    sums = collections.defaultdict(float)
    for day, bucket, metric, value, amount in rows:
        sums[day, bucket, metric, value] += amount
    counters, spread, fleet = collections.defaultdict(float), collections.defaultdict(list), {}
    events = collections.defaultdict(list)
    for (day, bucket, metric, value), amount in sums.items():
        if abs(amount) < 1e-9:
            continue
        if metric.startswith("fleet/"):
            _, step, kind, key = (metric + "/").split("/")[:4]
            at = (int(step), bucket, kind, key)
            if kind == "running":
                fleet[at] = fleet.get(at, 0) + amount
            elif kind == "wait" and amount > 0:
                fleet[at] = max(fleet.get(at, 0), value)
            elif kind == "queued":
                events[at].append((value, amount))
            elif kind == "picked" and amount > 0:
                fleet[(*at, value)] = value
        elif metric.startswith(("duration/", "wait/")):
            spread[day, metric].append((value, amount))
        else:
            counters[day, metric] += amount
    for at, changes in events.items():
        level = peak = 0
        for _, change in sorted(changes):
            level += change
            peak = max(peak, level)
        fleet[at] = peak

    def quantile(values, q):
        some = sorted(v for v in values if v[1] > 0)
        target, run = max(1, -(-sum(a for _, a in some) * q // 1)), 0
        for value, amount in some:
            run += amount
            if run >= target:
                return value

    quantiles = {k: (quantile(v, 0.5), quantile(v, 0.9)) for k, v in spread.items() if any(a > 0 for _, a in v)}
    return {k: v for k, v in counters.items() if abs(v) >= 1e-9}, quantiles, fleet


def test_measures_and_fleet_match_a_plain_version(spark):
    """Rows that are added, repeated, taken back whole or in part; one hot step with many waits."""
    rng, rows = random.Random(7), []
    metrics = ["pr-total", "picker/github", "failure/pending", "duration/github", "duration/merge", "wait/merge", "minutes/github", "fleet/600/running/ns-pr", "fleet/600/wait/build", "fleet/600/picked"]
    for i in range(1500):
        metric = rng.choice(metrics)
        counted = metric.split("/")[0] not in ("duration", "wait") and "wait" not in metric and "picked" not in metric
        row = (rng.choice([D1, D2]), rng.choice([T, T + 600]) if metric.startswith("fleet") else 0, metric, 0.0 if counted else float(rng.randrange(40)), float(rng.choice([1, 1, 2])))
        rows += [row] * rng.choice([1, 1, 2])
        if rng.random() < 0.4:
            rows.append((*row[:4], -row[4]))
    for i in range(1200):
        a, b = sorted(rng.sample(range(600), 2))
        rows += [(D1, T, "fleet/600/queued/github", float(T + a), 1.0), (D1, T, "fleet/600/queued/github", float(T + b), -1.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    counters, quantiles, fleet = plain(rows)
    got = S.day_measures(df).collect()
    assert {(r["day"], r["metric"]): r["amount"] for r in got if r["amount"] is not None} == counters
    assert {(r["day"], r["metric"]): (r["median"], r["p90"]) for r in got if r["amount"] is None} == quantiles
    mine = {(r["step"], r["at"], r["type"], r["key"], *([r["value"]] if r["type"] == "picked" else [])): r["value"] for r in S.fleet_rows(df).collect()}
    assert mine == {k: v for k, v in fleet.items() if abs(v) >= 1e-9 or k[2] != "running"}


def test_nothing_gives_nothing(spark):
    none = spark.createDataFrame([], ROWS)
    measures = S.day_measures(none)
    assert measures.count() == S.fleet_rows(none).count() == S.mean_phases(measures).count() == S.failure_rates(measures).count() == 0
    gone = spark.createDataFrame([(D1, 0, "duration/github", 3.0, 1.0), (D1, 0, "duration/github", 3.0, -1.0), (D1, 0, "pr-total", 0.0, 1.0), (D1, 0, "pr-total", 0.0, -1.0)], ROWS)
    assert S.day_measures(gone).count() == 0


@pytest.fixture(scope="module")
def measures(spark):
    counts = [(D1, "pr-total", 4), (D1, "failure/pending", 1), (D1, "failure/infra", 1), (D1, "picker/github", 1), (D1, "picker/namespace", 3), (D1, "picker/elsewhere", 9), (D1, "merge/success", 2), (D1, "merge/other", 1),
              (D1, "phase-count", 4), (D1, "phase-sample-count", 2), (D1, "phase/build", 40), (D1, "sample-phase/build", 10), (D1, "phase/setup", 8), (D2, "phase-count", 2), (D2, "phase/build", 6), (D2, "landed-prs", 7)]
    return spark.createDataFrame([(d, m, float(a), None, None) for d, m, a in counts], "day date, metric string, amount double, median double, p90 double")


def test_series(spark, measures):
    assert {(r["cause"], r["builds"]) for r in S.failure_causes(measures).collect()} == {("unclassified", 1.0), ("infra", 1.0)}
    assert {r["day"]: r["rate"] for r in S.failure_rates(measures).collect()} == {D1: 0.5, D2: None}
    assert {r["day"]: r["share"] for r in S.picker_shares(measures, "github", ["github", "namespace", "self-hosted"]).collect()} == {D1: 0.25, D2: None}
    assert {(r["day"], r["phase"]): r["minutes"] for r in S.mean_phases(measures).collect()} == {(D1, "build"): 5.0, (D1, "setup"): 0.0, (D2, "build"): 3.0}


def test_outcomes_and_long_term_rows(spark, measures):
    landings = spark.createDataFrame([(D1, 5), (D1, 5), (D1, 6), (D2, 1), (datetime.date(2026, 10, 20), 1)], "day date, pr long")
    got = {r["day"]: tuple(r)[1:] for r in S.merge_outcomes(measures, landings).collect()}
    assert got == {D1: (2.0, 0.0, 0.0, 1.0, 2.0), D2: (0.0, 0.0, 0.0, 0.0, 7.0), datetime.date(2026, 10, 20): (0.0, 0.0, 0.0, 0.0, 1.0)}
    old = S.compacted(measures, landings.where(F.col("day") != F.lit(D2)), F.lit(datetime.date(2026, 10, 20)))
    assert {(r["day"], r["amount"]) for r in old.where("metric = 'landed-prs'").collect()} == {(D1, 2.0), (D2, 7.0)} and old.count() == measures.count() + 1
    again = S.compacted(old, landings.limit(0), F.lit(datetime.date(2026, 10, 20)))
    assert sorted(map(str, again.collect())) == sorted(map(str, old.collect()))


def test_failures_by_job_stand_before_their_runs(spark):
    jobs = [job(i, conclusion="failure", failure=f, run_failure="infra") for i, f in ((1, None), (2, None), (3, "lean"), (4, ""))]
    by_job = F.when(F.col("id") != 2, F.array(F.struct(F.lit("9").alias("job"), F.lit("no").alias("failure")), F.struct(F.col("id").cast("string").alias("job"), F.lit("oom").alias("failure"))))
    got = summed(L.job_contributions(table(spark, jobs).withColumn("job_failures", by_job), T + 600).collect())
    assert {k[0]: v for k, v in got.items() if k[0].startswith("failure/")} == {"failure/oom": 2, "failure/infra": 1, "failure/lean": 1}


def test_known_machines_change_their_jobs_alone(spark):
    hosts, names = L.Hosts({"aaaaaaaaaaaa-1": "north"}, {"s": "south"}), L.Names(runners=("github", "self-hosted", "north", "south"))
    facts = {1: (["fleet-aaaaaaaaaaaa-1"], None), 2: (["fleet-host-s"], "fleet-aaaaaaaaaaaa-0123456789abcdef"), 3: (None, "fleet-aaaaaaaaaaaa-0123456789abcdef"), 4: (["fleet-host-s"], None), 5: (["other"], None)}
    jobs = [job(i, kind="github" if i == 4 else "self-hosted") for i in facts]
    more = spark.createDataFrame([(i, *f) for i, f in facts.items()], "id long, labels array<string>, runner_name string")
    work = table(spark, jobs).join(more, "id")
    before, delta = L.job_contributions(work, T + 600, names=names), S.recompute_hosts(work, hosts, T + 600, names=names)
    assert {r["id"]: r["now"] for r in S.reassigned(work, hosts).collect()} == {1: "north", 2: "self-hosted", 3: "north", 4: "github", 5: "self-hosted"}
    after = L.job_contributions(S.reassigned(work, hosts).withColumn("kind", F.col("now")), T + 600, names=names)
    exact = lambda df: {k: round(v, 9) for k, v in summed(df.collect()).items() if abs(v) > 1e-9}
    assert exact(before.unionByName(delta)) == exact(after)
    assert exact(delta)["picker/north", 0, 0.0] == 2 and not any("github" in k[0] for k in exact(delta))
    assert "labels" not in FIELDS


def test_measures_read_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)
    data = [("2024-01-01", m, float(v), 1.0) for m in ("pr-total", "wait/other", "duration/github") for v in range(40)]

    def noted(row):
        seen.add(1)
        return row

    rows = spark.createDataFrame(spark.sparkContext.parallelize(data, 4).map(noted), "day string, metric string, value double, amount double")
    got = {r["metric"]: (r["amount"], r["median"], r["p90"]) for r in S.day_measures(rows).collect()}
    assert got == {"pr-total": (40.0, None, None), "wait/other": (None, 19.0, 35.0), "duration/github": (None, 19.0, 35.0)}
    assert seen.value == len(data)
