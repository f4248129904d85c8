"""Queries over the whole tables: rows of every key, on a small table."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from chronotally.operators import intervals as I
from chronotally.operators import joins as J
from chronotally.operators import snapshots as N
from chronotally.plans import catalog
from test_queries import rows_of

LO, DAY = 1_704_067_200_000_000, 86_400_000_000


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """30 days of 600 events of 80 runs; some at one time, some without length."""
    rng, folder = random.Random(3), str(tmp_path_factory.mktemp("whole"))
    at = [LO + rng.randrange(30 * 24 * 6) * 600_000_000 + rng.choice([0, 0, 7]) for _ in range(600)]
    rows = [(i, rng.randrange(80), rng.choice(["view", "click", "error", "purchase"]), t, rng.choice([0.0, 1.5, 90.25, 3000.0]), "{}") for i, t in enumerate(at)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, t long, value double, props string")
    df.withColumn("ts", F.timestamp_micros("t")).drop("t").coalesce(1).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    con.execute(f"create view events as select * from read_parquet('{folder}/events.parquet/*.parquet')")
    return folder, con


def same_as_sql(spark, events, name):
    folder, con = events
    df, found = catalog.queries()[name](spark, folder), con.execute(catalog.oracle_sql()[name])
    columns, rows = [c[0] for c in found.description], df.collect()
    assert rows_of(df.columns, [tuple(r) for r in rows]) == rows_of(columns, found.fetchall())
    return rows


def test_settings_windows_of_all_runs(spark, events):
    rows = same_as_sql(spark, events, "settings_windows_all")
    assert len({r["run"] for r in rows if r["run"] >= 40}) > 30
    plain = catalog.queries()["settings_windows"](spark, events[0]).collect()  # no sample of runs any more
    assert sorted(map(tuple, plain)) == sorted(map(tuple, rows))


def test_overlap_join_pairs_within_keys(spark):
    rng = random.Random(5)
    span = lambda: (a := rng.randrange(300), a + rng.randrange(60))
    left, right = [(rng.choice("abc"), i, *span()) for i in range(60)], [(rng.choice("abd"), i, *span()) for i in range(40)]
    a = spark.createDataFrame([*left, (None, 99, 0, 300)], "k string, i long, a long, b long")
    w = spark.createDataFrame([*right, (None, 99, 0, 300)], "k string, j long, lo long, hi long")
    got = sorted((r["k"], r["i"], r["j"], r["overlap"]) for r in J.interval_overlap_join(a, w, "a", "b", "lo", "hi", 25, ["k"]).collect())
    assert got == sorted((k, i, j, min(b, hi) - max(x, lo)) for k, i, x, b in left for m, j, lo, hi in right if k == m and min(b, hi) > max(x, lo))


def test_minute_samples_of_all_runs_and_days(spark, events):
    rows = same_as_sql(spark, events, "minute_samples_all")
    assert len(rows) == 80 * (30 * 144 + 1)
    assert {r["run"] for r in rows if r["value"] is not None and r["tick"] > LO + 3 * DAY} == set(range(80))
    changes = [tuple(r) for r in spark.read.parquet(f"{events[0]}/events.parquet").where("user_id = 50").select(F.unix_micros("ts"), "value").collect()]
    want = {t: max(((a, v) for a, v in changes if a <= t), default=(0, None))[1] for t in range(LO, LO + 30 * DAY + 1, 600_000_000)}
    assert {r["tick"]: r["value"] for r in rows if r["run"] == 50} == want


def test_uncovered_intervals_of_all_runs(spark, events):
    assert same_as_sql(spark, events, "uncovered_intervals_all")


def test_uncovered_intervals_over_slices(spark):
    """Gaps against brute force, with intervals over several slices, nested ones, empty ones, a null key and a key without any."""
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), a, a + rng.choice([0, 1, 3, 3, 40])) for a in (rng.randrange(-20, 420) for _ in range(90))] + [("none", 5, 5), ("ends", 390, 900), ("ends", -9, 10)]
    df = spark.createDataFrame(rows, "k string, a long, b long")
    want = set()
    for k in {k for k, _, _ in rows}:
        free = [t for t in range(400) if not any(m == k and a <= t < b for m, a, b in rows)]
        want |= {(k, t, next(u for u in range(t, 401) if u not in free)) for t in free if t - 1 not in free}
    for width in (1, 30, 1000):
        found = I.uncovered_intervals(df, ["k"], "a", "b", 0, 400, width)
        assert sorted(map(str, found.collect())) == sorted(map(str, found.sparkSession.createDataFrame(list(want), found.schema).collect()))


def test_post_merge_attribution_of_all_runs(spark, tmp_path):
    """Two runs of a head, the second of which every fourth run leaves out."""
    rows = [(4, 1, "F", 1.0, "1-URGENT"), (1001, 2, "O", 1.0, "2-HIGH"), (5, 1, "F", 1.0, "5-LOW"), (7, 1, "F", 1.0, "5-LOW")]
    df = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    df.withColumn("o_orderdate", F.to_timestamp(F.lit("2024-01-01"))).write.parquet(f"{tmp_path}/orders.parquet")
    got = catalog.queries()["post_merge_attribution_all"](spark, str(tmp_path)).collect()
    assert sorted((r["head"], r["engine"], r["n"]) for r in got) == [(4, None, 2), (5, "5-LOW", 1), (7, "5-LOW", 1)]


def test_minute_samples_shuffle_changes_and_pass_over_unknown_values(spark):
    """The last known value stands, also of one step; steps are made behind the last shuffle; a key without a value keeps its steps."""
    rows = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("a", 25, 2.0), ("b", 90, 3.0), ("c", 5, None)], "k string, at long, v double")
    found = N.minute_samples(rows, ["k"], "at", "v", 0, 40, 10)
    assert sorted((r["k"], r["tick"], r["value"]) for r in found.collect()) == sorted((k, t, v) for k, vs in {"a": [None, 1.0, 1.0, 2.0, 2.0], "b": [None] * 5, "c": [None] * 5}.items() for t, v in zip(range(0, 50, 10), vs, strict=True))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode(sequence") < plan.index("Exchange")


def test_workflow_backlog_knows_runs_without_jobs(spark, events):
    """Orders whose jobs are all gone are open workflows too, in states that runs with many jobs never have."""
    folder, con = events
    orders = spark.createDataFrame([(i, i % 7, ["F", "O", "P"][i % 3]) for i in range(300)], "o_orderkey long, o_custkey long, o_orderstatus string")
    orders.withColumns({"o_orderpriority": F.lit("1"), "o_orderdate": F.lit("1995-01-01").cast("timestamp"), "o_totalprice": F.lit(1.0)}).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    con.execute(f"create view orders as select * from read_parquet('{folder}/orders.parquet/*.parquet')")
    found = same_as_sql(spark, events, "workflow_backlog")
    assert {"stuck", "pending", "stale", "unconfirmed"} <= {r["state"] for r in found}
    assert sum(r["n"] for r in found) > 80 * 6 / 7 + 150


def test_finite_counter_keeps_a_negative_zero(spark, tmp_path):
    """Minus nothing is a number of at least 0."""
    at = F.lit("2024-01-01").cast("timestamp")
    rows = spark.range(20).select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("user_id"), F.lit("view").alias("event_type"), at.alias("ts"), (F.col("id") % 3 / 2).alias("value"), F.lit("{}").alias("props"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{tmp_path}/events.parquet/*.parquet')")
    found = same_as_sql(spark, (str(tmp_path), con), "finite_counter")
    assert {r["id"] for r in found if r["id"] % 5 == 1 and r["value"] is not None} == {6}
