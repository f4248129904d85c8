"""Stored metrics: incremental folds equal a full sum, rewrite dirty days only, and survive repeats and half-way failures."""

import collections
import datetime
import random

from pyspark.sql import functions as F

from chronotally.operators import live as L
from chronotally.streaming import store
from tests.test_live import T, job, table

ROWS = "day date, bucket long, metric string, value double, amount double"


def sums(df):
    out = collections.defaultdict(float)
    for r in df.collect():
        out[r["day"], r["bucket"], r["metric"], r["value"]] += r["amount"]
    return {k: round(v, 6) for k, v in out.items() if abs(v) > 1e-9}


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.glob("state/day=*/*.parquet")}


def test_folds_rewrite_dirty_days_only(spark, tmp_path):
    r, folder, day = random.Random(4), str(tmp_path / "m"), lambda n: datetime.date(2026, 1, n)
    batches = [[(day(d), r.randrange(3), r.choice(["a", "b"]), float(r.randrange(2)), float(r.choice([1, 2, -1]))) for d in days for _ in range(20)] for days in ([10, 11, 12], [12, 13], [10, 2])]
    batches.append([(k[0], k[1], k[2], k[3], -v) for k, v in sums(spark.createDataFrame(batches[0] + batches[2], ROWS)).items() if k[0] == day(10)])  # takes the whole of a day back
    add = store.foreach_batch_store(lambda b: b, folder, lambda: "2026-01-14", 7)
    seen, written = {}, []
    for n, batch in enumerate(batches):
        for _ in range(2):  # a batch delivered again
            add(spark.createDataFrame(batch, ROWS), n)
        before = files(tmp_path / "m")
        written.append(store.fold(spark, folder))
        after, kept = files(tmp_path / "m"), [x for x in before if not any(f"day={d}" in x for d in written[-1])]
        assert all(after[x] == before[x] for x in kept)
        seen[n] = len(kept)
        total = [x for b in batches[: n + 1] for x in b if x[0] > day(7)]
        assert sums(store.stored(spark, folder)) == sums(spark.createDataFrame(total, ROWS))
        assert store.fold(spark, folder) == []
    assert written == [["2026-01-10", "2026-01-11", "2026-01-12"], ["2026-01-12", "2026-01-13"], ["2026-01-10"], ["2026-01-10"]] and seen[1] > 0
    assert not [k for k in sums(store.stored(spark, folder)) if k[0] == day(10)]
    late = spark.read.parquet(f"{folder}/late")
    assert {(r["batch"], str(r["day"])) for r in late.collect()} == {(2, "2026-01-02")} and late.count() == 20


def test_a_fold_that_failed_half_way_is_repeated(spark, tmp_path):
    folder, day = str(tmp_path / "m"), lambda n: datetime.date(2026, 1, n)
    add = store.foreach_batch_store(lambda b: b, folder, lambda: "2026-01-14", 7)
    add(spark.createDataFrame([(day(10), 0, "a", 0.0, 1.0), (day(11), 0, "a", 0.0, 5.0)], ROWS), 0)
    store.fold(spark, folder)
    add(spark.createDataFrame([(day(10), 0, "a", 0.0, 2.0), (day(11), 0, "a", 0.0, 7.0)], ROWS), 1)
    one = spark.createDataFrame([(0, "a", 0.0, 3.0, 1, day(10))], "bucket long, metric string, value double, amount double, through long, day date")
    one.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{folder}/state")  # as if only one day had been put in place
    assert store.dirty_days(spark, folder) == ["2026-01-11"] and store.fold(spark, folder) == ["2026-01-11"]
    assert {k[0].day: v for k, v in sums(store.stored(spark, folder)).items()} == {10: 3.0, 11: 12.0}


def test_open_jobs_run_on_and_corrections_come_late(spark, tmp_path):
    """Open jobs extended at two triggers, one completed and one corrected in between: the store equals a recomputation."""
    folder, clock = str(tmp_path / "m"), [T + 600, T + 4000, T + 9000]
    open_ = [job(i, conclusion=None, run_status="in_progress", completed=None, created=T + 60.0 * i, started=T + 60.0 * i + 30) for i in (1, 2, 3)]
    fresh = [open_[0], open_[1] | dict(conclusion="success", completed=T + 2000.0), open_[2] | dict(kind="github")]
    rows = lambda jobs, at: L.job_contributions(table(spark, jobs), at).select(*store.KEY, "amount")
    negative = lambda df: df.withColumn("amount", -F.col("amount"))
    add = store.foreach_batch_store(lambda b: b, folder, lambda: str(datetime.date.fromtimestamp(T)), 30)
    add(rows(open_, clock[0]), 0)
    store.fold(spark, folder)
    add(store.extended(table(spark, open_), clock[0], clock[1]), 1)
    add(negative(rows(open_[1:], clock[1])).unionByName(rows(fresh[1:], clock[1])), 2)
    store.fold(spark, folder)
    add(store.extended(table(spark, [fresh[0], fresh[2]]), clock[1], clock[2]), 3)
    assert store.fold(spark, folder)
    assert sums(store.stored(spark, folder)) == sums(rows(fresh, clock[2]))
