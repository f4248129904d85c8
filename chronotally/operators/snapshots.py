"""Snapshot streams, landings, queue history and graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that the session names; loops below cut their lineage with it. A folder is only
    made up in a local session, as in tests: executors of a cluster share no local one."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            import tempfile

            folder = tempfile.mkdtemp(prefix="spark-checkpoints-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def first_observed(snapshots: DataFrame, at: str, items: str) -> DataFrame:
    """First and last snapshot that holds each item."""
    rows = snapshots.select(F.col(at).alias("at"), F.explode(items).alias("item"))
    return rows.groupBy("item").agg(F.min("at").alias("first_seen"), F.max("at").alias("last_seen"))


def staleness_end(versions: DataFrame, item: str, version: str, at: str, gone: Column) -> DataFrame:
    """When a version of an item ends: another version is first seen, or it is explicitly withdrawn, whichever is earlier."""
    first = versions.groupBy(item, version).agg(F.min(at).alias("start"), F.min(F.when(gone, F.col(at))).alias("withdrawn"))
    after = F.lead("start").over(Window.partitionBy(item).orderBy("start", version))
    return first.select(item, version, "start", F.least("withdrawn", after).alias("end"))


def replay_journal(changes: DataFrame, keys: Sequence[str], order: str, item: str, delta: str) -> DataFrame:
    """Live-set size after each change of a journal with idempotent adds (+1) and removes (-1): only a change of an
    item's state counts, and an unknown item starts outside."""
    state = changes.withColumn("_was", F.lag(delta, 1, -1).over(Window.partitionBy(*keys, item).orderBy(order)))
    real = F.when(F.col(delta) != F.col("_was"), F.col(delta)).otherwise(0)
    run = F.sum(real).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return state.withColumn("live", run).drop("_was")


def clock_inversions(df: DataFrame, keys: Sequence[str], order: str, at: str) -> DataFrame:
    """``monotone``: running maximum of the recorded time in journal order; ``uncertain`` where the record lags behind it."""
    high = F.max(at).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("monotone", high).withColumn("uncertain", F.col(at) < F.col("monotone"))


def minute_samples(df: DataFrame, keys: Sequence[str], at: str, value: str, lo: int, hi: int, step: int) -> DataFrame:
    """Value as of each whole step in [lo, hi]: the last change at or before it, null before the first."""
    # Each change is stretched to the next one behind the shuffle, so that only changes are shuffled and never the grid.
    end = lo + ((hi - lo) // step + 1) * step
    tick = F.when((F.col(at) <= hi) & F.col(value).isNotNull(), F.lit(lo) + F.greatest(F.lit(0), F.floor((F.col(at) - lo + (step - 1)) / step)) * step).otherwise(F.lit(end))
    changes = df.select(*keys, tick.cast("long").alias("tick"), F.col(at).alias("_at"), F.col(value).alias("_v"))
    last = changes.groupBy(*keys, "tick").agg(F.max_by("_v", F.struct("_at", "_v")).alias("_v"))
    w = Window.partitionBy(*keys).orderBy("tick")
    part = lambda a, b, v: F.struct(a.alias("a"), b.alias("b"), v.alias("v"))
    none = F.lit(None).cast(df.schema[value].dataType)
    last = last.withColumns({"_first": F.lag("tick").over(w).isNull(), "_next": F.coalesce(F.lead("tick").over(w), F.lit(end))})
    before, own = F.when(F.col("_first"), part(F.lit(lo).cast("long"), F.col("tick"), none)), part(F.col("tick"), F.col("_next"), F.col("_v"))
    parts = last.select(*keys, F.explode(F.array(before, own)).alias("_p")).where("_p.a < _p.b")
    return parts.select(*keys, F.explode(F.sequence("_p.a", F.col("_p.b") - step, F.lit(step).cast("long"))).alias("tick"), F.col("_p.v").alias("value"))


def journal_checks(df: DataFrame, keys: Sequence[str], id_: str) -> DataFrame:
    """Violations per key: the journal must start at 1 and have neither holes nor duplicates."""
    out = df.groupBy(*keys).agg(F.min(id_).alias("lo"), F.max(id_).alias("hi"), F.count("*").alias("n"), F.count_distinct(id_).alias("d"))
    found = F.array_compact(F.array(F.when(F.col("lo") != 1, "start"), F.when(F.col("hi") - F.col("lo") + 1 != F.col("d"), "hole"), F.when(F.col("n") != F.col("d"), "duplicate")))
    return out.select(*keys, F.explode(found).alias("violation"))


def missing_attempts(df: DataFrame, key: str, attempt: str) -> DataFrame:
    """(key, attempt) that are missing from 1 to the largest attempt."""
    wanted = df.groupBy(key).agg(F.max(attempt).alias("_m")).select(key, F.explode(F.sequence(F.lit(1), F.col("_m"))).alias(attempt))
    return wanted.join(df.select(key, attempt).distinct(), [key, attempt], "left_anti")


def completeness_watermark(df: DataFrame, key: str, created: str, pending: Column, scanned: str, live: Column, clock: int, hold: int) -> DataFrame:
    """Per key the earliest pending item's time, else the scanned-to time; a live item older than ``hold`` no longer holds it."""
    holds = pending & (~live | (F.col(created) >= clock - hold))
    return df.groupBy(key).agg(F.coalesce(F.min(F.when(holds, F.col(created))), F.max(scanned)).alias("complete_to"))


def window_reconciliation(rows: DataFrame, reported: DataFrame, keys: Sequence[str], id_: str, cap: int) -> DataFrame:
    """Distinct ids per listing window against the reported total: ok, short, over-cap; duplicates are counted."""
    got = rows.groupBy(*keys).agg(F.count_distinct(id_).alias("ids"), (F.count("*") - F.count_distinct(id_)).alias("duplicates"))
    out = reported.join(got, list(keys), "left").fillna(0, ["ids", "duplicates"])
    return out.withColumn("state", F.when(F.col("total") > cap, "over-cap").when(F.col("ids") < F.col("total"), "short").otherwise("ok"))


def journal_changes(journal: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, id, at, item, delta: what each row of a queue's journal (id, at, kind, number, members, withdrawn, against_main) adds (+1) or
    removes (-1). Approvals add; landings remove their members and what was withdrawn with them; withdrawals, anticipated
    problems, lost sources and conflicts with the main line remove their item. Other rows change nothing."""
    gone = F.col("kind").isin("withdrawn", "problem-anticipated", "probe-missing-source") | ((F.col("kind") == "probe-conflict") & F.coalesce("against_main", F.lit(False)))
    none = F.array().cast("array<long>")
    many = F.concat(F.coalesce("members", none), F.coalesce("withdrawn", none))
    items = F.when((F.col("kind") == "approved") | gone, F.array("number")).when(F.col("kind") == "landed", many)
    rows = journal.select(*keys, "id", "at", F.when(F.col("kind") == "approved", 1).otherwise(-1).alias("delta"), F.explode(F.array_distinct(items)).alias("item"))
    return rows.where("item is not null")


def expected_backlog(inputs: DataFrame, members: DataFrame, batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, item that a captured state says are waiting: inputs that wait or are reserved, and members that were neither removed nor
    withdrawn of batches that are open or at the head."""
    open_ = batches.where(F.col("state").isin("head", "open")).select(*keys, F.col("id").alias("batch_id"))
    held = members.where("not removed and not withdrawn").join(open_, [*keys, "batch_id"], "left_semi")
    waiting = inputs.where(F.col("state").isin("waiting", "reserved"))
    return waiting.select(*keys, F.col("number").alias("item")).unionByName(held.select(*keys, F.col("number").alias("item"))).distinct()


def journal_violations(journal: DataFrame, inputs: DataFrame, batches: DataFrame, expected: DataFrame, keys: Sequence[str], *, repository: str, until: int, captured: int) -> DataFrame:
    """keys, violation, item: why a journal cannot be replayed. It must be whole (``start``, ``hole``, ``duplicate``) and of one
    ``repository``; every input (id, number, repository) must have its recorded ``approval`` and every approval (input_id, number) its input; production
    must have been switched on, by the first setting that does so, before ``until``, which must not lie after the capture (``window``); and the items that the replay leaves must be the
    expected ones (``final-set``). ``item`` names an input or an item, and is null for what concerns the whole journal."""
    keys, nothing = list(keys), F.lit(None).cast("long")
    out = journal_checks(journal, keys, "id").withColumn("item", nothing)
    mixed = inputs.select(*keys, "repository").unionByName(batches.select(*keys, "repository")).where(~F.col("repository").eqNullSafe(F.lit(repository)))
    out = out.unionByName(mixed.select(*keys).distinct().select(*keys, F.lit("repository").alias("violation"), nothing.alias("item")))
    approved = journal.where("kind = 'approved'").groupBy(*keys, F.col("input_id").alias("item")).agg(F.max_by("number", "id").alias("_approved"))
    known = inputs.select(*keys, F.col("id").alias("item"), F.col("number").alias("_known"), F.lit(True).alias("_there"))
    wrong = approved.withColumn("_seen", F.lit(True)).join(known, [*keys, "item"], "full").where(F.col("_seen").isNull() | F.col("_there").isNull() | ~F.col("_approved").eqNullSafe(F.col("_known")))
    out = out.unionByName(wrong.select(*keys, F.lit("approval").alias("violation"), "item"))
    on = (F.col("kind") == "setting") & (F.col("key") == "publication_enabled") & (F.col("value") == "true")
    start = journal.groupBy(*keys).agg(F.min_by(F.when(on, F.col("at")), F.when(on, F.col("id"))).alias("_start"))
    late = start.where(F.col("_start").isNull() | (F.col("_start") > until) | F.lit(until > captured))
    out = out.unionByName(late.select(*keys, F.lit("window").alias("violation"), nothing.alias("item")))
    left = journal_changes(journal, keys).groupBy(*keys, "item").agg(F.max_by("delta", "id").alias("_d")).where("_d = 1").drop("_d")
    both = left.withColumn("_left", F.lit(True)).join(expected.select(*keys, "item").distinct().withColumn("_expected", F.lit(True)), [*keys, "item"], "full")
    return out.unionByName(both.where("_left is null or _expected is null").select(*keys, F.lit("final-set").alias("violation"), "item"))


def queue_samples(journal: DataFrame, keys: Sequence[str], lo: int, hi: int, step: int) -> DataFrame:
    """keys, tick, waiting, complete: items that wait at each whole step. Journal order owns the order of states; a record whose time lags behind
    an earlier one counts at that one's time, and steps between the two are not ``complete``, as their state depends on the choice."""
    keys = list(keys)
    rows = clock_inversions(journal_changes(journal, keys), keys, "id", "at")
    live = replay_journal(rows, keys, "id", "item", "delta").groupBy(*keys, "id", "monotone").agg(F.min("live").alias("waiting"))  # after the last item of a landing
    at_time = live.groupBy(*keys, "monotone").agg(F.max_by("waiting", "id").alias("waiting"))
    samples = minute_samples(at_time, keys, "monotone", "waiting", lo, hi, step).withColumnRenamed("value", "waiting")
    first, last = F.greatest(F.lit(lo), lo + F.ceil((F.col("at") - lo) / step) * step), F.least(F.lit(hi), lo + F.floor((F.col("monotone") - lo) / step) * step)
    unsure = rows.where("uncertain").select(*keys, first.cast("long").alias("_f"), last.cast("long").alias("_l")).where("_f <= _l")
    unsure = unsure.select(*keys, F.explode(F.sequence("_f", "_l", F.lit(step).cast("long"))).alias("tick")).distinct().withColumn("_unsure", F.lit(True))
    return samples.join(unsure, [*keys, "tick"], "left").select(*keys, "tick", F.coalesce("waiting", F.lit(0)).cast("long").alias("waiting"), F.col("_unsure").isNull().alias("complete"))
