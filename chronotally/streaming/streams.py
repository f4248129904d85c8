"""Structured Streaming counterparts. Each takes a streaming (or batch) DataFrame; state is bounded by watermarks or time-outs."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chronotally.operators import folds


def event_stream(spark: SparkSession, path: str, schema: str, per_trigger: int = 100) -> DataFrame:
    """Envelopes from a folder of JSON files; ``kind`` tells which sub-struct is set. The schema is given, never inferred."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(path)
    kinds = [c for c, t in rows.dtypes if t.startswith(("struct", "array")) and c != "kind"]
    return rows.withColumn("kind", F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in kinds]))


def stream_dedupe(df: DataFrame, key: str, received: str, window: str = "14 days") -> DataFrame:
    """Each delivery once within the replay window."""
    return df.withWatermark(received, window).dropDuplicatesWithinWatermark([key])


def stream_tumbling(df: DataFrame, ts: str, keys: Sequence[str], width: str, late: str, *aggs: Column) -> DataFrame:
    """Aggregates per fixed bucket; rows later than ``late`` are ignored."""
    return df.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *keys).agg(*aggs).select(F.col("w.start").alias("bucket"), *keys, *[c for c in _names(aggs)])


def stream_sliding(df: DataFrame, ts: str, keys: Sequence[str], width: str, slide: str, late: str, *aggs: Column) -> DataFrame:
    """Aggregates per trailing window, by the window's end."""
    return df.withWatermark(ts, late).groupBy(F.window(ts, width, slide).alias("w"), *keys).agg(*aggs).select(F.col("w.end").alias("through"), *keys, *[c for c in _names(aggs)])


def stream_sessions(df: DataFrame, ts: str, keys: Sequence[str], gap: str, late: str) -> DataFrame:
    """Runs of rows of a key without a gap of ``gap`` or more: start, end, n. Spark needs at least one key here."""
    out = df.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def _names(aggs: Sequence[Column]) -> list[str]:
    return [a._jc.toString().rsplit(" AS ", 1)[1].strip("`") for a in aggs]


def stream_latest_state(df: DataFrame, keys: Sequence[str], seq: str, columns: Sequence[str], merge: folds.Merge, ts: str, lifetime: str) -> DataFrame:
    """keys, seq, accepted and the whole record before and after each observation, as ``folds.state_changes`` gives them.

    The record is kept as state until the watermark passes the key's last row by ``lifetime``. Micro-batches count as arrived one
    after the other, rows of one in order of ``seq``; a record that was updated earlier than the state's never replaces it."""
    types = dict(df.dtypes)
    out = ", ".join(f"{k} {types[k]}" for k in keys) + f", {seq} {types[seq]}, accepted boolean, before string, after string"
    step, names = folds.record_step(merge), [*keys, seq, "accepted", "before", "after"]

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values([seq, "_record"])
        now = (json.loads(state.get[0]), state.get[0]) if state.exists else None
        found = []
        for at, record in zip(rows[seq], rows["_record"], strict=True):
            now, values = step(now, (record,))
            found.append([*key, at, *values])
        state.update((now[1],))
        state.setTimeoutTimestamp(int(rows[ts].max().timestamp() * 1000) + _millis(lifetime))
        yield pd.DataFrame(found, columns=names)

    rows = df.withColumn("_record", folds.packed(df, columns)).withWatermark(ts, "1 hour").groupBy(*keys)
    rows = rows.applyInPandasWithState(fold, out, "record string", "append", GroupStateTimeout.EventTimeTimeout)
    shape = folds.record_type(df, columns)
    return rows.withColumns({c: F.from_json(c, shape) for c in ("before", "after")})


def _millis(text: str) -> int:
    n, unit = text.split()
    return int(n) * {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]


def stream_frames(df: DataFrame, ts: str, expiry: str = "1 hour") -> DataFrame:
    """Frames (source, snapshot, part, parts, payload, and epoch if there is such a column) held until a snapshot is whole,
    then emitted part by part; partial snapshots are dropped when the watermark passes their last frame by ``expiry``.

    Whole means that exactly the parts 0 .. parts - 1 are there. A part outside that range, another number of parts, or
    another payload for a part that came already makes the snapshot void: it is never emitted. A frame of a newer epoch
    voids what older ones brought and starts anew; frames of older epochs are ignored."""
    epoch = F.coalesce(F.col("epoch").cast("long"), F.lit(0)) if "epoch" in df.columns else F.lit(0).cast("long")

    def hold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches))
        seen, total, newest, void, done = {}, 0, -(2**62), False, False
        if state.exists:
            numbers, payloads, total, newest, void, done = state.get
            seen = dict(zip(numbers, payloads, strict=True))
        for at, part, parts, payload in zip(rows["_epoch"], rows["part"], rows["parts"], rows["payload"], strict=True):
            if at < newest:
                continue
            if at > newest:
                seen, total, newest, void, done = {}, int(parts), int(at), False, False
            right = parts == total and 0 <= part < total and (done or seen.get(int(part), payload) == payload)
            void = void or not right
            if right and not done:
                seen[int(part)] = payload
        if not done and not void and len(seen) == total:
            done = True
            yield pd.DataFrame([[*key, p, seen[p]] for p in sorted(seen)], columns=["source", "snapshot", "part", "payload"])
            seen = {}
        state.update((list(seen), list(seen.values()), total, newest, void, done))
        state.setTimeoutTimestamp(int(rows[ts].max().timestamp() * 1000) + _millis(expiry))

    out, kept = "source string, snapshot string, part int, payload string", "parts array<int>, payloads array<string>, total int, epoch long, void boolean, done boolean"
    return df.withColumn("_epoch", epoch).withWatermark(ts, "10 minutes").groupBy("source", "snapshot").applyInPandasWithState(hold, out, kept, "append", GroupStateTimeout.EventTimeTimeout)


def foreach_batch_once(apply: Callable[[DataFrame, int], None], receipts: str) -> Callable[[DataFrame, int], None]:
    """A batch whose id has a receipt is skipped; the receipt is written after the work, so ``apply`` must itself be
    idempotent for a batch that failed half-way (an overwrite of the batch's own partition is)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{receipts}/batch={batch_id}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(path):
            return
        apply(batch, batch_id)
        files.mkdirs(path)

    return run


def foreach_batch_deltas(derive: Callable[[DataFrame], DataFrame], folder: str) -> Callable[[DataFrame, int], None]:
    """Exactly-once deltas: a batch's rows are their own receipt. They are written aside and renamed to batch=<id>, which is
    one step on file systems with an atomic rename; a batch that is there already is skipped, and what a failed try left
    aside is written over. Readers of ``folder`` see whole batches, each once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        at = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        files = at("x").getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(at(f"batch={batch_id}")):
            return
        derive(batch).write.mode("overwrite").parquet(f"{folder}/_aside-{batch_id}")
        if not files.rename(at(f"_aside-{batch_id}"), at(f"batch={batch_id}")):
            raise OSError(f"batch {batch_id} could not be put in place")

    return run


def refresh_active(open_rows: DataFrame, clock: int, start: str = "started") -> DataFrame:
    """Open intervals extended to the clock: called each trigger from a foreachBatch on the stored open rows."""
    return open_rows.withColumn("ended", F.greatest(F.col(start), F.lit(clock)))


def open_days(df: DataFrame, day: str, clock_day: str, keep_days: int) -> DataFrame:
    """Rows of days that may still change; rows of closed days are acknowledged and dropped."""
    return df.where(F.col(day) > F.date_sub(F.lit(clock_day).cast("date"), keep_days))
