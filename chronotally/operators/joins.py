"""Joins over time: as-of, point-in-time, interval overlap; and comparison of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_latest(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, value: str, *, strict: bool = False, slice_: int | None = None) -> DataFrame:
    """Each left row with the value of the last right row of its key at or before (strict: before) its time.

    Both sides are unioned and the last value is carried forward in time order, which needs one shuffle and no range
    join. With ``slice_`` (a width of time) keys are cut into time slices, each of which starts from the last value of
    the slices before it, so that a hot key is spread over many tasks. Equal right times: the largest value."""
    order_right = 1 if strict else 0
    lcols = left.columns
    a = left.select(*keys, F.col(left_at).alias("_t"), F.lit(1 - order_right).alias("_o"), F.struct(*lcols).alias("_l"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    b = right.select(*keys, F.col(right_at).alias("_t"), F.lit(order_right).alias("_o"), F.lit(None).cast(a.schema["_l"].dataType).alias("_l"), F.col(value).alias("_v"))
    rows = a.unionByName(b)
    part = list(keys)
    if slice_:
        rows = rows.withColumn("_s", F.floor(F.col("_t") / slice_))
        part += ["_s"]
    window = Window.partitionBy(*part).orderBy("_t", "_o", "_v").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_found", F.last("_v", ignorenulls=True).over(window))
    if slice_:
        tails = rows.where("_v is not null").groupBy(*part).agg(F.max(F.struct("_t", "_o", "_v")).alias("_tail"))
        slices = rows.select(*part).distinct().join(tails, part, "left")  # one row per key and slice
        before = F.last("_tail", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.join(slices.select(*part, before["_v"].alias("_carry")), part).withColumn("_found", F.coalesce("_found", "_carry"))
    return rows.where("_l is not null").select("_l.*", F.col("_found").alias(f"asof_{value}"))


def pit_feature_join(left: DataFrame, features: DataFrame, keys: Sequence[str], known_at: str, available_at: str, tie: Sequence[str], *, slice_: int | None = None) -> DataFrame:
    """Latest feature of exactly this key that was available when the left row was known; null if none. Ties by ``tie``.

    An as-of union: every left row, repeated or with nulls, comes back once. A null key or time has no feature."""
    cols = [c for c in features.columns if c not in keys]
    usable = features.dropna(subset=[*keys, available_at]).select(*keys, F.col(available_at).alias("_at"), F.struct(F.struct(*tie).alias("tie"), F.struct(*cols).alias("f")).alias("_f"))
    found = asof_latest(left, usable, keys, known_at, "_at", "_f", slice_=slice_)
    return found.select(*left.columns, "asof__f.f.*")


def interval_overlap_join(intervals: DataFrame, windows: DataFrame, start: str, end: str, lo: str, hi: str, slot: int, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs of intervals and windows that overlap, with ``overlap``; with ``keys``, columns of both sides, pairs of one key
    only. Both sides are cut into slots of time and joined on the keys and the slot, so the join is an equi-join; a pair
    counts in the first slot that both touch. A null key has no pairs."""
    slots = lambda x, y: F.explode(F.sequence(F.floor(F.col(x) / slot), F.floor((F.col(y) - 1) / slot)))
    a = intervals.where(F.col(end) > F.col(start)).withColumn("_slot", slots(start, end))
    b = windows.where(F.col(hi) > F.col(lo)).withColumn("_slot", slots(lo, hi))
    pairs = a.join(b, [*keys, "_slot"]).where((F.col(start) < F.col(hi)) & (F.col(end) > F.col(lo)))
    pairs = pairs.where(F.col("_slot") == F.floor(F.greatest(F.col(start), F.col(lo)) / slot)).drop("_slot")
    return pairs.withColumn("overlap", F.least(F.col(end), F.col(hi)) - F.greatest(F.col(start), F.col(lo)))


def latest_wins(first: DataFrame, second: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key the fresher row of two feeds by ``order``; on a tie the first feed wins."""
    both = first.withColumn("_prio", F.lit(1)).unionByName(second.withColumn("_prio", F.lit(0)))
    rest = [c for c in first.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order, "_prio"))
    return both.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def table_diff(stored: DataFrame, reference: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, field) of every differing column of rows in both tables, and field '*' for rows in one only."""
    a = stored.select(*keys, F.struct(*[F.col(c).alias(c) for c in columns]).alias("_a"))
    b = reference.select(*keys, F.struct(*[F.col(c).alias(c) for c in columns]).alias("_b"))
    both = a.join(b, list(keys), "full")
    fields = F.filter(F.array(*[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    found = F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.array(F.lit("*"))).otherwise(fields)
    return both.select(*keys, F.explode(found).alias("field"))


def set_difference(expected: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys in one set only, with side missing or unexpected."""
    a, b = expected.select(*keys).distinct(), observed.select(*keys).distinct()
    missing = a.join(b, list(keys), "left_anti").withColumn("side", F.lit("missing"))
    return missing.unionByName(b.join(a, list(keys), "left_anti").withColumn("side", F.lit("unexpected")))


def unique_lookup(df: DataFrame, key: str, labels: str, dimension: DataFrame, label: str, value: str) -> DataFrame:
    """``value`` of the dimension rows that a row's labels name, only if they name exactly one value."""
    named = df.select(key, F.explode(labels).alias(label)).join(dimension.select(label, value), label)
    one = named.groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_max"), F.count_distinct(value).alias("_n"))
    return df.join(one.where("_n = 1").select(key, value), key, "left")


def only_match(left: DataFrame, right: DataFrame, keys: Sequence[str], right_cols: Sequence[str]) -> DataFrame:
    """Left rows with their single match; state is 'matched' or 'missing-or-ambiguous'."""
    one = right.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.min(c).alias(c) for c in right_cols]).where("_n = 1").drop("_n").withColumn("_hit", F.lit(True))
    out = left.join(one, list(keys), "left")
    return out.withColumn("state", F.when(F.col("_hit"), "matched").otherwise("missing-or-ambiguous")).drop("_hit")


def slot_grid(spark, **axes: Sequence) -> DataFrame:
    """Cartesian grid of small literal axes."""
    out = spark.range(1).select()
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def attach_by(left: DataFrame, right: DataFrame, on: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Left join on all of ``on`` (left name -> right name); existing values of ``columns`` are kept."""
    side = right.select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(on.values())], *[F.col(c).alias(f"_new_{c}") for c in columns])
    match: Column = F.lit(True)
    for i, name in enumerate(on):
        match = match & (F.col(name) == F.col(f"_k{i}"))
    out = left.join(side, match, "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_new_{c}")).alias(c) if c in columns else F.col(c) for c in left.columns])


def containment_join(rows: DataFrame, names: DataFrame, needle: str, name: str, *, gram: int = 6) -> DataFrame:
    """Pairs of a row and a name that contains the row's ``needle``.

    A needle is looked up by the one of its parts of ``gram`` characters (all of it, if it is shorter) that the fewest names have,
    among the parts of the names, and then verified: an equi-join, in which common parts of templated names meet nobody. Null
    needles and names match nothing; an empty needle is in every name. Columns of the two sides must differ in name."""
    length = F.least(F.length(needle), F.lit(gram))
    parts = lambda text, size: F.array_distinct(F.when(size == 0, F.array(F.lit(""))).otherwise(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, size))))
    wanted = rows.where(F.col(needle).isNotNull()).select(F.col(needle).alias("_needle"), length.alias("_size")).distinct()
    own = wanted.select("_needle", "_size", F.explode(parts(F.col("_needle"), F.col("_size"))).alias("_part"))
    sizes = wanted.agg(F.sort_array(F.collect_set("_size"))).first()[0]  # gram + 1 numbers at most
    named = names.where(F.col(name).isNotNull())
    grams = [named.where(F.length(name) >= size).select(F.col(name).alias("_name"), F.lit(size).alias("_size"), F.explode(parts(F.col(name), F.lit(size))).alias("_part")) for size in sizes]
    if not grams:
        return rows.limit(0).join(named.limit(0), F.lit(True))
    known = grams[0]
    for more in grams[1:]:
        known = known.unionByName(more)
    known = known.distinct()
    counts = known.groupBy("_part", "_size").agg(F.count("*").alias("_n"))
    rarest = own.join(counts, ["_part", "_size"], "left").groupBy("_needle").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_part").alias("p"), F.col("_size").alias("s"))).alias("r"))
    pairs = rarest.where("r.n > 0").select("_needle", F.col("r.p").alias("_part"), F.col("r.s").alias("_size")).join(known, ["_part", "_size"]).where(F.contains("_name", F.col("_needle"))).select("_needle", "_name").distinct()
    return rows.join(pairs, F.col(needle) == F.col("_needle")).join(named, F.col("_name") == F.col(name)).drop("_needle", "_name")


def attach_jobs(slots: DataFrame, jobs: DataFrame, slot: str, units: Column) -> DataFrame:
    """slots (with status) and the one job whose name contains the slot: job (its id), job_coverage (its status, or
    missing-or-ambiguous), status (a success whose job did not succeed is failed-job), job_elapsed_s from the first step's start to
    the completion if a runner had it, and what that costs at ``units`` a minute.

    jobs: job, name, job_status, job_conclusion, runner_name, completed, steps (array with started), instants in seconds."""
    pairs = containment_join(slots.select(slot).distinct(), jobs, slot, "name").groupBy(slot)
    columns = ["job", "job_status", "job_conclusion", "runner_name", "completed", "steps"]
    one = pairs.agg(F.count("*").alias("_n"), F.min(F.struct(*columns)).alias("_job")).where("_n = 1").select(slot, "_job.*")
    rows = slots.join(one, slot, "left")
    began = F.array_min(F.transform("steps", lambda s: s["started"]))
    timed = F.nullif(F.col("runner_name"), F.lit("")).isNotNull() & began.isNotNull()
    elapsed = F.when(timed, F.col("completed") - began)
    found = F.col("job_status").isNotNull()
    failed = found & (F.col("status") == "success") & ((F.col("job_status") != "completed") | ~F.col("job_conclusion").eqNullSafe(F.lit("success")))
    return rows.select(
        *[F.when(failed, "failed-job").otherwise(F.col("status")).alias("status") if c == "status" else F.col(c) for c in slots.columns],
        "job", F.coalesce("job_status", F.lit("missing-or-ambiguous")).alias("job_coverage"), elapsed.alias("job_elapsed_s"), (elapsed / 60 * units).alias("job_unit_minutes"),
    )


def ready_times(landed: DataFrame, ready: DataFrame, *, item: str, version: str, engine: str, at: str, seen: str, loose: str) -> DataFrame:
    """landed (a row per landed member: item, version, engine, at) with ``ready``, when the item was first ready.

    First the exact version counts, whenever it was ready; without it, for the engine ``loose`` only, the latest ready time of any version
    of the item that is not after the landing. ready: item, version, seen; of a version the earliest counts. Equal times are fine;
    null items and versions match nothing. The second level is a union and one window per item, over landings without an exact
    version and ready times only, so that it sorts no more than it must."""
    first = ready.where(F.col(item).isNotNull()).groupBy(item, version).agg(F.min(seen).alias("_seen"))
    rows = landed.join(first.where(F.col(version).isNotNull()), [item, version], "left")
    exact = rows.where((F.col("_seen").isNotNull()) | ~F.col(engine).eqNullSafe(F.lit(loose))).withColumnRenamed("_seen", "ready")
    open_ = rows.where(F.col("_seen").isNull() & (F.col(engine) == loose)).drop("_seen")
    found = asof_latest(open_, first.select(item, F.col("_seen").alias("_at"), F.col("_seen").alias("ready")), [item], at, "_at", "ready")
    return exact.unionByName(found.withColumnRenamed("asof_ready", "ready"))


def landing_latencies(landed: DataFrame, ready: DataFrame, *, item: str, version: str, engine: str, at: str, seen: str, loose: str) -> DataFrame:
    """item, engine, at, ready of every item's first landing that has a ready time at or before it (``ready_times``); one per item."""
    rows = ready_times(landed, ready, item=item, version=version, engine=engine, at=at, seen=seen, loose=loose).where(F.col("ready") <= F.col(at))
    return rows.groupBy(item).agg(F.min(F.struct(at, engine, "ready")).alias("_r")).select(item, f"_r.{engine}", f"_r.{at}", "_r.ready")
