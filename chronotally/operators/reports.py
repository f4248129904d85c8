"""Report aggregates over runs, jobs and observations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.functions.columns import wilson
from chronotally.operators import quantiles as Q
from chronotally.operators.gates import part


def failure_rate(df: DataFrame, keys: Sequence[str], failed: Column, finished: Column) -> DataFrame:
    """failed, finished, rate with its 95 % interval; groups without a finished run have null rates."""
    out = df.groupBy(*keys).agg(F.count_if(failed & finished).alias("failed"), F.count_if(finished).alias("finished"))
    p, lo, hi = wilson(F.col("failed"), F.col("finished"))
    return out.withColumns({"rate": F.round(p, 9), "low": F.round(lo, 9), "high": F.round(hi, 9)})


def share_of_total(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """n and its share of all rows per key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.crossJoin(F.broadcast(total)).select(*keys, "n", F.round(F.col("n") / F.col("_t"), 9).alias("share"))  # one row on the right


def next_outcome(df: DataFrame, keys: Sequence[str], order: Sequence[str], outcome: str) -> DataFrame:
    """Rows with next_<outcome>: the next row's of the key."""
    return df.withColumn(f"next_{outcome}", F.lead(outcome).over(Window.partitionBy(*keys).orderBy(*order)))


def sample_weights(df: DataFrame, keys: Sequence[str], fetched: Column, skipped: Column) -> DataFrame:
    """weight = rows / fetched rows per key, without skipped rows; null if nothing was fetched."""
    out = df.where(~skipped).groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(fetched).alias("fetched"))
    return out.withColumn("weight", F.try_divide(F.col("total"), F.col("fetched")))


def linear_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, *, fallback: tuple[float, float] = (1.0, 0.0)) -> DataFrame:
    """Least squares y = intercept + slope x per key, slope at least 0 and intercept at least 1, 9 digits.

    The intercept is taken from the means after the slope is clamped. Fewer than 3 rows or one distinct x give the fallback.
    Rows with a null x or y do not count. Plain sums add up the same in any order as long as x and y are whole numbers."""
    u, v = F.col(x).cast("double"), F.col(y).cast("double")
    sums = df.where(u.isNotNull() & v.isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.min(u).alias("lo"), F.max(u).alias("hi"), F.sum(u).alias("sx"), F.sum(v).alias("sy"), F.sum(u * u).alias("sxx"), F.sum(u * v).alias("sxy"))
    ok = (F.col("n") >= 3) & (F.col("lo") < F.col("hi"))
    slope = F.greatest(F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")), F.lit(0.0))
    intercept = F.greatest((F.col("sy") - slope * F.col("sx")) / F.col("n"), F.lit(1.0))
    return sums.select(*keys, "n", F.when(ok, F.round(intercept, 9)).otherwise(fallback[0]).alias("intercept"), F.when(ok, F.round(slope, 9)).otherwise(fallback[1]).alias("slope"))


def group_medians(df: DataFrame, keys: Sequence[str], value: str, ok: Column) -> DataFrame:
    """successes per key, and the interpolated median of the value over successes if each of them has one."""
    v = F.when(ok, F.col(value).cast("double"))
    return df.groupBy(*keys).agg(F.count_if(ok).alias("successes"), F.when(F.count(v) == F.count_if(ok), F.median(v)).alias("median"))


def baseline_compare(df: DataFrame, keys: Sequence[str], shape: str, value: str, first: str) -> DataFrame:
    """Value of each shape against the baseline shape of its key; null if either is missing or the baseline is 0."""
    base = df.where(F.col(shape) == first).select(*keys, F.col(value).alias("base"))
    out = df.where(F.col(shape) != first).join(base, list(keys), "left")
    return out.select(*keys, shape, value, "base", F.round(1 - F.try_divide(F.col(value), F.col("base")), 9).alias("reduction"), F.round(F.try_divide(F.col("base"), F.col(value)), 9).alias("ratio"))


def drift_invalidate(df: DataFrame, keys: Sequence[str], identity: str, ok: Column) -> DataFrame:
    """Rows with ``comparable``: false for a whole key whose successful rows have no, a null or more than one identity."""
    window = Window.partitionBy(*keys)
    kinds = F.size(F.collect_set(F.when(ok, F.col(identity))).over(window))
    unknown = F.coalesce(F.max(F.when(ok, F.col(identity).isNull().cast("int"))).over(window), F.lit(0))
    return df.withColumn("comparable", (kinds == 1) & (unknown == 0))


def group_overlap_cost(
    df: DataFrame, group: str, member: str, modules: str, weight: str, *, overlap: float = 0.5, behind: str | None = None, dependency: str | None = None,
    fixed: float = 0.0, per_work: float = 1.0, scale: float = 1.0, multiplier: float = 1.0,
) -> DataFrame:
    """members, work and cost per group. A member's weight is discounted by ``overlap`` times the share of its modules that
    members before it (by ``member``) had, and grows by how far it is ``behind``, 500 at most, in units of 500. The cost is
    fixed + per_work * work * scale, times the multiplier if any member has the ``dependency`` flag. A member without
    modules counts in full."""
    extra = [F.coalesce(F.col(behind), F.lit(0)).alias("_behind") if behind else F.lit(0).alias("_behind"), F.coalesce(F.col(dependency), F.lit(False)).alias("_dep") if dependency else F.lit(False).alias("_dep")]
    rows = df.select(group, member, weight, *extra, F.explode_outer(F.array_distinct(modules)).alias("_m"))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(group, "_m").orderBy(member)))
    own = rows.groupBy(group, member).agg(F.max(weight).alias("w"), F.max("_behind").alias("b"), F.bool_or("_dep").alias("d"), F.count("_m").alias("n"), F.count_if((F.col("_r") > 1) & F.col("_m").isNotNull()).alias("shared"))
    share = F.coalesce(F.try_divide(F.col("shared"), F.col("n")), F.lit(0.0))
    work = F.col("w") * (1 - F.lit(float(overlap)) * share) * (1 + F.least(F.col("b"), F.lit(500)) / F.lit(500.0))
    out = own.groupBy(group).agg(F.count("*").alias("members"), F.sum(work).alias("work"), F.bool_or("d").alias("_d"))
    cost = (F.lit(float(fixed)) + F.lit(float(per_work)) * F.col("work") * F.lit(float(scale))) * F.when(F.col("_d"), F.lit(float(multiplier))).otherwise(1.0)
    return out.select(group, "members", F.round("work", 6).alias("work"), F.round(cost, 6).alias("cost"))


def daily_median(df: DataFrame, day: Column, least: int, q: float = 0.5) -> DataFrame:
    """Quantile (report rule) of daily counts over days with at least ``least`` rows."""
    days = df.groupBy(day.alias("day")).agg(F.count("*").alias("n")).where(F.col("n") >= least).withColumn("_k", F.lit(1))
    return Q.report_quantile(days, ["_k"], "n", q).drop("_k")


def engine_costs(builds: DataFrame, post: DataFrame, jobs: DataFrame, keys: Sequence[str], *, engine: str = "engine", members: str = "members") -> DataFrame:
    """Cost of what was merged, per engine. ``builds`` are validations (keys, engine, landed, conclusion, and the ids of their members as
    an array), ``post`` are runs after a merge (keys, engine, null where it is unknown), ``jobs`` have run_s of both.

    An item counts once however many landed builds held it, and only if its build landed. Cost is of all jobs and attempts,
    failures too. What cannot be attributed has a null engine. Rows meet by engine as partial sums only."""
    cost = jobs.groupBy(*keys).agg(F.sum("run_s").alias("_s"))
    none, count = F.lit(0).cast("long"), lambda c: F.when(c, 1).otherwise(0).cast("long")
    names = ("runs", "items", "validation_s", "post_s", "failed", "cancelled")
    row = lambda df, **found: df.select(F.col(engine), *[found.get(n, none).alias(n) for n in names])
    seconds = F.coalesce(F.col("_s"), none)
    checked = row(builds.join(cost, list(keys), "left"), runs=F.lit(1).cast("long"), validation_s=seconds, failed=count(F.col("conclusion") == "failure"), cancelled=count(F.col("conclusion") == "cancelled"))
    landed = builds.where("landed").select(engine, F.explode(members).alias("_item")).where("_item is not null").distinct()
    rows = checked.unionByName(row(landed, items=F.lit(1).cast("long"))).unionByName(row(post.join(cost, list(keys), "left"), post_s=seconds))
    out = rows.groupBy(engine).agg(*[F.sum(n).alias(n) for n in names]).withColumn("total_s", F.col("validation_s") + F.col("post_s"))
    return out.withColumn("per_item", F.try_divide("total_s", "items"))


def resource_cohorts(attempts: DataFrame, jobs: DataFrame, resources: DataFrame, keys: Sequence[str], by: Sequence[str], *, scope: str = "reaped-descendants") -> DataFrame:
    """What attempts of a cohort used, by ``by`` and the sizes of their runners.

    ``jobs`` have runner_size and runner_kind, ``resources`` coverage and payload (JSON), at most one row per key. A measure
    counts if it is a finite number of at least 0; CPU and memory of commands only if all descendants were accounted for
    (``scope``), CPU only if both parts are there. ``covered`` observations are present, ``partial`` ones of these say that host
    counters are missing, ``incomplete`` ones have another scope. cpu_s, rss_bytes, busy and sampler_s are null if no attempt has them."""
    known = lambda name: F.when(F.col(name) != "", F.col(name))
    sizes = jobs.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(F.coalesce(known("runner_size"), known("runner_kind"), F.lit("unknown")))), ",").alias("sizes"))
    seen = resources.select(*keys, "coverage", F.try_parse_json("payload").alias("_p"))
    rows = attempts.select(*keys, *by).join(sizes, list(keys), "left").join(seen, list(keys), "left").withColumn("sizes", F.coalesce("sizes", F.lit("unknown")))

    def number(name: str) -> Column:
        x = part(F.col("_p"), name)
        value = F.when(F.schema_of_variant(x).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(x, "$", "double"))
        return F.when((value >= 0) & (value < float("inf")), value)

    whole, present = F.coalesce(part(F.col("_p"), "command_accounting_scope", "string") == scope, F.lit(False)), F.coalesce(F.col("coverage") == "present", F.lit(False))
    gap = F.coalesce(~F.to_json(part(F.col("_p"), "missing")).isin("null", "false", "0", "0.0", '""', "[]", "{}"), F.lit(False))
    rows = rows.select(
        *by, "sizes", present.alias("_there"), (present & gap).alias("_partial"), (present & ~whole).alias("_incomplete"), F.floor(F.coalesce(number("samples"), F.lit(0.0))).cast("long").alias("_samples"), number("sampler_cpu_s").alias("_sampler"), number("host_cpu_busy_fraction").alias("_busy"),
        F.when(whole, number("command_cpu_user_s") + number("command_cpu_system_s")).alias("_cpu"), F.when(whole, number("command_max_process_rss_bytes")).alias("_rss"),
    )
    group = [*by, "sizes"]
    out = rows.groupBy(*group).agg(
        F.count("*").alias("attempts"), F.count_if("_there").alias("covered"), F.count_if("_partial").alias("partial"), F.count_if("_incomplete").alias("incomplete"), F.sum("_samples").alias("samples"), F.sum("_cpu").alias("cpu_s"), F.max("_rss").alias("rss_bytes"), F.sum("_sampler").alias("sampler_s"),
    )
    busy = Q.report_quantile(rows, group, "_busy", 0.5).select(*[F.col(g).alias(f"_{g}") for g in group], F.col("quantile").alias("busy"))
    return out.join(busy, reduce(and_, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]), "left").drop(*[f"_{g}" for g in group])
