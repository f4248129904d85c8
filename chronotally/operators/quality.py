"""Row-level quality gates: a specification of fields yields valid rows and rejected rows with the first reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """kind: string, number, integer or boolean. A field that is not required may be absent; one that is not nullable may not be null."""

    kind: str
    required: bool = True
    nullable: bool = False
    low: float | None = None
    high: float | None = None
    values: Sequence[str] = field(default_factory=tuple)
    pattern: str | None = None
    longest: int | None = None


def _json(payload: Column, name: str) -> Column:
    return F.get_json_object(payload, f"$.{name}")


def reasons(payload: Column, spec: Mapping[str, Field]) -> Column:
    """First reason to reject a JSON payload, or null. Order: not an object, unknown field, then fields in order."""
    keys = F.json_object_keys(payload)
    known = F.array(*[F.lit(n) for n in spec])
    tests = [F.when(keys.isNull(), F.lit("not-an-object")), F.when(F.size(F.array_except(keys, known)) > 0, F.concat(F.lit("unknown:"), F.array_join(F.array_sort(F.array_except(keys, known)), ",")))]
    for name, f in spec.items():
        there = F.array_contains(keys, name)
        value = _json(payload, name)
        say = lambda why, n=name: F.lit(f"{why}:{n}")
        if f.required:
            tests.append(F.when(~there, say("missing")))
        if not f.nullable:
            tests.append(F.when(there & value.isNull(), say("null")))
        if f.kind in ("number", "integer"):
            number = value.try_cast("double")
            tests.append(F.when(value.isNotNull() & (number.isNull() | ~value.rlike(r"^-?[0-9]" if f.kind == "number" else r"^-?[0-9]+$")), say("type")))
            if f.low is not None:
                tests.append(F.when(number < f.low, say("range")))
            if f.high is not None:
                tests.append(F.when(number > f.high, say("range")))
        if f.kind == "boolean":
            tests.append(F.when(value.isNotNull() & ~value.isin("true", "false"), say("type")))
        if f.values:
            tests.append(F.when(~value.isin(*f.values), say("enum")))
        if f.pattern:
            tests.append(F.when(~value.rlike(f.pattern), say("pattern")))
        if f.longest is not None:
            tests.append(F.when(F.length(value) > f.longest, say("length")))
    return F.coalesce(*tests)


def validate_strict(df: DataFrame, payload: str, spec: Mapping[str, Field]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``reason``) rows by a JSON payload column."""
    checked = df.withColumn("reason", reasons(F.col(payload), spec))
    return checked.where("reason is null").drop("reason"), checked.where("reason is not null")


def check_rows(df: DataFrame, tests: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows with ``reason``: the first test that does not hold; an unknown outcome does not hold either."""
    return df.withColumn("reason", F.coalesce(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in tests]))


def observation_coverage(artifact: Column, expired: Column, producer: Column, trusted: Sequence[str], valid: Column) -> Column:
    """Trust of an observation, from independent provenance and never from the payload's own label."""
    return (
        F.when(artifact.isNull(), "missing").when(F.coalesce(expired, F.lit(False)), "expired").when(producer.isNull(), "unavailable")
        .when(~producer.isin(*trusted), "unverified-producer").when(~F.coalesce(valid, F.lit(False)), "invalid-or-unavailable").otherwise("present")
    )


def registry_equality(rows: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Keys that a sample lacks, has beside the registry, or has more than once."""
    seen = rows.groupBy(key).agg(F.count("*").alias("_n"))
    both = registry.select(key, F.lit(True).alias("_known")).distinct().join(seen, key, "full")
    why = F.when(F.col("_n").isNull(), "missing").when(F.col("_known").isNull(), "unknown").when(F.col("_n") > 1, "repeated")
    return both.select(key, why.alias("reason")).where("reason is not null")
