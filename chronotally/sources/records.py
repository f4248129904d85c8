"""Sources and sinks: record archives, payloads, envelopes, journals, pages of a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_records(spark: SparkSession, root: str, kind: str, schema: str | StructType, since: str | None = None, until: str | None = None) -> DataFrame:
    """Records of one kind from an archive <root>/<kind>/repo=<repo>/day=<day>/*.json[.gz], days in [since, until].

    The schema is given, never inferred; repo and day are partitions, so that days outside are not read."""
    rows = spark.read.schema(schema).json(f"{root}/{kind}") if isinstance(schema, StructType) and "day" in schema.names else spark.read.option("basePath", f"{root}/{kind}").schema(_with_partitions(schema)).json(f"{root}/{kind}")
    if since is not None:
        rows = rows.where(F.col("day") >= F.lit(since).cast("date"))
    return rows if until is None else rows.where(F.col("day") <= F.lit(until).cast("date"))


def _with_partitions(schema: str | StructType) -> str | StructType:
    if isinstance(schema, StructType):
        return StructType(list(schema.fields)).add("repo", "string").add("day", "date")
    return f"{schema}, repo string, day date"


def append_records(df: DataFrame, root: str, kind: str, format_: str = "json") -> None:
    """Append a batch, by repo and day; earlier files are never rewritten. A day's rows go to few files."""
    df.repartition("repo", "day").write.mode("append").partitionBy("repo", "day").format(format_).option("compression", "gzip").save(f"{root}/{kind}")


def compact_partition(spark: SparkSession, root: str, kind: str, schema: str, repo: str, day: str, files: int, to: str) -> None:
    """Write one partition's rows as ``files`` files below another root, from which it can be swapped in."""
    rows = read_records(spark, root, kind, schema, day, day).where(F.col("repo") == repo)
    rows.repartition(files).write.mode("errorifexists").partitionBy("repo", "day").option("compression", "gzip").json(f"{to}/{kind}")


def write_daily_summary(df: DataFrame, path: str, day: str = "day") -> None:
    """Replace the days that ``df`` holds and no others (dynamic partition overwrite)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def tolerant_json(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """``parsed`` and ``status``: a payload that cannot be parsed becomes a row 'corrupt-result', never a failure."""
    parsed = F.from_json(payload, f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = df.withColumn("parsed", parsed)
    bad = F.col(payload).isNull() | F.col("parsed._bad").isNotNull()
    return rows.withColumn("status", F.when(bad, "corrupt-result").otherwise("ok"))


def pr_from_subject(message: Column) -> Column:
    """Item number from the last (#n) of the first line of a commit message."""
    first = F.element_at(F.split(message, "\n", 2), 1)
    return F.nullif(F.regexp_extract(first, r"^.*\(#([0-9]+)\)", 1), F.lit("")).cast("long")


def paged(df: DataFrame, index: str, size: int) -> DataFrame:
    """Page number of every row from its position, and how many pages there are."""
    n = df.agg(F.ceil(F.count("*") / size).alias("pages"))
    return df.withColumn("page", F.floor(F.col(index) / size)).crossJoin(F.broadcast(n))  # one row on the right


def read_journal(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(journal, changes): journal rows, and one row per member that a detail adds (+1) or withdraws (-1)."""
    journal = spark.read.schema(schema).json(path)
    move = lambda c, delta: journal.select("id", "at", F.explode(f"detail.{c}").alias("item"), F.lit(delta).alias("delta"))
    return journal, move("members", 1).unionByName(move("withdrawn", -1))


def history_to_events(runs: DataFrame, jobs: DataFrame, key: str, extra: Sequence[DataFrame] = ()) -> DataFrame:
    """Fact tables as envelopes: one event per run with its jobs, and the rows of other kinds beside them."""
    nested = jobs.groupBy(key).agg(F.collect_list(F.struct(*[c for c in jobs.columns if c != key])).alias("jobs"))
    events = runs.join(nested, key, "left").select(F.struct(*[F.col(c) for c in runs.columns]).alias("run"), F.coalesce("jobs", F.array().cast(nested.schema["jobs"].dataType)).alias("jobs"))
    for other in extra:
        events = events.unionByName(other, allowMissingColumns=True)
    return events


def log_excerpt(df: DataFrame, key: str, text: str, pattern: str, most: int) -> DataFrame:
    """First ``most`` lines that match, joined in order, and how many they are; rows without one are left out.

    The limit is the feature: an excerpt. Byte-order marks, timestamps and colour codes are taken off first."""
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "^﻿", ""), "(?m)^\\d{4}-\\d\\d-\\d\\dT[0-9:.]+Z ", ""), "\x1b\\[[0-9;]*m", "")
    some = F.slice(F.filter(F.split(clean, "\n"), lambda x: x.rlike(pattern)), 1, most)
    rows = df.select(key, some.alias("_some")).where(F.size("_some") > 0)
    return rows.select(key, F.array_join("_some", "\n").alias("excerpt"), F.size("_some").cast("long").alias("lines"))


def table_fingerprint(df: DataFrame, hash_: str) -> DataFrame:
    """One digest of a table's rows, in any order, from their hex hashes, and their count. Four numbers of 60 bits of each
    hash are added up, so that rows are combined before they are shuffled and none is collected."""
    sums = [F.sum(F.conv(F.substring(hash_, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")).alias(f"s{k}") for k in range(4)]
    total = df.agg(*sums, F.count("*").alias("n"))
    text = F.concat_ws(":", *[F.coalesce(F.col(f"s{k}"), F.lit(0)).cast("string") for k in range(4)], F.col("n").cast("string"))
    return total.select(F.sha2(text, 256).alias("fingerprint"), "n")
