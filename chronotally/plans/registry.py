"""Queries by name, each with the SQL that must give the same rows, and the facts they read.

The given tables stand for execution records: an event is a job (an interval of ``value`` minutes), an order is a
run, a line item is a job of that run, and documents, pages and conversations are logs, payloads and chains."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.functions.columns import micros

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Common table expressions, put before a query's SQL where their names occur in it.
FACTS = {
    "jobs": "select event_id as id, user_id as run, event_type as kind, epoch_us(ts) as a, epoch_us(ts) + cast(round(value * 60000000) as bigint) as b, value, props from events",
    "runs": """select o_orderkey as run, 'repo' || (o_custkey % 5) as repo, o_orderpriority as workflow, 1 + cast(o_orderkey % 3 as integer) as attempt, o_custkey as pr,
        case o_orderstatus when 'F' then 'failure' when 'O' then 'success' else 'cancelled' end as conclusion, epoch_us(o_orderdate) as created, o_orderkey % 997 as head, o_totalprice as price from orders""",
    "steps": """select l_orderkey as run, l_linenumber as n, cast(round(l_quantity) as bigint) as wait_s, cast(round(l_extendedprice) as bigint) as run_s, l_returnflag as kind, l_linestatus as size,
        epoch_us(l_shipdate) as a, l_partkey as module, case l_returnflag when 'R' then 'failure' when 'A' then 'success' else 'cancelled' end as conclusion from lineitem""",
    "snaps": "select epoch_us(ts) - epoch_us(ts) % 600000000 as tm, list_sort(list_distinct(list(user_id))) as items from events group by 1",
}


def query(sql: str | None = None):
    """Register a function under its name; ``sql`` may use the FACTS by name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            body = sql.strip()
            used = [n for n in FACTS if n in body]
            with_ = ", ".join(f"{n} as ({FACTS[n]})" for n in used)
            start = "with recursive " if body.startswith("with recursive ") else "with "
            SQL[f.__name__] = f"{start}{with_}, {body[len(start):]}" if used and body.startswith(start) else f"with {with_} {body}" if used else body
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = micros("ts")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("run"), F.col("event_type").alias("kind"), a.alias("a"),
        (a + F.round(F.col("value") * 60_000_000).cast("long")).alias("b"), "value", "props",
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run"), F.concat(F.lit("repo"), F.col("o_custkey") % 5).alias("repo"), F.col("o_orderpriority").alias("workflow"),
        (1 + F.col("o_orderkey") % 3).cast("int").alias("attempt"), F.col("o_custkey").alias("pr"),
        F.when(F.col("o_orderstatus") == "F", "failure").when(F.col("o_orderstatus") == "O", "success").otherwise("cancelled").alias("conclusion"),
        micros("o_orderdate").alias("created"), (F.col("o_orderkey") % 997).alias("head"), F.col("o_totalprice").alias("price"),
    )


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("n"), F.round("l_quantity").cast("long").alias("wait_s"), F.round("l_extendedprice").cast("long").alias("run_s"),
        F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("size"), micros("l_shipdate").alias("a"), F.col("l_partkey").alias("module"),
        F.when(F.col("l_returnflag") == "R", "failure").when(F.col("l_returnflag") == "A", "success").otherwise("cancelled").alias("conclusion"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-minute queue snapshots: tm, items (distinct, sorted)."""
    rows = jobs(spark, sf_dir).select((F.col("a") - F.col("a") % 600_000_000).alias("tm"), F.col("run").alias("item"))
    return rows.groupBy("tm").agg(F.sort_array(F.collect_set("item")).alias("items"))
