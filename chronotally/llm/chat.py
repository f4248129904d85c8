"""Chat formatting with cumulative-snapshot collapse (operator 1).

A conversation that was logged after every turn leaves snapshots, each a prefix of the next. A turn's
identity is (turn number, role, text); since the number is part of it, the sum of the turns' hashes up to
turn k is a rolling hash of the prefix. A conversation whose whole hash is the prefix hash of a longer one
is dropped by an anti-join, equal conversations keep the smallest id, and the maximal ones are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers in a block: running sums are taken within blocks and then over the few block sums.
BLOCK = 1024


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        "conv_id", F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )


def prefix_hashes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefixes, wholes): running hash (s1, s2, n) before the last turn number of each conversation, and its total."""
    digest = F.md5(F.concat("role", F.lit("\x1f"), "text"))
    distinct = _turns(conversations).select("conv_id", "turn", digest.alias("digest")).distinct()
    term = lambda *c: F.xxhash64(*c).cast("decimal(38,0)")
    sums = [F.sum("s1").alias("s1"), F.sum("s2").alias("s2"), F.sum("n").alias("n")]
    narrow = [F.col(c).cast("decimal(38,0)").alias(c) for c in ("s1", "s2")] + ["n"]
    turns = distinct.select("conv_id", "turn", term("turn", "digest").alias("s1"), term("digest", "turn").alias("s2"), F.lit(1).cast("long").alias("n"))
    turns = turns.groupBy("conv_id", "turn").agg(*sums).select("conv_id", "turn", *narrow)
    turns = turns.withColumn("block", F.floor(F.col("turn") / BLOCK))
    wholes = turns.groupBy("conv_id").agg(F.max("turn").alias("last"), *sums).select("conv_id", "last", *narrow)
    blocks = turns.groupBy("conv_id", "block").agg(*sums)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast("decimal(38,0)").alias(f"b_{c}") for c in ("s1", "s2", "n")])
    upto = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    local = turns.select("conv_id", "turn", "block", *[F.sum(c).over(upto).cast("decimal(38,0)").alias(c) for c in ("s1", "s2", "n")])
    joined = local.join(blocks, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")))
    running = joined.select("conv_id", "turn", *[(F.col(c) + F.col(f"b_{c}")).cast("decimal(38,0)").alias(c) for c in ("s1", "s2")], (F.col("n") + F.col("b_n")).cast("long").alias("n"))
    last = wholes.select(F.col("conv_id").alias("_c"), "last")
    prefixes = running.join(last, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("turn") < F.col("last"))).select("s1", "s2", "n")
    return prefixes, wholes


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that no other one extends; the smallest id of equal ones."""
    prefixes, wholes = prefix_hashes(conversations)
    classes = wholes.groupBy("s1", "s2", "n").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    kept = classes.join(prefixes.distinct(), ["s1", "s2", "n"], "left_anti")
    return kept.select("conv_id", F.col("n").alias("n_turns"), "n_copies")


def chatml(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def format_chats(conversations: DataFrame, template=chatml) -> DataFrame:
    """Render maximal conversations: conv_id, n_turns, n_copies, rendered.

    Turns go by turn number, then role, then text; an exact repeat of a turn counts once. Prefixes end behind all rows of a
    turn number: a snapshot that has only some of the rows which share a number is no prefix of the longer conversation. A null turn number
    stands as -1, a null role or text as ''; rows with a null conv_id form one conversation. Further columns
    are ignored; an empty table gives an empty result."""
    kept = maximal_conversations(conversations).withColumnRenamed("conv_id", "_c")
    turns = _turns(conversations).join(kept, F.col("conv_id").eqNullSafe(F.col("_c")))
    rows = turns.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("t"))
    return rows.select("conv_id", "n_turns", "n_copies", F.array_join(F.transform("t", lambda t: template(t["role"], t["text"])), "").alias("rendered"))


SQL = """
with t as (select distinct conv_id, coalesce(turn, -1) as turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
g as (select conv_id, turn, md5(string_agg(md5(role || chr(31) || text), ',' order by md5(role || chr(31) || text))) as d, count(*) as n from t group by conv_id, turn),
p as (select conv_id, turn, md5(string_agg(turn || ':' || d, ';') over w) as h, sum(n) over w as n_turns, max(turn) over (partition by conv_id) as last
      from g window w as (partition by conv_id order by turn)),
f as (select min(conv_id) as conv_id, any_value(n_turns) as n_turns, count(*) as n_copies, h from p where turn = last group by h),
k as (select conv_id, n_turns, n_copies from f where h not in (select h from p where turn < last))
select k.conv_id, cast(k.n_turns as bigint) as n_turns, k.n_copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by turn, role, text) as rendered
from k join t on k.conv_id is not distinct from t.conv_id group by 1, 2, 3
"""
