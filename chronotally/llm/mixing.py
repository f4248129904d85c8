"""Mixing sources to target weights by Poisson replication (operator 9).

A source that holds n of N documents and shall hold the share w of the mix gets the mean repetition rate
w * N / n. Each document draws its count by inverting the Poisson distribution at a uniform number hashed
from (seed, doc_id), is exploded by it, and the copies are put in the order of a second hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.llm.common import as_row, checkpointed, join_lookup, with_columns

SEED = "mix-1"
#: Larger rates are drawn as sums of independent Poisson counts of at most this rate.
LARGEST_RATE = 32.0


def uniform(*key: Column) -> Column:
    """52 hash bits of the key as a number in [0, 1)."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *key)), 1, 13), 16, 10).cast("long")
    return bits / F.lit(float(2**52))


def rates(docs: DataFrame, weights: DataFrame | None = None, *, size: float = 1.0) -> DataFrame:
    """source, n_docs, rate: the mean number of copies of a document. ``weights`` (source, weight) default to the
    square roots of the sources' sizes. The mix has size * (number of documents) rows in the mean."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        weighted = counts.withColumn("weight", F.sqrt(F.col("n_docs").cast("double")))
    else:
        weighted = counts.join(weights.select("source", F.col("weight").cast("double").alias("weight")), "source", "left").fillna(0.0, ["weight"])
    totals = weighted.agg(F.sum("n_docs").alias("all_docs"), F.sum("weight").alias("all_weight"))
    share = F.col("weight") / F.col("all_weight") * F.lit(float(size)) * F.col("all_docs")
    return weighted.crossJoin(F.broadcast(totals)).select("source", "n_docs", (share / F.col("n_docs")).alias("rate"))  # one row on the right


def cumulative(rate: Column) -> Column:
    """P(count <= 0), P(count <= 1), ... of a Poisson distribution, up to where the rest is below a double's precision."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))
    step = lambda s, k: F.struct((s["p"] * rate / k).alias("p"), F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * rate / k)).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["cdf"])


def _drawn(docs: DataFrame, weights: DataFrame | None, seed: str, size: float) -> DataFrame:
    """row (all columns of a document), rate and copy, a row per copy."""
    found = checkpointed(rates(docs, weights, size=size))
    parts = F.greatest(F.ceil(F.col("rate") / LARGEST_RATE), F.lit(1)).cast("int")
    lookup = found.select(F.col("source").alias("_source"), "rate", parts.alias("parts"), cumulative(F.col("rate") / parts).alias("cdf"))
    rows = docs.select(as_row(docs), F.coalesce("source", F.lit("")).alias("_source"))
    rows = join_lookup(rows, lookup, "_source", F.col("row.doc_id"), found.count() * 64)
    key = F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null"))
    draw = lambda j: F.size(F.filter("cdf", lambda c: c <= uniform(F.lit(seed), key, j.cast("string"))))
    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("parts")), draw), F.lit(0), lambda a, b: a + b)
    rows = rows.select("row", "rate", total.alias("n")).where("n > 0")
    return rows.select("row", "rate", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))


def copies(docs: DataFrame, weights: DataFrame | None = None, *, seed: str = SEED, size: float = 1.0) -> DataFrame:
    """The documents, each as often as drawn, with rate and copy (from 1), in no particular order.

    A null source counts as ''. A null doc_id draws like the text 'null'; repeated rows of one doc_id draw the
    same count. A source without a weight gets no copies. Other columns pass through, whatever their names; input columns
    rate and copy are replaced. An empty table gives an empty result."""
    return _drawn(docs, weights, seed, size).select(*with_columns(docs.columns, {"rate": F.col("rate"), "copy": F.col("copy")}, "row"))


def mix(docs: DataFrame, weights: DataFrame | None = None, *, seed: str = SEED, size: float = 1.0, counted: bool = True) -> DataFrame:
    """``copies`` in a global random order that only depends on seed, doc_id and copy; without ``counted`` the columns
    are those of docs, unchanged."""
    rows = _drawn(docs, weights, seed, size).orderBy(F.xxhash64(F.lit(seed), F.col("row.doc_id"), F.col("copy")), "row.doc_id", "copy")
    return rows.select(*with_columns(docs.columns, {"rate": F.col("rate"), "copy": F.col("copy")} if counted else {}, "row"))


SQL = f"""
with c as (select coalesce(source, '') as source, count(*) as n_docs, sqrt(count(*)::double) as weight from documents group by 1),
r as (select source, weight / sum(weight) over () * sum(n_docs) over () / n_docs as rate from c),
m as (select source, rate, greatest(ceil(rate / {LARGEST_RATE}), 1)::int as parts from r),
k as (select source, rate, parts, unnest(range(0, ceil(rate / parts + 12 * sqrt(rate / parts) + 24)::bigint + 1)) as k from m),
f as (select source, rate, parts, k, sum(exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1))) over (partition by source order by k) as cdf from k),
u as (select doc_id, d.source, text, lang, n_chars, row_no, m.rate, coalesce(d.source, '') as s, j,
             ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, 'null') || ':' || j), 1, 13))::bigint / {2**52}::double as u
      from (select row_number() over () as row_no, doc_id, source, text, lang, n_chars from documents) d join m on coalesce(d.source, '') = m.source, unnest(range(1, m.parts + 1)) as g(j)),
n as (select u.doc_id, u.source, u.text, u.lang, u.n_chars, u.row_no, u.rate, (select count(*) from f where f.source = u.s and f.cdf <= u.u) as n from u)
select doc_id, text, lang, source, n_chars, rate, unnest(range(1, n + 1))::int as copy
from (select row_no, doc_id, text, lang, source, n_chars, rate, sum(n)::bigint as n from n group by all)
"""
