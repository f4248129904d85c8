"""Line dedup by site-relative frequency (operator 3).

Pages are grouped by host; the share of a host's pages that contain a line is compared with a boilerplate
ratio, and lines above it are dropped from that host's pages. Copies of one page on a host count as one
page, so that a much copied page is not taken for boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.llm.common import as_row, checkpointed, join_lookup

#: Site boilerplate is put on pages by templates: the site's own, and those of its sections, authors or kinds of page. A
#: section's menu, footer or notice is on that section's pages only, so a site of some tens of sections shows it on a few
#: per cent of its pages. What an author writes is on one page, as copies of a page count once; a whole line that recurs
#: word for word on one distinct page in fifty comes from a template. A line on a single page never recurs, however few
#: pages the host has; on a host of under 100 pages a line on two of them exceeds the ratio.
MAX_RATIO = 0.02


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """A line without its outer spaces as 64 hash bits."""
    return F.xxhash64(F.trim(line))


def boilerplate(docs: DataFrame, *, host: str = "source", max_ratio: float = MAX_RATIO) -> DataFrame:
    """host, line (key), n_pages, host_pages of lines on more than max_ratio of the host's distinct pages and on two at least."""
    rows = docs.select(F.coalesce(F.col(host), F.lit("")).alias("host"), F.xxhash64("text").alias("page"), "text")
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), _key))
    counts = rows.select("host", "page", F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count_distinct("page").alias("n_pages"))
    totals = rows.where("text is not null").groupBy("host").agg(F.count_distinct("page").alias("host_pages"))
    return counts.where("n_pages > 1").join(totals, "host").where(F.col("n_pages") > F.col("host_pages") * F.lit(max_ratio))


def _marked(docs: DataFrame, host: str, max_ratio: float) -> DataFrame:
    """row (all columns of a document), text without boilerplate, n_lines, n_dropped.

    A host's list holds at most (lines of a page) / max_ratio entries; it is broadcast if the measured total is small
    and joined by salted host otherwise."""
    found = checkpointed(boilerplate(docs, host=host, max_ratio=max_ratio).select("host", "line"))
    lists = found.groupBy(F.col("host").alias("_host")).agg(F.collect_list("line").alias("bad"))
    rows = docs.select(as_row(docs), F.coalesce(F.col(host), F.lit("")).alias("_host"))
    rows = join_lookup(rows, lists, "_host", F.col("row"), found.count())
    rows = rows.select("row", _lines(F.col("row.text")).alias("lines"), "bad")
    rows = rows.select("row", "lines", F.array_intersect(F.transform("lines", _key), "bad").alias("here"))  # the page's own part of a long list
    bad = lambda x: (F.trim(x) != "") & F.array_contains("here", _key(x))
    some = F.size("here") > 0
    text = F.when(some, F.array_join(F.filter("lines", lambda x: ~bad(x)), "\n")).otherwise(F.col("row.text"))
    count = lambda a: F.greatest(F.coalesce(F.size(a), F.lit(0)), F.lit(0)).cast("long")
    return rows.select("row", text.alias("text"), count(F.filter("lines", lambda x: F.trim(x) != "")).alias("n_lines"), F.when(some, count(F.filter("lines", bad))).otherwise(F.lit(0).cast("long")).alias("n_dropped"))


def drop_boilerplate(docs: DataFrame, *, host: str = "source", max_ratio: float = MAX_RATIO) -> DataFrame:
    """The documents with boilerplate lines taken out of text, plus n_lines and n_dropped.

    Lines are compared without outer spaces; blank lines stay. A null text stays null with 0 lines; a text of
    boilerplate only becomes ''. Null hosts form a host of their own with ''. Repeated rows are kept. Other
    columns pass through, whatever their names; input columns n_lines and n_dropped are replaced; an empty table gives
    an empty result."""
    rows = _marked(docs, host, max_ratio)
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return rows.select(*[F.col("text").alias(c) if c.lower() == "text" else F.col(f"row.`{c}`") for c in kept], "n_lines", "n_dropped")


def cleaned(docs: DataFrame, *, host: str = "source", max_ratio: float = MAX_RATIO, length: str = "n_chars") -> DataFrame:
    """The documents with boilerplate lines taken out of text and ``length`` (if there is such a column) set anew where a
    line went; all other columns as they were."""
    n_chars = lambda c: F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col(f"row.`{c}`"))
    new = {"text": lambda c: F.col("text"), length: n_chars}
    return _marked(docs, host, max_ratio).select(*[new.get(c.lower(), lambda c: F.col(f"row.`{c}`"))(c).alias(c) for c in docs.columns])


SQL = f"""
with p as (select distinct coalesce(source, '') as host, text from documents where text is not null),
t as (select host, count(*) as host_pages from p group by host),
l as (select distinct host, text, trim(line) as line from (select host, text, unnest(string_split(text, chr(10))) as line from p) where trim(line) <> ''),
c as (select host, line, count(*) as n_pages from l group by host, line having count(*) > 1),
b as (select host, list(line) as bad from c join t using (host) where n_pages > host_pages * {MAX_RATIO}::double group by host),
d as (select doc_id, source, text, string_split(text, chr(10)) as lines, coalesce(bad, []) as bad from documents left join b on coalesce(source, '') = host)
select doc_id, source, case when text is not null then array_to_string(list_filter(lines, lambda x: not list_contains(bad, trim(x))), chr(10)) end as text,
       coalesce(len(list_filter(lines, lambda x: trim(x) <> '')), 0) as n_lines, coalesce(len(list_filter(lines, lambda x: list_contains(bad, trim(x)))), 0) as n_dropped
from d
"""
