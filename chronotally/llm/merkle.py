"""Merkle manifest of a dataset by bitmap-rank indexing (operator 13).

A leaf's place in its group is the rank of its id. Ids are kept as bitmaps: a row per group and 64-bit word that holds any
id (empty words are not stored), merged by bitwise or before the shuffle. Popcount directories say how many leaves lie before
every word: counts within blocks of 512 words, then of blocks, and so on up to the group. A leaf looks up its word and
counts the bits below its own, so leaves are placed without sorting. Keyed by place, 1,024 leaves at a time become a slot
array, which is reduced over ten levels at once; the arrays' tops are reduced in the same way until one node remains.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.llm.common import checkpointed, join_lookup

#: Bits of an id's place in its word, of a word's in its block, and of a slot's in its array.
WORD_BITS, BLOCK_BITS, SLOT_BITS = 6, 9, 10
#: The word of null ids: before all real ones, which are no less than -2^57.
NULL_WORD = -(2**62)
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """`-` for null, else byte count, `:` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in columns])


# places


def _below(rows: DataFrame, parent: str) -> DataFrame:
    """before: leaves of the same group and parent that lie below a node. A parent has at most 512 nodes."""
    w = Window.partitionBy("g", parent).orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))


def directory(words: DataFrame) -> DataFrame:
    """(g, node, n, ...) of words with before (leaves of the group below the word) and total (leaves of the group)."""
    low, high = words.where(F.col("node") != NULL_WORD).agg(F.min("node"), F.max("node")).first()
    if low is None:
        low = high = 0
    nodes, below = words, []
    while (high >> BLOCK_BITS) - (low >> BLOCK_BITS) > 0:  # an end: all words of a group in one block
        nodes = nodes.withColumn("parent", F.shiftright("node", BLOCK_BITS))
        below.append(_below(nodes, "parent"))
        nodes = nodes.groupBy("g", F.col("parent").alias("node")).agg(F.sum("n").alias("n"))
        low, high = low >> BLOCK_BITS, high >> BLOCK_BITS
        if high - low < 1 << BLOCK_BITS:
            break
    found = _below(nodes.withColumn("parent", F.lit(0)), "parent").drop("parent")
    found = found.join(nodes.groupBy("g").agg(F.sum("n").alias("total")), "g")
    for lower in reversed(below):
        upper = found.select("g", F.col("node").alias("parent"), F.col("before").alias("above"), "total")
        found = lower.join(upper, ["g", "parent"]).withColumn("before", F.col("before") + F.col("above")).drop("parent", "above")
    return found


def ranked(ids: DataFrame) -> DataFrame:
    """ids (g, id, c: leaves with that id, ...; a row per g and id) with slot, the number of the group's leaves with smaller ids
    (null ids come first), and total."""
    ids = ids.withColumns({"node": F.coalesce(F.shiftright("id", WORD_BITS), F.lit(NULL_WORD)), "bit": F.coalesce(F.col("id").bitwiseAND(63), F.lit(0)).cast("int")})
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    more = F.collect_list(F.when(F.col("c") > 1, F.struct("bit", (F.col("c") - 1).alias("more"))))  # 64 entries at most, mostly none
    words = checkpointed(ids.groupBy("g", "node").agg(F.bit_or(one).alias("bits"), F.sum("c").alias("n"), more.alias("more")))
    found = ids.join(directory(words).drop("n"), ["g", "node"])
    repeats = F.aggregate(F.filter("more", lambda m: m["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda a, m: a + m["more"])
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("bit")))
    smaller = F.bit_count(F.col("bits").bitwiseAND(lower)).cast("long")
    return found.withColumn("slot", F.col("before") + smaller + repeats).drop("node", "bit", "bits", "before", "more")


def placed(leaves: DataFrame) -> DataFrame:
    """leaves (g, id, leaf, carried; any number of an id) with slot and total. Leaves of one id are in the order of their hash,
    equal ones in any order."""
    alike = leaves.groupBy("g", "id", "leaf").agg(F.min("carried").alias("carried"), F.count("*").alias("m"))
    only = F.max(F.struct("leaf", "carried", "m")).alias("r")
    ids = ranked(alike.groupBy("g", "id").agg(F.sum("m").alias("c"), F.count("*").alias("kinds"), only))
    ids = checkpointed(ids)
    single = ids.where("kinds = 1").select("g", "id", "r.leaf", "r.carried", "r.m", "slot", "total")
    several = ids.where("kinds > 1").select(F.concat_ws(" ", "g", F.coalesce(F.col("id").cast("string"), F.lit("null"))).alias("gi"), F.col("slot").alias("first"), "total")
    n_several = several.count()
    if n_several:  # an id of several leaves: its leaves are ranked by 60 bits of their hash, by the same index
        key = F.concat_ws(" ", "g", F.coalesce(F.col("id").cast("string"), F.lit("null")))
        rows = join_lookup(alike.withColumn("gi", key), several, "gi", F.col("leaf"), n_several).where("first is not null")
        within = rows.select(F.col("gi").alias("g"), F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long").alias("id"), F.col("m").alias("c"), F.struct("g", "id", "leaf", "carried", "m", "first", "total").alias("r"))
        within = ranked(within).select("r.g", "r.id", "r.leaf", "r.carried", "r.m", (F.col("r.first") + F.col("slot")).alias("slot"), "r.total")
        single = single.unionByName(within)
    copies = F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("m") - 1))
    return single.select("g", "id", "leaf", "carried", copies.alias("slot"), "total")


# levels


def _up(nodes: Column) -> Column:
    """The next level: every two nodes' hash, the last one's alone if their number is odd."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), lambda i: digest(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))))


def _arrays(nodes: DataFrame) -> DataFrame:
    """g, array, slots (sorted), levels (of hashes, the top one last) of nodes (g, slot, leaf, total, ...): as many levels as
    the group still has, ten at most."""
    rest = [c for c in nodes.columns if c not in ("g", "slot", "total")]
    arrays = nodes.groupBy("g", F.shiftright("slot", SLOT_BITS).alias("array")).agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("slot", *rest))).alias("slots"))
    height = F.least(F.lit(SLOT_BITS), F.ceil(F.log2(F.col("total")) - 1e-9)).cast("int")
    steps = F.when(height > 0, F.sequence(F.lit(1), F.greatest(height, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    levels = F.aggregate(steps, F.array(F.transform("slots", lambda s: s["leaf"])), lambda found, _: F.concat(found, F.array(_up(F.element_at(found, -1)))))
    return arrays.withColumn("levels", levels)


def _siblings(slot: Column) -> Column:
    """sibling and whether it stands left, level by level, of a slot in its array."""
    place = lambda j: F.call_function("shiftright", slot.bitwiseAND((1 << SLOT_BITS) - 1).cast("int"), j)
    steps = F.slice("levels", 1, F.size("levels") - 1)
    found = F.transform(steps, lambda level, j: F.struct(F.get(level, place(j).bitwiseXOR(F.lit(1))).alias("sibling"), (place(j) % 2 == 1).alias("left")))
    return found


def paths(nodes: DataFrame) -> DataFrame:
    """nodes (g, slot, leaf, total, ...) with path (array of sibling, null if there is none, and left) and top, their group's
    last node. An array of 1,024 slots is one row; a group of n nodes takes ceil(log n / log 1024) rounds."""
    arrays = checkpointed(_arrays(nodes))
    several = arrays.agg(F.max("total")).first()[0] or 0
    top = F.element_at(F.element_at("levels", -1), 1)
    if several > 1 << SLOT_BITS:
        upper = arrays.select("g", F.col("array").alias("slot"), top.alias("leaf"), F.ceil(F.col("total") / (1 << SLOT_BITS)).cast("long").alias("total"))
        upper = paths(upper).select("g", F.col("slot").alias("array"), F.col("path").alias("above"), "top")
        arrays = arrays.join(upper, ["g", "array"])
    else:
        arrays = arrays.withColumns({"above": F.array().cast("array<struct<sibling:string,left:boolean>>"), "top": top})
    rows = arrays.select("g", "total", "levels", "above", "top", F.explode("slots").alias("s"))
    return rows.select("g", "s.*", "total", F.concat(_siblings(F.col("s.slot")), "above").alias("path"), "top")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    join = lambda h, s: digest(F.when(s["left"], F.coalesce(s["sibling"], F.lit(""))).otherwise(""), h, F.when(~s["left"], F.coalesce(s["sibling"], F.lit(""))).otherwise(""))
    return F.aggregate(path, start, join)


def manifest(docs: DataFrame, *, group: str = "lang", key: str = "doc_id", columns: Sequence[str] = COLUMNS, carried: Mapping[str, Column] | None = None) -> DataFrame:
    """key, group, slot (place in the group), leaf, path (siblings from the leaf to the root), subroot, root and the ``carried``
    columns of every row.

    Leaves of a group ascend by key, null keys first; rows of one key are in the order of their leaves' hashes, and repeated rows
    take neighbouring places. Nulls in any column are told from empty texts. A null group is a group of its own and the
    first. Texts are hashed whole and never shuffled. Other columns are ignored; an empty table gives an empty result."""
    g = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    extra = F.struct(*[c.alias(n) for n, c in (carried or {"none": F.lit(0)}).items()])
    leaves = checkpointed(docs.select(g.alias("g"), F.col(f"`{key}`").cast("long").alias("id"), leaf([F.col(f"`{c}`") for c in columns]).alias("leaf"), extra.alias("carried")))
    rows = checkpointed(paths(placed(leaves)))
    tops = rows.where("slot = 0").select("g", F.col("top").alias("leaf"))
    n_groups = tops.count()
    order = Window.partitionBy(F.lit(0)).orderBy("g")  # a row per group; strings are ordered by their bytes
    tops = tops.withColumns({"slot": F.row_number().over(order).cast("long") - 1, "total": F.lit(n_groups).cast("long")}).withColumn("g_name", F.col("g")).withColumn("g", F.lit(""))
    tops = paths(tops).select(F.col("g_name").alias("g"), F.col("path").alias("above"), F.col("top").alias("root"))
    rows = join_lookup(rows, tops, "g", F.col("slot"), n_groups)
    names = list(carried or {})
    return rows.select(
        F.col("id").alias(key), F.when(F.col("g") != "", F.substring("g", 2, 2**31 - 1)).cast(docs.schema[group].dataType).alias(group), "slot", "leaf",
        F.concat("path", "above").alias("path"), F.col("top").alias("subroot"), "root", *[F.col(f"carried.`{n}`").alias(n) for n in names],
    )


def audited(docs: DataFrame) -> DataFrame:
    """The query: every row's proof, and the root that its tampered or else its own leaf gives with the true siblings."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = F.when(F.coalesce(hit, F.lit(False)) & F.col("n_chars").isNotNull(), leaf([F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]))
    rows = manifest(docs, carried={"tampered": changed})
    proof = digest(F.array_join(F.transform(F.filter("path", lambda s: s["sibling"].isNotNull()), lambda s: s["sibling"]), ""))
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(column: str) -> str:
    return f"coalesce(strlen({column}::varchar) || ':' || {column}, '-')"


def _levels_sql(name: str, leaves: str, group: str) -> str:
    """Recursive part: the nodes (group, lvl, i, h, n nodes of the level) of trees over leaves (group, i, h, n)."""
    return f"""{name} as (select {group}, 0 as lvl, i, h, n from {leaves} union all
    select {group}, lvl + 1, i // 2, sha256(string_agg(h, '' order by i)), (any_value(n) + 1) // 2 from {name} where n > 1 group by {group}, lvl, i // 2)"""


def _path_sql(tree: str, leaves: str, group: str) -> str:
    """Siblings of every leaf, bottom up."""
    return f"""select a.{group} as {group}, a.i as i, list({{'sibling': s.h, 'place': (a.i >> l.lvl) & 1}} order by l.lvl) as path
    from {leaves} a join (select distinct {group}, lvl from {tree} where n > 1) l on l.{group} is not distinct from a.{group}
    left join {tree} s on s.{group} is not distinct from a.{group} and s.lvl = l.lvl and s.i = xor(a.i >> l.lvl, 1) group by a.{group}, a.i"""


_CRC = """xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
    lambda a, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295), 4294967295)"""
_FOLD = """lambda h, s: sha256(case when s.place = 1 then coalesce(s.sibling, '') else '' end || h || case when s.place = 0 then coalesce(s.sibling, '') else '' end)"""

SQL = f"""
with recursive f as (select doc_id, lang, {" || ".join(_field_sql(c) for c in ("doc_id", "source", "lang"))} as a, n_chars, {_field_sql("text")} as b, {_CRC} as crc from documents),
v as (select doc_id, lang, sha256(a || {_field_sql("n_chars")} || b) as leaf, case when crc % 7 = 0 then sha256(a || {_field_sql("(n_chars + 1)")} || b) end as tampered from f),
w as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, leaf as h, count(*) over (partition by lang) as n from v),
{_levels_sql("t", "w", "lang")},
u as (select 0 as one, lang, row_number() over (order by lang nulls first) - 1 as i, h, count(*) over () as n from t where n = 1),
{_levels_sql("r", "u", "one")},
p as ({_path_sql("t", "w", "lang")}),
q as ({_path_sql("r", "u", "one")}),
z as (select w.doc_id, w.leaf, u.h as subroot, (select h from r where n = 1) as root, coalesce(p.path, []) || coalesce(q.path, []) as path, coalesce(tampered, leaf) as start
      from w join u on u.lang is not distinct from w.lang left join p on p.lang is not distinct from w.lang and p.i = w.i left join q on q.i = u.i)
select doc_id, leaf, subroot, root, sha256(array_to_string([s.sibling for s in path if s.sibling is not null], '')) as proof_sha256,
       list_reduce(path, {_FOLD}, start) as folded_root, list_reduce(path, {_FOLD}, start) = root as verified
from z
"""
