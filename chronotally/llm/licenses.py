"""License scans with a positional rare-token index (operator 4). DataFrame functions only.

Notices and phrases are templates of words, each with a mandatory key phrase. The index holds, for every template, its
positions with the rarest word first, by document frequencies of the licence words over the corpus (their IDF).

1. A file's licence words are looked up; a template is a candidate if the file has all words of its key phrase and
   enough of its words at all.
2. Of a candidate the file's highest-IDF words are looked up: of c template positions whose words the file has, ``need``
   must agree at a place, so that any c - need + 1 of them hold at least one that agrees there. The rarest ones are
   taken; where they stand in the file, their postings give the places at which the template may begin.
3. At each such place the template's positions are intersected with the file's words by relative position; it counts if
   at least ``need`` agree and the key phrase stands whole.

The IDF so decides which words of a file are looked up, and how few places are looked at, but no result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrase -> label; every place of one counts.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Fixed values: (label, notice, key phrase in it), from the licences' own texts.
NOTICES = [
    ("agpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "apache license version 2 0 the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "must retain the above copyright notice"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gnu general public license as published"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "for any purpose with or without fee"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "deal in the software without restriction"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
]
#: Share of a notice's words that must stand at their relative positions.
COVERAGE = 0.75


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key_at: int
    n_key: int
    base: bool

    @property
    def keys(self) -> tuple[str, ...]:
        return self.words[self.key_at : self.key_at + self.n_key]

    @property
    def need(self) -> int:
        """Words that must agree at a place."""
        return len(self.words) if self.base else math.ceil(COVERAGE * len(self.words) - 1e-9)


def templates() -> list[Template]:
    out = []
    for label, notice, key, base in [(b, a, a, True) for a, b in BASE.items()] + [(*x, False) for x in NOTICES]:
        words, keys = tuple(notice.split()), tuple(key.split())
        at = next(i for i in range(len(words)) if words[i : i + len(keys)] == keys)
        out.append(Template(label, words, at, len(keys), base))
    return out


def vocabulary() -> list[str]:
    """The licence words: all words of all templates."""
    return sorted({w for t in templates() for w in t.words})


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _list(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def document_frequencies(docs: DataFrame) -> dict[str, int]:
    """Documents that contain each licence word; as many rows as there are licence words reach the driver."""
    found = docs.select(F.explode(F.array_intersect(words_of(F.col("text")), _list(vocabulary()))).alias("word")).groupBy("word").count()
    return dict.fromkeys(vocabulary(), 0) | {r["word"]: r["count"] for r in found.collect()}


def index(df: dict[str, int]) -> Column:
    """The templates as an array of structs; ``rarest`` holds a template's positions, the highest IDF first, ``keys`` its
    distinct key words in the same order."""
    rank = lambda w: (df.get(w, 0), w)
    rows = []
    for t in templates():
        rarest = sorted(range(len(t.words)), key=lambda j: (*rank(t.words[j]), j))
        rows.append(F.struct(
            F.lit(t.label).alias("label"), _list(t.words).alias("words"), _list(rarest).alias("rarest"), _list(sorted(set(t.keys), key=rank)).alias("keys"),
            F.lit(t.key_at).alias("key_at"), F.lit(t.n_key).alias("n_key"), F.lit(t.need).alias("need"), F.lit(t.base).alias("base"),
        ))
    return F.array(*rows)


def candidates(has: Column, df: dict[str, int]) -> Column:
    """Templates whose key words a file has, with ``looked``: the positions that are looked up in it; ``has`` are the
    file's licence words. Rare key words come first, so most templates end at the first word."""
    full = F.filter(index(df), lambda t: F.forall(t["keys"], lambda k: F.array_contains(has, k)))
    there = F.transform(full, lambda t: F.struct(t.alias("t"), F.filter(t["rarest"], lambda j: F.array_contains(has, F.get(t["words"], j))).alias("there")))
    enough = F.filter(there, lambda x: F.size(x["there"]) >= x["t"]["need"])
    return F.transform(enough, lambda x: x["t"].withField("looked", F.slice(x["there"], F.lit(1), F.size(x["there"]) - x["t"]["need"] + 1)))


def places(words: Column, found: Column) -> Column:
    """Places of the candidate templates: struct(label, base, p = where the first word stands or would stand, s = share of
    its words that agree)."""
    at = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    postings = lambda t, j: F.transform(F.filter(at, lambda x: x["w"] == F.get(t["words"], j)), lambda x: x["i"] - j)
    starts = lambda t: F.array_distinct(F.flatten(F.transform(t["looked"], lambda j: postings(t, j))))
    agree = lambda t, p: F.size(F.filter(t["words"], lambda w, j: F.coalesce(F.get(words, p + j) == w, F.lit(False))))
    whole = lambda t, p: F.slice(words, p + t["key_at"] + 1, t["n_key"]) == F.slice(t["words"], t["key_at"] + 1, t["n_key"])
    scored = lambda t: F.transform(starts(t), lambda p: F.struct(t["label"].alias("label"), t["base"].alias("base"), p.alias("p"), agree(t, p).alias("n")))
    right = lambda t: F.filter(F.filter(scored(t), lambda x: (x["n"] >= t["need"]) & (x["p"] + t["key_at"] >= 0)), lambda x: whole(t, x["p"]))
    share = lambda t: F.transform(right(t), lambda x: F.struct(x["label"].alias("label"), x["base"].alias("base"), x["p"].alias("p"), (x["n"] / F.size(t["words"]).cast("double")).alias("s")))
    return F.flatten(F.transform(found, share))


def scan(docs: DataFrame, df: dict[str, int] | None = None) -> DataFrame:
    """Scan every whole text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_places.

    ``df`` are the document frequencies of the licence words, counted over docs if not given. score is the best agreement
    of a template in the file (1 for a base phrase, 0 without a place). A null or empty text has no words, null places and
    '' labels. Rows are scanned each, repeated or not; a null doc_id stays null; further columns, whatever their names,
    are ignored; an empty table gives an empty result."""
    df = document_frequencies(docs) if df is None else df
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    rows = rows.withColumn("has", F.array_intersect("words", _list(vocabulary())))
    rows = rows.withColumn("found", F.when(F.size("has") > 1, candidates(F.col("has"), df)))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(F.size("found") > 0, places(F.col("words"), F.col("found"))).alias("every"))
    base = F.transform(F.filter("every", lambda x: x["base"]), lambda x: x["p"])
    names = lambda some: F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(some, lambda x: x["label"]))), ","), F.lit(""))
    size = lambda some: F.coalesce(F.size(some), F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "n_words", F.greatest(size(base), F.lit(0)).alias("n_base"), F.array_min(base).cast("long").alias("first_word"), F.array_max(base).cast("long").alias("last_word"),
        names(F.filter("every", lambda x: x["base"])).alias("base_labels"), names(F.col("every")).alias("labels"),
        F.coalesce(F.array_max(F.transform("every", lambda x: x["s"])), F.lit(0.0)).alias("score"), F.greatest(size(F.col("every")), F.lit(0)).alias("n_places"),
    )


def _sql() -> str:
    letters, known = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", templates()
    rows = []
    for t in known:
        rows.append(f"({t.label!r}, {list(t.words)!r}, {t.key_at}, {list(t.keys)!r}, {t.need}, {str(t.base).lower()})")
    return f"""
with d as (select row_number() over () as row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '{WORD}') as w from documents),
t(label, words, key_at, keys, need, base) as (values {", ".join(rows)}),
k as (select row_no, w, t.*, unnest(range(1, len(w) - len(keys) + 2)) as k0 from d join t on list_has_all(w, keys)),
q as (select row_no, w, label, words, need, base, k0 - 1 - key_at as p from k where w[k0 : k0 + len(keys) - 1] = keys),
f as (select *, len(list_filter(range(1, len(words) + 1), lambda j: p + j >= 1 and p + j <= len(w) and w[greatest(p + j, 1)] = words[j])) as n from q),
g as (select row_no, count(*) filter (where base) as n_base, min(p) filter (where base) as first_word, max(p) filter (where base) as last_word,
             string_agg(distinct label, ',' order by label) filter (where base) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(n / len(words)::double) as score, count(*) as n_places
      from f where n >= need group by 1)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score, coalesce(n_places, 0) as n_places
from d left join g using (row_no)
"""


SQL = _sql()
