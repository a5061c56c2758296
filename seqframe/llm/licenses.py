"""License scan: a positional index of the rarest words of licence passages, all in column functions.

A licence is a set of passages, each with its offset in the licence's text; a passage stands at a place of a file where at
least ``need`` of its words are in position. How rare a licence word is, is counted over all documents (``rarity``). Of each passage the
index holds only the ``len - need + 1`` words of highest IDF: a place that has ``need`` words in position has one of
these, so nothing is lost (``postings``). A file's words are looked up there; the posting's position gives where
the passage would begin; that place counts if ``need`` words agree, and it is made by the first posting that agrees, so once.

A licence is found where its mandatory passages lie at the same relative position, give or take ``SLACK`` words, and the words in
position of its passages that lie there make up ``SHARE`` of all its words. The score is that share, the greatest of
the licences found, 0 without any.

The scan is a projection of the documents: no shuffle, no row but the documents' own. Only the counts of licence
words are aggregated before. The table of licences is a parameter; it is part of the plan and limited to MAX_WORDS words.

Null texts are empty: no words, no label, null places. Rows that repeat, null ids and extra columns go along. A label that several licences give
counts once. An empty table gives an empty result. A new column replaces one of the same name. A text is worked on whole, however long.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import quoted

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Passages of a licence may be so many words nearer or farther than in its text (a name, a copyright line, a list mark).
SLACK = 40
#: Least share of a licence's words that must be in position.
SHARE = 0.6
#: Share of a passage's words that must be in position, where it isn't exact.
NEAR = 0.8
#: Words of all licences together at most.
MAX_WORDS = 20_000


@dataclass(frozen=True)
class Passage:
    """Words of a licence, from word ``offset`` of its text on. exact: every word must be in position."""

    text: str
    mandatory: bool = True
    exact: bool = True
    offset: int = 0


@dataclass(frozen=True)
class License:
    label: str
    passages: tuple[Passage, ...]


#: The phrases whose places are counted, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Names and notices of public licences.
NAMES = {
    "gnu general public license version 2": "gpl-2.0", "gnu general public license v2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0", "gnu general public license v3": "gpl-3.0",
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl", "apache license version 2 0": "apache-2.0", "mozilla public license": "mpl",
    "eclipse public license": "epl", "boost software license": "bsl", "bsd license": "bsd", "isc license": "isc", "artistic license": "artistic",
    "sil open font license": "ofl", "open data commons": "odc", "european union public licence": "eupl",
    "cc by 4 0": "cc-by-4.0", "cc by nc": "cc-by-nc", "cc by nc 4 0": "cc-by-nc-4.0", "cc by sa": "cc-by-sa", "cc by sa 4 0": "cc-by-sa-4.0", "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd", "creative commons attribution": "cc-by", "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa", "creative commons zero": "cc0", "cc0 1 0": "cc0", "all rights reserved": "all-rights-reserved",
    "released into the public domain": "public-domain", "do what the fuck you want to public license": "wtfpl",
}

#: Longer notices. The first passages are key phrases, word for word; the others may differ in a few words.
NOTICES = (
    License("mit", (
        Passage("permission is hereby granted free of charge to any person obtaining a copy"),
        Passage("of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", False, False, 14),
        Passage("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", False, False, 65),
        Passage("the software is provided as is without warranty of any kind express or implied", False, False, 86),
    )),
    License("bsd", (
        Passage("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
        Passage("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", False, False, 21),
    )),
    License("bsd-3-clause", (
        Passage("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
        Passage("may be used to endorse or promote products derived from this software without specific prior written permission", True, False, 85),
    )),
    License("isc", (
        Passage("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
        Passage("provided that the above copyright notice and this permission notice appear in all copies", False, False, 20),
    )),
    License("apache-2.0", (
        Passage("licensed under the apache license version 2 0"),
        Passage("you may not use this file except in compliance with the license", True, False, 10),
        Passage("you may obtain a copy of the license at", False, False, 22),
    )),
    License("gpl", (
        Passage("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
        Passage("as published by the free software foundation", True, False, 22),
        Passage("either version 3 of the license or at your option any later version", False, False, 29),
    )),
    License("mpl-2.0", (Passage("this source code form is subject to the terms of the mozilla public license v 2 0", True, False),)),
    License("unlicense", (Passage("this is free and unencumbered software released into the public domain", True, False),)),
    License("zlib", (
        Passage("in no event will the authors be held liable for any damages arising from the use of this software", True, False),
        Passage("the origin of this software must not be misrepresented", True, True, 57),
    )),
)


def licenses() -> tuple[License, ...]:
    """The licences known: base phrases first, then names, then notices."""
    named = [License(label, (Passage(phrase),)) for phrase, label in [*BASE.items(), *NAMES.items()]]
    return (*named, *NOTICES)


def words(text: str | Column) -> Column:
    """A text's words, A-Z in lower case; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


@dataclass(frozen=True)
class Line:
    """A passage as it is looked up: number of its licence, words, least words in position."""

    licence: int
    words: tuple[str, ...]
    need: int
    mandatory: bool
    offset: int


def lines(known: tuple[License, ...]) -> list[Line]:
    out = []
    for number, licence in enumerate(known):
        if not any(p.mandatory for p in licence.passages):
            raise ValueError(f"{licence.label}: no passage is mandatory")
        for p in licence.passages:
            w = tuple(re.findall(WORD, p.text.translate(str.maketrans(UPPER, LOWER))))
            if not w:
                raise ValueError(f"{licence.label}: a passage without words")
            out.append(Line(number, w, len(w) if p.exact else -int(-NEAR * len(w) // 1), p.mandatory, p.offset))
    if sum(len(x.words) for x in out) > MAX_WORDS:
        raise ValueError(f"the licences have more than {MAX_WORDS} words")
    return out


def rarity(docs: DataFrame, text: str, known: tuple[License, ...]) -> dict[str, int]:
    """In how many documents each licence word is, counted over all of them; at most MAX_WORDS rows come back."""
    vocabulary = sorted({w for x in lines(known) for w in x.words})
    own = F.array_intersect(words(F.col(quoted(text))), F.array(*map(F.lit, vocabulary)))
    counted = docs.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    return {r["word"]: r["df"] for r in counted.collect()}


def postings(found: list[Line], df: dict[str, int]) -> list[list[int]]:
    """Of each passage the positions of its rarest words, the rarest first: one more than may be out of position."""
    return [sorted(range(len(x.words)), key=lambda i: (df.get(x.words[i], 0), i))[: len(x.words) - x.need + 1] for x in found]


def _ints(values) -> Column:
    return F.array(*[F.lit(int(v)) for v in values])


def _literal(text: list[str]) -> Column:
    return F.array(*map(F.lit, text))


def places(held: Column, found: list[Line], index: list[list[int]]) -> Column:
    """array<struct<line, start, matched>>: where passages stand among the words held, each once.

    start may be below 0, where a passage's first words are cut off.
    """
    entries = F.array(*[F.struct(F.lit(x.words[i]).alias("word"), F.lit(k).alias("line"), F.lit(i).alias("at"), F.lit(rank).alias("rank")) for k, x in enumerate(found) for rank, i in enumerate(index[k])])
    passages = F.array(*[F.struct(_literal(list(x.words)).alias("words"), F.lit(x.need).alias("need"), _ints(index[k]).alias("index")) for k, x in enumerate(found)])
    looked_up = sorted({x.words[i] for k, x in enumerate(found) for i in index[k]})
    hits = F.filter(F.transform(held, lambda w, i: F.when(w.isin(looked_up), i)), lambda i: i.isNotNull())
    begun = F.flatten(F.transform(hits, lambda i: F.transform(F.filter(entries, lambda e: e["word"] == F.get(held, i)), lambda e: F.struct(e["line"].alias("line"), e["rank"].alias("rank"), (i - e["at"]).alias("start")))))

    def verified(c: Column) -> Column:
        own = F.get(passages, c["line"])
        agrees = lambda j: F.coalesce(F.get(held, c["start"] + j) == F.get(own["words"], j), F.lit(False))
        matched = F.size(F.filter(F.sequence(F.lit(0), F.size(own["words"]) - 1), agrees))
        earlier = F.exists(F.slice(own["index"], F.lit(1), c["rank"]), agrees)
        return F.struct(c["line"].alias("line"), c["start"].alias("start"), F.when(~earlier & (matched >= own["need"]), matched).alias("matched"))

    return F.filter(F.transform(begun, verified), lambda c: c["matched"].isNotNull())


def shares(stand: Column, known: tuple[License, ...], found: list[Line]) -> Column:
    """array<struct<label, share>>: the licences found among the places, with the share of their words that is in position."""
    table = F.array(*[
        F.struct(
            F.lit(licence.label).alias("label"),
            F.lit(sum(len(x.words) for x in found if x.licence == n)).alias("words"),
            F.array(*[F.struct(F.lit(k).alias("line"), F.lit(x.offset).alias("offset"), F.lit(x.mandatory).alias("mandatory")) for k, x in enumerate(found) if x.licence == n]).alias("lines"),
        ) for n, licence in enumerate(known)
    ])

    # a place lies in two ranges of origins, so that origins up to SLACK apart share one
    def ranges(line: Column) -> Column:
        first = lambda c: F.floor((c["start"] - line["offset"]) / SLACK)
        own = F.filter(stand, lambda c: c["line"] == line["line"])
        return F.flatten(F.transform(own, lambda c: F.array(first(c), first(c) + 1)))

    def share(licence: Column) -> Column:
        mandatory = F.transform(F.filter(licence["lines"], lambda x: x["mandatory"]), lambda x: F.array_distinct(ranges(x)))
        common = F.aggregate(mandatory, F.get(mandatory, F.lit(0)), F.array_intersect)

        def best(line: Column) -> Column:
            first = lambda c: F.floor((c["start"] - line["offset"]) / SLACK)
            here = F.filter(stand, lambda c: (c["line"] == line["line"]) & (F.array_contains(common, first(c)) | F.array_contains(common, first(c) + 1)))
            return F.coalesce(F.array_max(F.transform(here, lambda c: c["matched"])), F.lit(0))

        total = F.aggregate(licence["lines"], F.lit(0), lambda n, line: n + best(line))
        # a licence of one passage needs no common range
        alone = F.coalesce(F.array_max(F.transform(F.filter(stand, lambda c: c["line"] == licence["lines"][0]["line"]), lambda c: c["matched"])), F.lit(0))
        return F.struct(licence["label"].alias("label"), (F.when(F.size(licence["lines"]) == 1, alone).otherwise(F.when(F.size(common) > 0, total).otherwise(0)) / licence["words"]).alias("share"))

    return F.filter(F.transform(table, share), lambda x: x["share"] >= SHARE)


def scan(docs: DataFrame, text: str = "text", known: tuple[License, ...] | None = None) -> DataFrame:
    """docs, without the text, with n_words, places (all, array<struct<line, start, matched>>) and found (array<struct<label, share>>)."""
    known = licenses() if known is None else known
    if not known:
        raise ValueError("no licences are given")
    looked = lines(known)
    index = postings(looked, rarity(docs, text, known))
    new = {"n_words", "places", "found", "__words"}
    kept = [F.col(quoted(c)) for c in docs.columns if c != text and c.lower() not in new]
    held = docs.select(*kept, words(F.col(quoted(text))).alias("__words"))
    stand = held.select(*kept, F.size("__words").cast("long").alias("n_words"), places(F.col("__words"), looked, index).alias("places"))
    none = F.array().cast("array<struct<label:string,share:double>>")
    return stand.withColumn("found", F.when(F.size("places") > 0, shares(F.col("places"), known, looked)).otherwise(none))


def digest(found: DataFrame, base: int = len(BASE)) -> DataFrame:
    """found with the columns of the report: places of the first ``base`` licences (one passage each) and all labels."""
    own = F.filter("places", lambda c: c["line"] < base)
    starts = F.transform(own, lambda c: c["start"])
    table = _literal(list(BASE.values()))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "*",
        F.size(own).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(F.transform(own, lambda c: F.get(table, c["line"]))).alias("base_labels"),
        joined(F.transform("found", lambda x: x["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )


def oracle(known: tuple[License, ...] | None = None) -> str:
    """DuckDB SQL that counts words in position for every word of every document and every passage, without an index."""
    known = licenses() if known is None else known
    found = lines(known)
    rows = ", ".join(f"({k}, {i}, '{w}')" for k, x in enumerate(found) for i, w in enumerate(x.words))
    heads = ", ".join(f"({k}, {x.licence}, {x.need}, {x.mandatory}, {x.offset})" for k, x in enumerate(found))
    labels = ", ".join(f"({n}, '{x.label}', {sum(len(y.words) for y in found if y.licence == n)}, {sum(y.licence == n for y in found)}, {sum(y.licence == n and y.mandatory for y in found)})" for n, x in enumerate(known))
    base = reduce(lambda a, b: f"{a}, {b}", [f"({k}, '{v}')" for k, v in enumerate(BASE.values())])
    return f"""
with docs as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
passage(line, i, word) as (values {rows}), head(line, licence, need, mandatory, shift) as (values {heads}),
licence(licence, label, n, lines, keys) as (values {labels}), base(line, label) as (values {base}),
held as (select r, unnest(w) as word, unnest(range(0, len(w))) as p from docs),
counted as (select r, line, p - i as start, count(*) as matched from held join passage using (word) group by r, line, p - i),
stand as (select counted.* from counted join head using (line) where matched >= need),
ranged as (select s.*, licence, mandatory, floor((start - shift) / {SLACK}) + unnest([0, 1]) as b from stand s join head using (line)),
common as (select r, licence, b from ranged join licence using (licence) where mandatory group by r, licence, b, keys having count(distinct line) = keys),
best as (select r, licence, line, max(matched) as m from ranged where exists (select 1 from common c where c.r = ranged.r and c.licence = ranged.licence and c.b = ranged.b) group by all),
share as (select r, label, sum(m) / max(n) as share from best join licence using (licence) group by r, licence, label having sum(m) / max(n) >= {SHARE}),
named as (select r, string_agg(distinct label, ',' order by label) as labels, max(share) as score from share group by r),
based as (select r, count(*) as n, min(start) as a, max(start) as b, string_agg(distinct label, ',' order by label) as labels from stand join base using (line) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_base, cast(a as bigint) as first_word, cast(b as bigint) as last_word,
       coalesce(based.labels, '') as base_labels, coalesce(named.labels, '') as labels, cast(coalesce(score, 0) as double) as score
from docs left join based using (r) left join named using (r)
"""
