"""The license scan against a search of every passage at every word."""

import random
import re

import pytest

from seqframe.llm import licenses as L

MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""


def words(text):
    return re.findall(L.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, known):
    w, found = words(text), L.lines(known)
    stand = []
    for k, x in enumerate(found):
        for start in range(-len(x.words), len(w)):
            m = sum(0 <= start + j < len(w) and w[start + j] == y for j, y in enumerate(x.words))
            if m >= x.need:
                stand.append((k, start, m))
    bases = list(L.BASE.values())
    own = [(k, s) for k, s, _ in stand if k < len(bases)]
    labels, score = set(), 0.0
    for n, licence in enumerate(known):
        mine = [k for k, x in enumerate(found) if x.licence == n]
        ranges = lambda k: {(s - found[k].offset) // L.SLACK + e for j, s, _ in stand if j == k for e in (0, 1)}  # noqa: B023, E731
        common = set.intersection(*[ranges(k) for k in mine if found[k].mandatory])
        total = sum(max((m for j, s, m in stand if j == k and common & {(s - found[k].offset) // L.SLACK, (s - found[k].offset) // L.SLACK + 1}), default=0) for k in mine)
        share = total / sum(len(found[k].words) for k in mine)
        if share >= L.SHARE:
            labels.add(licence.label)
            score = max(score, share)
    starts = [s for _, s in own]
    return len(w), len(own), min(starts, default=None), max(starts, default=None), ",".join(sorted({bases[k] for k, _ in own})), ",".join(sorted(labels)), score


def texts():
    rng = random.Random(5)
    vocabulary = sorted({w for x in L.lines(L.licenses()) for w in x.words})[:40] + ["gnu", "general", "public", "license", "cc", "by", "mit", "apache", "É"]
    out = [" ".join(rng.choices(vocabulary[-12:], k=60)) for _ in range(12)]
    phrases = [p.text for x in L.licenses() for p in x.passages]
    for _ in range(15):
        w = " ".join(rng.choice(phrases) if rng.random() < 0.5 else rng.choice(vocabulary) for _ in range(12)).split()
        for _ in range(4):
            w[rng.randrange(len(w))] = "other"
        out.append(" ".join(w))
    odd = ["", None, " .. ", "GNU General\nPublic  License", "cc-by cc by", "license version 2 0 mit", "MITLicense", "a mit license, mit license", MIT, MIT.replace("Software", "Work"), "x " * 30 + MIT[200:], "cc by " * 40]
    return out + odd


def test_equals_brute_force(spark):
    all_texts = texts()
    rows = [(k, t, 7, "c", "f") for k, t in enumerate(all_texts)] + [(None, "CC BY", 7, "c", "f"), (0, all_texts[0], 7, "c", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, places string, found string")
    got = L.digest(L.scan(docs)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()
    assert len(got) == len(rows)
    for r in got:
        text = "CC BY" if r["doc_id"] is None else all_texts[r["doc_id"]]
        assert tuple(r)[1:] == pytest.approx(brute(text, L.licenses())), text


def test_notices_are_found_with_gaps_and_not_elsewhere(spark):
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    cases = {MIT: "mit", bsd: "bsd", "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0", "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc,cc-by-nc-4.0", "This permission notice is not a license of any kind.": "", MIT[250:]: "", "permission is hereby granted " * 9: ""}
    docs = spark.createDataFrame([(t,) for t in cases], "text string")
    rows = L.digest(L.scan(docs.withColumn("t", docs.text)))
    assert {r["t"]: r["labels"] for r in rows.collect()} == cases


def test_words_of_highest_idf_are_looked_up():
    found = L.lines(L.licenses())
    df = {"mit": 500, "license": 3, "gnu": 1, "general": 9}
    index = L.postings(found, df)
    assert [[x.words[i] for i in at] for x, at in zip(found[:4], index[:4], strict=True)][3] == ["license"]
    for x, at in zip(found, index, strict=True):
        assert len(at) == len(x.words) - x.need + 1
        assert max(df.get(x.words[i], 0) for i in at) <= min([df.get(x.words[i], 0) for i in range(len(x.words)) if i not in at], default=10**9)


def test_a_very_long_text_an_empty_table_and_bad_licences(spark):
    long = "license " * 100_000 + "mit license " + "and " * 100_000 + "gnu general public license"
    rows = [(1, long)]
    r = L.digest(L.scan(spark.createDataFrame(rows, "doc_id long, text string"))).first()
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == (200_006, 2, 100_000, 200_002, "gpl,mit", "gpl,mit")
    assert L.digest(L.scan(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
    for bad in ((), (L.License("x", (L.Passage("..."),)),), (L.License("x", (L.Passage("a b", False),)),), (L.License("x", (L.Passage("a " * 30_000),)),)):
        with pytest.raises(ValueError):
            L.scan(spark.createDataFrame(rows, "doc_id long, text string"), known=bad)


def test_plan_is_one_projection(spark):
    docs = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    plan = L.digest(L.scan(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and plan.count("split(") == 1
