"""Phrases by prefix-free parsing against plain counts of all phrases."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from seqframe.llm import collocations as C

ODD = ["", None, " \t ", "...", "a", "É é É é", "a\tb  c", "x\x1cy x\x1cy", "日本 語 日本 語", "A.B.C", "no\rline\nhere"]


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for p in re.split("[.,;:!?\x0a-\x0d]", low) if (w := re.findall("[^\x20\x09]+", p))]


def counts(rows, longest):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            f.update((lang or "und", " ".join(w[i : i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    return f, n


def brute(rows, least, longest, top, cover=100):
    f, n = counts(rows, longest)
    frequent = {k for k, v in f.items() if v >= least and " " in k[1]}
    out = []
    for lang, phrase in frequent:
        a = f[lang, phrase]
        if any(lang == y and len(p) > len(phrase) and f" {phrase} " in f" {p} " and 100 * f[y, p] >= cover * a for y, p in frequent):
            continue
        w = phrase.split(" ")
        cuts = [(1000 * a * n[lang] // (f[lang, " ".join(w[:k])] * f[lang, " ".join(w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, phrase, a, f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])], n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, rank + 1, *x[1:]) for rank, x in enumerate(own[:top])]
    return sorted(ranked)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["É", "Zz"]
    passages = [" ".join(rng.choices(vocabulary, k=9)) for _ in range(3)]
    rows = []
    for k in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choices(vocabulary, k=rng.randrange(1, 9))) for _ in range(6)]
        rows.append(("".join(p + rng.choice([". ", "  ", ",", "\n", "\t"]) for p in parts), rng.choice(["en", "en", "de", None])))
    return rows + [rows[0]] * 30 + [(t, "en") for t in ODD] * 4 + [("the " * 700, "und"), ("", "")]


@pytest.mark.parametrize("period", [1, 3, 16])
def test_chunks_own_each_phrase_once(period):
    texts = [t for t, _ in corpus(1)]
    got = Counter()
    for chunks, last, _ in C.parse(pa.array([t or "" for t in texts]), 5, period):
        for chunk, end in zip(chunks.to_pylist(), last, strict=True):
            w = chunk.split(" ")
            for i in range(len(w) - (0 if end else 4)):
                got.update(" ".join(w[i : i + m]) for m in range(1, 6) if i + m <= len(w))
    want = Counter()
    for (_, phrase), v in counts([(t, "x") for t in texts], 5)[0].items():
        want[phrase] += v
    assert got == want


@pytest.mark.parametrize(("longest", "top", "cover", "period", "bits"), [(5, 2000, 100, 3, 1 << 26), (3, 7, 100, 16, 1 << 15), (5, 50, 60, 2, 1 << 15), (2, 2000, 100, 4, 1 << 20)])
def test_equals_plain_counts(spark, longest, top, cover, period, bits):
    rows = corpus(longest)
    docs = spark.createDataFrame([(t, x, 1, "c", 2) for t, x in rows], "text string, lang string, n int, chunk string, last int").repartition(5)
    found = C.mine(docs, 8, top, longest, cover, period=period, bits=bits)
    got = sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == brute(rows, 8, longest, top, cover) and len(got) > 10


def test_partial_sums_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(C, "HELD", 64)
    rows = corpus(9)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = sorted(tuple(r) for r in C.mine(docs, 8).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == brute(rows, 8, 5, 2000)


def test_products_past_64_bits(spark):
    big = [("x", 1, "a", 10**13), ("x", 1, "b", 3 * 10**12), ("x", 1, "c", 7 * 10**11), ("x", 2, "a b", 10**12 + 7), ("x", 2, "b c", 5 * 10**11 + 3), ("x", 3, "a b c", 3 * 10**11 + 1)]
    phrases = spark.createDataFrame(big, "lang string, words int, phrase string, n long")
    sizes = spark.createDataFrame([("x", 10**15 + 11)], "lang string, n long")
    f = {p: n for _, _, p, n in big}
    cut = lambda p, *at: min((1000 * f[p] * (10**15 + 11) // (f[p[: 2 * k - 1]] * f[p[2 * k :]]), k) for k in at)[0]
    got = {r["phrase"]: r["score"] for r in C.score_phrases(phrases, sizes).collect()}
    assert got == {"a b": cut("a b", 1), "b c": cut("b c", 1), "a b c": cut("a b c", 1, 2)}


def test_a_very_long_text_and_an_empty_table(spark):
    rng = random.Random(2)
    long = " ".join(rng.choice(["p", "q", "r", "ss"]) for _ in range(600_000))
    rows = [(long, "en"), (long[:1000], "en")]
    got = sorted(tuple(r) for r in C.mine(spark.createDataFrame(rows, "text string, lang string")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == brute(rows, 100, 5, 2000)
    assert C.mine(spark.createDataFrame([], "text string, lang string")).collect() == []
