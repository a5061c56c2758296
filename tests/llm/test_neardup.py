"""Near duplicates against brute force on small fixtures."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from seqframe.llm import neardup


def bag(text, n=5):
    import re

    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def jaccard(a, b):
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def make_texts(seed, families=12, copies=6, words=(6, 300)):
    rng = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(400)]
    out = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.randint(*words))
        out.append(" ".join(base))
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            out.append(" ".join(text))
    return out


def brute_groups(texts):
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and jaccard(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    groups = {}
    for k in range(len(texts)):
        groups.setdefault(find(k), set()).add(k)
    return {frozenset(g) for g in groups.values()}


def test_signature_agreement_estimates_weighted_jaccard():
    a = " ".join(f"x{k % 170}" for k in range(400))
    b = " ".join(f"x{k % 170}" if k < 350 else f"y{k}" for k in range(400))
    _, cells, first = neardup.weighted_sets(pa.array([a, b, "", "one two"]))
    kept = neardup.signatures(cells, first, 4000)
    assert abs((kept[0] == kept[1]).mean() - jaccard(bag(a), bag(b))) < 0.04
    assert (kept[2] == np.iinfo(np.uint64).max).all() and (kept[3] != np.iinfo(np.uint64).max).all()


def test_signatures_do_not_depend_on_company():
    texts = make_texts(1)
    _, cells, first = neardup.weighted_sets(pa.array(texts))
    together = neardup.signatures(cells, first)
    for k in (0, 5, 17):
        _, own, at = neardup.weighted_sets(pa.array([texts[k]]))
        assert (neardup.signatures(own, at)[0] == together[k]).all()


@pytest.mark.parametrize("seed", [3, 4])
def test_groups_equal_brute_force(spark, seed):
    texts = make_texts(seed) + ["", None, "", "short text", "Short  TEXT!", "other"]
    docs = spark.createDataFrame([(k, t, "x", k) for k, t in enumerate(texts)], "doc_id long, text string, node string, n long")
    documents, _ = neardup.near_duplicates(docs)
    found = {}
    for row in neardup.group_classes(documents).collect():
        found.setdefault(row["class_id"], set()).add(row["doc_id"])
    assert {frozenset(g) for g in found.values()} == brute_groups(texts)


def test_deduplicate_keeps_one_of_each_group(spark):
    texts = make_texts(5, families=4)
    rows = [(k, t) for k, t in enumerate(texts)] + [(0, texts[0]), (0, texts[0]), (900, ""), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"], r["text"] or "") for r in neardup.deduplicate(docs).collect())
    groups = brute_groups(texts)
    assert kept == sorted([(min(g), texts[min(g)]) for g in groups] + [(900, ""), (901, "")])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.deduplicate(docs).collect() == []
