"""Digests against plain search, and enzymes that share their sites."""

import random

import pytest

from seqframe.operators import digest

SEQS = [("s1", "ACGTTTGAATTC"), ("s2", "GGGGG"), ("s3", "acgacgt"), ("s4", "AC")]
ENZYMES = [("e1", "ACGT"), ("e2", "ACGT"), ("e3", "GAATTC"), ("e4", "GGG"), ("e5", "ccc"), ("e6", "ACG"), ("e6", "ACGT"), ("e7", "AC")]


def places(seq, site):
    seq, site = seq.upper(), site.upper()
    back = site[::-1].translate(str.maketrans("ACGT", "TGCA"))
    return {k + 1 for k in range(len(seq) - len(site) + 1) if seq[k : k + len(site)] in (site, back)}


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(SEQS, "seq_id string, seq string"), spark.createDataFrame(ENZYMES, "name string, site string")


def want():
    cuts = {(s, n, at) for s, seq in SEQS for n, site in ENZYMES for at in places(seq, site)}
    return cuts, {(s, n) for s, _ in SEQS for n, _ in ENZYMES} - {(s, n) for s, n, _ in cuts}


def test_digest_and_counts(spark, tables):
    cuts, missing = want()
    assert {tuple(r) for r in digest.digest(*tables).collect()} == cuts
    counts = digest.cut_counts(*tables).collect()
    assert {r["name"]: r["n_cuts"] for r in counts} == {n: sum(c[1] == n for c in cuts) for n in {c[1] for c in cuts}} and len(counts) == len({c[1] for c in cuts})
    assert sorted(map(tuple, digest.not_cutting(*tables).collect())) == sorted(missing)
    assert {r["seq_id"]: r["n"] for r in digest.not_cutting_counts(*tables).collect()} == {s: sum(m[0] == s for m in missing) for s in {m[0] for m in missing}}


def test_enzymes_with_one_site_are_looked_up_once(spark, tables):
    many = spark.range(5000).selectExpr("concat('x', id) as name", "'ACGT' as site")
    assert digest._site_cuts(tables[0], digest.site_classes(many), "seq_id").count() == 3 - 1
    assert {r["n_cuts"] for r in digest.cut_counts(tables[0], many).collect()} == {2}
    assert {r["seq_id"]: r["n"] for r in digest.not_cutting_counts(tables[0], many).collect()} == {"s2": 5000, "s4": 5000}


def test_sequences_are_looked_through_in_their_rows(spark):
    rng = random.Random(3)
    seqs = [(f"s{k}", "".join(rng.choices("ACGTacgtN", k=rng.randint(0, 40)))) for k in range(60)] + [("none", None), ("empty", "")]
    sites = ["ACGT", "GGCC", "ANNT", "RGCY", "TTA", "acg", "", None]
    enzymes = [(f"e{k}", sites[k % 8]) for k in range(24)] + [("two", "ACGT"), ("two", "GGA")]
    s, e = spark.createDataFrame(seqs, "seq_id string, seq string"), spark.createDataFrame(enzymes, "name string, site string")
    cutting = {(r["seq_id"], r["name"]) for r in digest.digest(s, e).select("seq_id", "name").distinct().collect()}
    want = {(i, n) for i, _ in seqs for n, _ in enzymes} - cutting
    assert {(r["seq_id"], r["name"]) for r in digest.not_cutting(s, e).collect()} == want
    counts = digest.not_cutting_counts(s, e)
    assert {r["seq_id"]: r["n"] for r in counts.collect()} == {i: sum(x == i for x, _ in want) for i in {x for x, _ in want}}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "collect_set(site" not in plan
    few = digest.digest(s, e)
    plain, digest.SENT_WORDS = digest.SENT_WORDS, 0
    try:
        assert sorted(digest.digest(s, e).collect()) == sorted(few.collect())
    finally:
        digest.SENT_WORDS = plain
