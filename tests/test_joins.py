"""Tables from explode or a kernel are never broadcast, however small their sources look; votes of k-mers by hand."""

import random

from seqframe.operators import align, clusters, gaps


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def turned(seq):
    return seq[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_orient_by_votes(spark):
    rng = random.Random(5)
    refs = ["".join(rng.choice("ACGT") for _ in range(60)) for _ in range(20)]
    refs[1] = refs[0][:20] + turned(refs[0])[:25] + "ACGTACGTACGT"
    reads = [r[k : k + 30] if k % 2 else turned(r[k : k + 30]) for k, r in enumerate(refs)] + ["ACGTACGTACGTACGT", "ACGT", refs[0][:15] + turned(refs[2])[:20], "N" * 20]
    parts = lambda s: {s[i : i + 12] for i in range(len(s) - 11)}
    known = set().union(*map(parts, refs))
    want = {f"r{k}": len(parts(turned(s)) & known) > len(parts(s) & known) for k, s in enumerate(reads)}
    d = spark.createDataFrame([(f"r{k}", s) for k, s in enumerate(reads)], "read_id string, seq string")
    made = align.orient(d, spark.createDataFrame([(f"p{k}", s) for k, s in enumerate(refs)], "ref_id string, seq string"))
    assert {r["read_id"]: r["turned"] for r in made.collect()} == want
    assert {r["read_id"]: r["seq"] for r in made.collect()} == {f"r{k}": turned(s) if want[f"r{k}"] else s for k, s in enumerate(reads)}


def test_no_derived_table_is_broadcast(spark, tmp_path):
    # from files, whose small size misleads
    rows = [(f"r{k}", "ACGTTGCAAC" * 7, 40 - k) for k in range(5)]
    spark.createDataFrame(rows, "read_id string, seq string, n long").write.parquet(str(tmp_path / "t"))
    d = spark.read.parquet(str(tmp_path / "t"))
    refs = d.selectExpr("read_id as ref_id", "seq")
    pairs = d.selectExpr("read_id", "read_id as ref_id", "seq as ref_seq", "seq as read_seq", "'+' as strand")
    aligned = align.align_pairs(pairs).drop("ref_seq", "read_seq")
    one = d.selectExpr("'c' as cluster_id", "read_id as seq_id", "seq", "n", "n as ord")
    for df in (gaps.merge_decision(aligned, d.select("read_id", "seq"), 0.95, 40), align.orient(d.select("read_id", "seq"), refs), align.align_join(d.select("read_id", "seq"), refs, identity=0.95, length=40), clusters.cluster_consensus(one)):
        assert "BroadcastHashJoin" not in text(df)
