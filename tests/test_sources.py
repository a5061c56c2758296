"""Readers and writers on small hand-written files."""

import os

import pytest
from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.operators import taxonomy
from seqframe.sources import fastq, features, reports, sequences, sinks


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def test_fasta_round_trip(spark, put, tmp_path):
    path = put("a.fas", ">s1 first one\r\nACGT\r\nACG\r\n>s2\nTT-T\n>bad\nA1C\n>empty\n\n>s3 x\nGG")
    rows = {r["seq_id"]: (r["title"], r["seq"]) for r in sequences.read_fasta(spark, path).collect()}
    assert rows == {"s1": ("first one", "ACGTACG"), "s2": ("", "TT-T"), "s3": ("x", "GG")}
    out = str(tmp_path / "out")
    sinks.write_fasta(sequences.read_fasta(spark, path), out, width=3)
    again = {r["seq_id"]: (r["title"], r["seq"]) for r in sequences.read_fasta(spark, out).collect()}
    assert again == rows


@pytest.mark.parametrize("size", [7, 20, 64, 300, 64 << 20])
def test_fastq_ranges(spark, put, size):
    records = [(f"r{k}", "ACGT" * (k % 3 + 1), ("@" if k % 2 else "I") + "+" * (4 * (k % 3 + 1) - 1)) for k in range(40)] + [("last", "A", "@")]
    path = put("a.fastq", "".join(f"@{n} t{n}\n{s}\n+\n{q}\n" for n, s, q in records))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", size)
    try:
        rows = fastq.read_fastq(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert {r["read_id"]: (r["seq"], r["qual"], r["title"]) for r in rows} == {n: (s, [ord(c) - 33 for c in q], f"t{n}") for n, s, q in records}
    assert [r["read_id"] for r in sorted(rows, key=lambda r: r["ord"])] == [n for n, _, _ in records] and len(rows) == 41


def test_fastq_write(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGT", [31, 2, 40, 10]), ("b", "GG", [0, 1])], "read_id string, seq string, qual array<int>")
    sinks.write_fastq(df, str(tmp_path / "q"))
    got = {r["read_id"]: (r["seq"], r["qual"]) for r in fastq.read_fastq(spark, str(tmp_path / "q")).collect()}
    assert got == {"a": ("ACGT", [31, 2, 40, 10]), "b": ("GG", [0, 1])}


def test_genbank(spark, put):
    text = "LOCUS       AB1   20 bp\nDEFINITION  first line\n            second line.\nACCESSION   AB1\nVERSION     AB1.2  GI:77\nSOURCE      x\n  ORGANISM  Homo sapiens\n            Eukaryota; Metazoa;\n            Chordata.\nREFERENCE   1\n//\nLOCUS       AB2   9 bp\nDEFINITION  d.\nACCESSION   AB2\nVERSION     AB2.1  GI:78\nSOURCE      y\n  ORGANISM  Mus musculus\n            Eukaryota.\nORIGIN\n//\n"
    rows = {r["accession"]: r.asDict() for r in sequences.read_genbank(spark, put("a.gb", text)).collect()}
    assert rows["AB1"]["definition"] == "first line second line." and rows["AB1"]["version"] == 2 and rows["AB1"]["gi"] == "77"
    assert rows["AB1"]["organism"] == "Homo sapiens" and rows["AB1"]["lineage"] == "Eukaryota; Metazoa; Chordata"
    assert rows["AB2"]["organism"] == "Mus musculus"


def test_gff_gtf_vcf_sam(spark, put):
    gff = put("a.gff", "##gff\nc1\tx\tgene\t1\t90\t.\t+\t.\tID=g1;Note=a%20b%2Cc;flag\nc1\tx\tSTS\t1\t2\t.\t+\t.\tID=s\n")
    row = features.read_gff3(spark, gff).collect()
    assert len(row) == 1 and row[0]["attrs"] == {"ID": "g1", "Note": "a b,c", "flag": "1"}
    with pytest.raises(Exception, match="unknown feature type"):
        features.read_gff3(spark, put("b.gff", "c1\tx\todd\t1\t90\t.\t+\t.\tID=g1\n")).collect()
    gtf = put("a.gtf", 'supercont_1.12\tx\texon\t1\t9\t.\t-\t.\tgene_id "g 1"; transcript_id "t";\n')
    row = features.read_gtf(spark, gtf).first()
    assert row["attrs"] == {"gene_id": "g 1", "transcript_id": "t"} and row["contig"] == "12"
    vcf = put("a.vcf", "##x\n#CHROM\nc\t5\t.\tA\tG,T\t9\tPASS\tAC=2,0;DB\n")
    row = features.read_vcf(spark, vcf).first()
    assert row["info"] == {"AC": "2,0", "DB": ""} and row["ac"] == "2,0" and row["pos"] == 5
    sam = put("a.sam", "@HD\nr1\t0\tref\t11\t60\t5M2I3M1D4M\t*\t0\t0\tACGTACGTACGTAC\tIIIIIIIIIIIIII\tXM:i:1\tXO:i:2\tXG:i:3\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    rows = {r["read_id"]: r.asDict() for r in features.alignment_table(features.read_sam(spark, sam)).collect()}
    assert rows["r1"]["matches"] == 15 - 1 - 3 and rows["r1"]["score"] == 110 - 9 - 58 - 3 and rows["r1"]["ref_end"] == 23 and rows["r1"]["read_begin"] == 1
    assert rows["r2"]["score"] == 0 and rows["r2"]["matches"] == 0


def test_small_lists(spark, put):
    assert {r[0] for r in sequences.read_ids(spark, put("ids", '>a title\nb, "c"\n\nb')).collect()} == {"a", "b", "c"}
    swarm = sequences.read_clusters(spark, put("sw", "a_3 b_1\nc_2\n")).collect()
    assert {(r["cluster_id"], r["seq_id"]) for r in swarm} == {("a", "a"), ("a", "b"), ("c", "c")}
    mothur = sequences.read_clusters(spark, put("mo", "label\tn\n#\tx\n0.01\t2\ta,b\tc\n0.03\t1\ta,b,c\n0.05\t1\tz\n"), "mothur", 0.04).collect()
    assert {(r["cluster_id"], r["seq_id"]) for r in mothur} == {("cl0", "a"), ("cl0", "b"), ("cl0", "c")}
    assert sequences.read_library(spark, put("lib", "A" * 21 + ",x\n")).first()["n"] == 0
    with pytest.raises(Exception, match="not of the right length"):
        sequences.read_library(spark, put("lib2", "ACG,x\n")).collect()
    enzymes = {r["name"]: (r["site"], r["type"]) for r in features.read_enzymes(spark, put("enz", "TYPE II ENZYMES\nEcoRI  G^AATTC\nTYPE III ENZYMES\nXxx  CAGCAG(25/27)\n")).collect()}
    assert enzymes == {"EcoRI": ("GAATTC", "II"), "Xxx": ("CAGCAG", "III")}


def test_mate_files(spark, tmp_path):
    for name in ("x_1", "x_2", "all_1"):
        (tmp_path / f"{name}.fastq").write_text("@a\nA\n+\nI\n")
    assert {(r["stem"], r["mate"]) for r in sequences.read_mate_files(spark, str(tmp_path)).collect()} == {("x", 1), ("x", 2)}
    os.remove(tmp_path / "x_2.fastq")
    with pytest.raises(Exception, match="no mate"):
        sequences.read_mate_files(spark, str(tmp_path)).collect()


def test_hit_report(spark, put):
    text = "header\nQuery= q1 some\n         (120 letters)\n\n>t1 title\n          Length = 300\n\n Score = 50.1 bits (99), Expect = 2e-10\n Identities = 30/60 (50%), Positives = 40/60 (66%), Gaps = 2/60 (3%)\n\nQuery: 1  ACGT 4\nSbjct: 11 ACGT 14\n\nQuery: 5  AC 6\nSbjct: 15 AC 16\n\n Score = 20.0 bits (9), Expect = e-120\n Identities = 10/20 (50%)\n\nQuery: 9 A 9\nSbjct: 9 A 9\nQuery= q2\n  (10 letters)\n ***** No hits found\n"
    path = put("rep", text)
    one = reports.parse_hit_report(spark, path).collect()
    assert [(r["query"], r["qlen"], r["target"], r["tlen"], r["score"], r["match_len"], r["identical"], r["positive"], r["gaps"]) for r in one] == [("q1", 120, "t1", 300, 50.1, 60, 30, 40, 2)]
    both = sorted(reports.parse_hit_report(spark, path, "translated").collect(), key=lambda r: -r["score"])
    assert [(r["qbegin"], r["qend"], r["tbegin"], r["tend"], r["expect"]) for r in both] == [(1, 6, 11, 16, 2e-10), (9, 9, 9, 9, 0.0)]


def test_tsv_and_routes(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, v string, n int")
    sinks.write_tsv(df, str(tmp_path / "t"))
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).collect())
    assert "a\t\\N\t1" in lines and "k\tv\tn" in lines
    sinks.write_routed(df, str(tmp_path / "r"), "k")
    assert spark.read.parquet(str(tmp_path / "r")).filter("k = 'b'").first()["v"] == "x"
    sinks.load_staged(df, str(tmp_path / "s"), str(tmp_path / "target"), ["k"])
    sinks.load_staged(df.withColumn("n", F.lit(9)).unionByName(spark.createDataFrame([("c", "y", 3)], df.schema)), str(tmp_path / "s"), str(tmp_path / "target"), ["k"])
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "target")).collect()) == [1, 2, 3]


def test_functions_by_hand(spark):
    df = spark.createDataFrame([("ACGTN", "A" * 40), ("acgu", "ACGT" * 10)], "s string, t string")
    got = df.select(S.revcomp("s").alias("rc"), S.translate(F.lit("ATGTGGTAA")).alias("p"), S.longest_run("t").alias("l"), S.is_repeat("t").alias("r"), S.has_long_polymer("t").alias("h"), S.iupac_regex(F.lit("GANTC")).alias("x")).collect()
    assert [r["rc"] for r in got] == ["NACGT", "acgt"] and got[0]["p"] == "MW*" and [r["l"] for r in got] == [40, 1]
    assert [r["r"] for r in got] == [True, False] and [r["h"] for r in got] == [True, False] and got[0]["x"] == "GA[ACGT]TC"
    assert df.select(S.revcomp(S.revcomp("t")) == F.col("t")).collect()[0][0]
    assert df.select(taxonomy.repair_name(F.lit(" Tobacco  Virus strain X ")).alias("n")).first()["n"] == "Tobacco virus"


def test_long_assembly_info_is_read_in_parts(spark, tmp_path):
    for name in ("a", "b"):
        body = "".join(f"  Num. reads {k} : {k}:{name} \n" for k in range(60))
        (tmp_path / f"{name}.txt").write_text(f"Heading:\n====\n{body}" + ("All contigs:\nlate: 1\n" + "later: 2\n" * 40 if name == "a" else "last: 3\n"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        info = reports.read_assembly_info(spark, str(tmp_path))
        got = sorted((r["src"][-5:], r["key"], r["value"]) for r in info.collect())
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [(f"{n}.txt", f"Num. reads {k}", f"{k}:{n}") for n in "ab" for k in range(60)] + [("b.txt", "last", "3")]
    assert got == sorted(want)


def test_a_line_of_a_cluster_file_is_split_once(spark, put):
    path = put("c.swarm", "a_3 b_2 c_1\n\nd_1\n")
    df = sequences.read_clusters(spark, path)
    assert sorted((r["cluster_id"], r["seq_id"], r["place"]) for r in df.collect()) == [("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("d", "d", 0)]
    # what stands above the generator is made for each id: no text of a line is split there
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above, _, _ = plan.partition("Generate")
    assert "Generate" in plan and "split(" not in above


def test_kernels_over_one_file_are_spread(spark, tmp_path):
    from seqframe.operators import gaps, trims

    one = str(tmp_path / "one")
    spark.range(64).select(F.concat(F.lit("ACGTACGT"), F.repeat(F.lit("A"), (F.col("id") + 9).cast("int"))).alias("seq")).coalesce(1).write.parquet(one)
    df = spark.read.parquet(one)
    assert df.rdd.getNumPartitions() == 1
    for made in (trims.short_read_poly_a(df), trims.complexity_trim(df), gaps.stem_pairs(df.select(F.col("seq").alias("top_seq"), F.col("seq").alias("bottom_seq")))):
        assert made.rdd.getNumPartitions() >= 4
