"""Typed annotation tables: checks of rows and keys, loads of all tables or none."""

import pytest

from seqframe.operators import annotation
from seqframe.sources import features
from seqframe.sources import typed_tables as TT


def rows(spark, name, *values):
    return spark.createDataFrame(list(values), ", ".join(f"{c} string" for c, _, _ in TT.TABLES[name].fields))


def good(spark):
    return {
        "source": rows(spark, "source", ("c1", "+", "1", "900", "dna", "1", "x")),
        "gene": rows(spark, "gene", ("c1", "+", "10", "90", "g1", None)),
        "transcript": rows(spark, "transcript", ("t1", "mRNA", "g1", ""), ("t2", "mRNA", None, None)),
    }


def listed(df):
    return sorted((r["table_name"], r["column_name"], r["problem"], r["n"]) for r in df.collect())


def test_problems(spark):
    assert listed(TT.problems(good(spark))) == []
    bad = good(spark) | {
        "gene": rows(spark, "gene", ("c1", "+", "10", "90", "g1", None), ("c1", "+", "10", "90", "g1", None), (None, "++", "ten", None, "g3", None), ("c9", "-", "1", "2", None, "a")),
        "transcript": rows(spark, "transcript", ("t1", "a very long RNA type", "g7", ""), ("t3", "mRNA", "g7", "")),
        "proteinseq": rows(spark, "proteinseq", ("1", "p1", None, None)),
    }
    assert listed(TT.problems(bad)) == [
        ("gene", "genomicid", "not in source", 1), ("gene", "genomicid", "null", 1), ("gene", "genomicid,strand,start_pos,end_pos", "repeated key", 2),
        ("gene", "id", "null", 1), ("gene", "id", "repeated key", 2), ("gene", "start_pos", "not a number", 1), ("gene", "strand", "too long", 1),
        ("proteinseq", "sequence", "null", 1), ("transcript", "geneid", "not in gene", 2), ("transcript", "rna_type", "too long", 1),
    ]


def test_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "db")
    assert TT.stored_table(spark, target, "gene").count() == 0
    first = TT.load_tables({k: v.selectExpr("*", "1 as load", "'x' as n") for k, v in good(spark).items()}, target)
    assert [tuple(r) for r in TT.stored_table(spark, target, "gene").collect()] == [("c1", "+", 10, 90, "g1", None)]
    # the stored gene and source are known; the same transcript is refused, and its exon with it
    exon = rows(spark, "exon", ("c1", "+", "10", "20", "1", "t1"))
    with pytest.raises(TT.LoadRefused) as refused:
        TT.load_tables({"transcript": rows(spark, "transcript", ("t1", "mRNA", "g1", None)), "exon": exon}, target)
    assert refused.value.problems == [("transcript", "transcriptid", "repeated key", 1)]
    assert TT.stored_table(spark, target, "exon").count() == 0
    assert TT.load_tables({"exon": exon}, target) != first
    assert TT.stored_table(spark, target, "exon").count() == 1 and TT.stored_table(spark, target, "transcript").count() == 2
    # a load that died before its last row is not seen
    spark.createDataFrame([("c2", "+", 1, 2, "g9", None)], TT.TABLES["gene"].schema).write.parquet(f"{target}/gene/load=dead")
    assert TT.stored_table(spark, target, "gene").count() == 1
    TT.load_tables({"gene": rows(spark, "gene", ("c1", "-", "10", "90", "g9", None)).limit(0)}, target)
    with pytest.raises(ValueError, match="no such tables"):
        TT.load_tables({"genes": exon}, target)
    with pytest.raises(ValueError, match="no tables"):
        TT.load_tables({}, target)


def test_text_files(spark, tmp_path):
    (tmp_path / "gene.tab").write_text('genomicid\tstrand\tstart\tend\tid\tattribute\nc1\t+\t1\t2\tg1\tsay "a"; b\nc1\t-\tx\t2\tg2\t\\N\n')
    (tmp_path / "seq.tab").write_text("7\tc1\ttitle\tACGT\n")
    gene = TT.read_typed_text(spark, str(tmp_path / "gene.tab"), "gene")
    assert sorted(r["attribute"] or "" for r in gene.collect()) == ["", 'say "a"; b']
    assert ("gene", "start_pos", "not a number", 1) in listed(TT.problems({"gene": gene}))
    assert [tuple(r) for r in TT.typed(TT.read_typed_text(spark, str(tmp_path / "seq.tab"), "genomicseq"), "genomicseq").collect()] == [(7, "c1", "title", "ACGT")]


def test_annotation_to_tables(spark, tmp_path):
    def line(*parts):
        return "\t".join(parts)

    text = [
        line("c1", "x", "region", "1", "900", ".", "+", ".", "organism=o;mol_type=dna;chromosome=2"), line("c1", "x", "gene", "10", "90", ".", "-", ".", "ID=g1;note=n"),
        line("c1", "x", "mRNA", "10", "90", ".", "-", ".", "ID=t1;Parent=g1"), line("c1", "x", "exon", "10", "30", ".", "-", ".", "Parent=t1"), line("c1", "x", "exon", "50", "90", ".", "-", ".", "Parent=t1"),
        line("c1", "x", "CDS", "12", "30", ".", "-", "1", "ID=k;Parent=t1;protein_id=p1;product=kinase"), line("c1", "x", "CDS", "50", "88", ".", "-", "0", "ID=k;Parent=t1;protein_id=p1;product=kinase"),
        line("c1", "x", "start_codon", "86", "88", ".", "-", ".", "Parent=t1;protein_id=p1"), line("c1", "x", "stop_codon", "9", "11", ".", "-", ".", "protein_id=p1"),
    ]
    (tmp_path / "a.gff").write_text("\n".join(text) + "\n")
    made = annotation.typed_annotation(features.read_gff3(spark, str(tmp_path / "a.gff")))
    target = str(tmp_path / "db")
    TT.load_tables(made, target)
    stored = {k: [tuple(r) for r in TT.stored_table(spark, target, k).collect()] for k in made}
    assert stored["source"] == [("c1", "+", 1, 900, "dna", 2, "o")] and [r[:3] for r in stored["transcript"]] == [("t1", "mRNA", "g1")]
    assert sorted((r[2], r[4]) for r in stored["exon"]) == [(10, 2), (50, 1)] and sorted((r[3], r[6]) for r in stored["cds"]) == [(12, 2), (50, 1)]
    assert stored["protein"] == [("p1", "g1", "kinase", None)] and len(stored["start_codon"]) == len(stored["stop_codon"]) == 1
