"""Tabular hits and text reports of search and alignment programs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HITS = "query string, target string, identity double, length int, mismatch int, gap int, qstart int, qend int, tstart int, tend int, evalue double, score double"
HITS11 = "qseqid string, sseqid string, pident double, qlen int, slen int, length int, qstart int, qend int, sstart int, send int, bitscore double"


def read_hits_tabular(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.schema(HITS).csv(paths, sep="\t", comment="#")


def read_hits_outfmt11(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.schema(HITS11).csv(paths, sep="\t", comment="#")


def parse_evalue(text: str | Column) -> Column:
    """``e-100`` is 1e-100; under 1e-100 is 0."""
    c = F.col(text) if isinstance(text, str) else text
    value = F.when(F.startswith(c, F.lit("e")), F.concat(F.lit("1"), c)).otherwise(c).cast("double")
    return F.when(value < 1e-100, 0.0).otherwise(value)


def _queries(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    r = spark.read.option("lineSep", "\nQuery=").text(paths).filter(F.contains("value", F.lit("letters)")))
    return r.select(F.trim(F.regexp_extract("value", r"^\s*(?:.*?Query=\s*)?(\S+)", 1)).alias("query"), F.regexp_replace(F.regexp_extract("value", r"\(([\d,]+) letters\)", 1), ",", "").cast("int").alias("qlen"), F.col("value"))


def parse_hit_report(spark: SparkSession, paths: str | list[str], kind: str = "protein") -> DataFrame:
    """Hits of a search report.

    ``protein``: the first segment of each target: query, qlen, target, tlen, score, expect, match_len, identical, positive, gaps.
    ``translated``: all segments, with the ranges of query and target over wrapped lines.
    ``segments``: as translated, with gi|n| targets named nr:n.
    """
    q = _queries(spark, paths)
    targets = q.select("query", "qlen", F.explode(F.slice(F.split("value", r"\n>"), F.lit(2), F.size(F.split("value", r"\n>")))).alias("t"))
    targets = targets.select("query", "qlen", F.regexp_extract("t", r"^(\S+)", 1).alias("target"), F.regexp_replace(F.regexp_extract("t", r"Length\s*=\s*([\d,]+)", 1), ",", "").cast("int").alias("tlen"), F.split("t", r"(?= Score\s*=)").alias("s"))
    segment = F.explode(F.slice("s", F.lit(2), F.when(F.lit(kind == "protein"), F.least(F.lit(1), F.size("s") - 1)).otherwise(F.size("s"))))
    rows = targets.filter(F.size("s") > 1).select("query", "qlen", "target", "tlen", segment.alias("s"))
    number = lambda pattern: F.regexp_extract("s", pattern, 1)
    whole = lambda pattern: F.when(number(pattern) != "", number(pattern).cast("int")).otherwise(0)
    out = [
        "query", "qlen", F.when(F.lit(kind == "segments") & F.col("target").rlike(r"^gi\|\d+"), F.concat(F.lit("nr:"), F.regexp_extract("target", r"gi\|(\d+)", 1))).otherwise(F.col("target")).alias("target"), "tlen",
        number(r"Score\s*=\s*([\d.]+)").cast("double").alias("score"), parse_evalue(number(r"Expect(?:\(\d+\))?\s*=\s*([\d.e+-]+)")).alias("expect"), whole(r"Identities\s*=\s*\d+/(\d+)").alias("match_len"),
        whole(r"Identities\s*=\s*(\d+)/").alias("identical"), whole(r"Positives\s*=\s*(\d+)/").alias("positive"), whole(r"Gaps\s*=\s*(\d+)/").alias("gaps"),
    ]
    if kind != "protein":
        ends = lambda side, k: F.regexp_extract_all("s", F.lit(rf"(?m)^{side}:?\s+(\d+)\s+\S+\s+(\d+)"), F.lit(k))
        for side, n in (("Query", "q"), ("Sbjct", "t")):
            out += [F.element_at(ends(side, 1), 1).cast("int").alias(f"{n}begin"), F.element_at(ends(side, 2), -1).cast("int").alias(f"{n}end")]
    return rows.select(*out)


def parse_search_report(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(query, qlen, target, tlen, score, bits, expect, identity, similar, overlap and both ranges) of ``>>`` entries; self hits are left out."""
    r = spark.read.option("lineSep", "\n>>>").text(paths).filter(F.contains("value", F.lit(">>")) | F.contains("value", F.lit(" aa")) | F.contains("value", F.lit(" nt")))
    q = r.select(F.regexp_extract("value", r"^(?:>>>)?\s*(\S+?),?\s", 1).alias("query"), F.regexp_extract("value", r"(\d+) (?:aa|nt)", 1).cast("int").alias("qlen"), F.split("value", r"\n>>").alias("e"))
    e = q.select("query", "qlen", F.explode(F.slice("e", F.lit(2), F.size("e"))).alias("e"))
    one = lambda pattern, k=1: F.regexp_extract("e", pattern, k)
    range_ = r"overlap \((\d+)-(\d+):(\d+)-(\d+)\)"
    out = e.select("query", one(r"^(\S+)").alias("target"), "qlen", one(r"\((\d+) (?:aa|nt)\)").cast("int").alias("tlen"), one(r"opt:\s*(\d+)").cast("int").alias("score"), one(r"bits:\s*([\d.]+)").cast("double").alias("bits"), parse_evalue(one(r"E\([^)]*\):\s*([\d.e+-]+)")).alias("expect"), one(r"([\d.]+)% identity").cast("double").alias("identity"), one(r"(\d+) (?:aa|nt) overlap").cast("int").alias("overlap"), *[one(range_, k + 1).cast("int").alias(n) for k, n in enumerate(("qbegin", "qend", "tbegin", "tend"))])
    return out.filter(F.col("query") != F.col("target"))


def parse_motif_report(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(name, strand, begin, end, score, match): one row for each match under a ``>name`` header."""
    r = spark.read.option("lineSep", "\n>").text(paths)
    name = F.regexp_replace(F.regexp_extract("value", r"^>?(\S+)", 1), "^>", "")
    m = r.select(name.alias("name"), F.explode(F.regexp_extract_all("value", F.lit(r"((?:FW|RC)\s+\d+\s+\d+\.\.\d+\s+[\d.]+\n\S+)"), F.lit(1))).alias("m"))
    one = lambda k: F.regexp_extract("m", r"^(\w+)\s+\d+\s+(\d+)\.\.(\d+)\s+([\d.]+)\n(\S+)", k)
    return m.select("name", one(1).alias("strand"), one(2).cast("int").alias("begin"), one(3).cast("int").alias("end"), one(4).cast("double").alias("score"), one(5).alias("match"))


def parse_gene_prediction(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(sequence, gene, type, strand, begin, end, length, frame, phase): exon rows of a prediction report."""
    r = spark.read.option("lineSep", "\nSequence ").text(paths)
    name = F.regexp_extract("value", r"^(?:Sequence )?(\S+)", 1)
    rows = r.select(name.alias("sequence"), F.explode(F.regexp_extract_all("value", F.lit(r"(?m)^\s*(\d+\.\d+\s+(?:Init|Intr|Term|Sngl|PlyA|Prom)\s+[+-].*)$"), F.lit(1))).alias("l"))
    c = F.split("l", r"\s+")
    at = lambda k: F.try_element_at(c, F.lit(k))
    lo, hi = F.least(at(4).cast("int"), at(5).cast("int")), F.greatest(at(4).cast("int"), at(5).cast("int"))
    return rows.select("sequence", F.substring_index(at(1), ".", 1).cast("int").alias("gene"), at(2).alias("type"), at(3).alias("strand"), lo.alias("begin"), hi.alias("end"), at(6).cast("int").alias("length"), at(7).cast("int").alias("frame"), at(8).cast("int").alias("phase"))


def read_assembly_info(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(src, key, value) of ``key: value`` lines up to ``All contigs:``; files are read by lines, in parts."""
    mark = "All contigs:"
    # within a file, lines are in order by their part's begin and then their number in the task
    at = F.struct(F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("src"), at.alias("at"), "value")
    end = lines.filter(F.contains("value", F.lit(mark))).groupBy("src").agg(F.min("at").alias("end"))
    head = lines.join(end, "src", "left").filter(F.col("end").isNull() | (F.col("at") <= F.col("end"))).select("src", F.substring_index("value", mark, 1).alias("p"))
    pairs = head.filter(F.col("p").rlike(r"^\s*[^:]+?\s*:\s*\S"))
    return pairs.select("src", F.trim(F.substring_index("p", ":", 1)).alias("key"), F.trim(F.regexp_replace("p", "^[^:]*:", "")).alias("value"))


def read_contig_stats(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.csv(paths, sep="\t", header=True, comment="#", inferSchema=False)


def read_quality_blocks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(seq_id, qual) of ``>name`` blocks of integers."""
    r = spark.read.option("lineSep", "\n>").text(paths).select(F.regexp_replace("value", "^>", "").alias("v"))
    return r.select(F.regexp_extract("v", r"^(\S+)", 1).alias("seq_id"), F.transform(F.filter(F.split(F.regexp_replace("v", r"^[^\n]*\n?", ""), r"\s+"), lambda x: x != ""), lambda x: x.cast("int")).alias("qual"))


def parse_alignment_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(pair, query_text, spacer, target_text, identity) of blocks between ``====`` and ``//``; wrapped rows are joined."""
    r = spark.read.option("lineSep", "\n//\n").text(paths).filter(F.contains("value", F.lit("====")))
    body = F.regexp_replace("value", r"(?s)^.*?====+\n", "")
    line = lambda tag: F.array_join(F.regexp_extract_all(body, F.lit(rf"(?m)^{tag}\t(.*)$"), F.lit(1)), "")
    return r.select(F.regexp_extract(body, r"^(.*)\n", 1).alias("pair"), line("query").alias("query_text"), line("spacer").alias("spacer"), line("target").alias("target_text"), F.regexp_extract("value", r"identity\s*[=:]?\s*([\d.]+)", 1).cast("double").alias("identity"))


def parse_global_similarity(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(name1, length1, name2, length2, percent) of global-alignment reports."""
    w = spark.read.text(paths, wholetext=True)
    one = lambda pattern, k=1: F.regexp_extract("value", pattern, k)
    head = r"(?m)^\S*?\s*(\S+)\s+(\d+) (?:aa|nt) vs\.\s*\n?\s*(\S+)\s+(\d+) (?:aa|nt)"
    return w.select(one(head, 1).alias("name1"), one(head, 2).cast("int").alias("length1"), one(head, 3).alias("name2"), one(head, 4).cast("int").alias("length2"), one(r"([\d.]+)% (?:identity|similarity)").cast("double").alias("percent"))
