"""Readers of annotations, variants and alignments: GFF3, GTF, VCF, SAM, enzymes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqframe.functions.sequence import col

GFF = "seqid string, source string, type string, start_pos long, end_pos long, score string, strand string, phase string, attributes string"
# Feature types that a GFF3 file may have, and that is ignored.
KNOWN_TYPES = ("gene", "mRNA", "transcript", "exon", "CDS", "start_codon", "stop_codon", "region", "ncRNA", "tRNA", "rRNA", "pseudogene")
IGNORED_TYPES = ("STS",)


def parse_gff_attributes(text: str | Column) -> Column:
    """``k=v;`` pairs as a map; %20 %2C %5B %5D are decoded and an empty value is 1."""
    pairs = F.filter(F.split(col(text), r";\s*"), lambda p: F.trim(p) != "")
    decode = lambda v: F.replace(F.replace(F.replace(F.replace(v, F.lit("%20"), F.lit(" ")), F.lit("%2C"), F.lit(",")), F.lit("%5B"), F.lit("[")), F.lit("%5D"), F.lit("]"))
    entry = lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), F.when(F.contains(p, F.lit("=")) & (F.regexp_replace(p, "^[^=]*=", "") != ""), decode(F.regexp_replace(p, "^[^=]*=", ""))).otherwise("1").alias("value"))
    return F.map_from_entries(F.transform(pairs, entry))


def read_gff3(spark: SparkSession, paths: str | list[str], strict: bool = True) -> DataFrame:
    """Features with ``attrs``; an unknown type is an error, ignored types go."""
    raw = spark.read.schema(GFF).csv(paths, sep="\t", comment="#", quote="").filter(~F.col("type").isin(*IGNORED_TYPES))
    if strict:
        raw = raw.filter(F.when(F.col("type").isin(*KNOWN_TYPES), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unknown feature type "), "type"))))
    return raw.withColumn("attrs", parse_gff_attributes("attributes")).drop("attributes")


def parse_gtf_attributes(text: str | Column) -> Column:
    keys = F.regexp_extract_all(col(text), F.lit(r'(\w+) "([^"]*)"'), F.lit(1))
    return F.map_from_arrays(keys, F.regexp_extract_all(col(text), F.lit(r'(\w+) "([^"]*)"'), F.lit(2)))


def read_gtf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Features with ``attrs`` of ``key "value";`` and the contig number of ``supercont_d.(n)``."""
    raw = spark.read.schema(GFF).csv(paths, sep="\t", comment="#", quote="")
    return raw.withColumn("attrs", parse_gtf_attributes("attributes")).withColumn("contig", F.regexp_extract("seqid", r"supercont_?\d+\.(\d+)", 1)).drop("attributes")


def read_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(chrom, pos, id, ref, alt, qual, filter, info map, ac)."""
    names = "chrom string, pos long, id string, ref string, alt string, qual string, filter string, info string"
    raw = spark.read.schema(names).csv(paths, sep="\t", comment="#", quote="").filter(F.col("chrom").isNotNull())
    info = F.map_from_entries(F.transform(F.filter(F.split("info", ";"), lambda p: p != ""), lambda p: F.struct(F.substring_index(p, "=", 1).alias("key"), F.regexp_replace(p, "^[^=]*=?", "").alias("value"))))
    return raw.withColumn("info", info).withColumn("ac", F.try_element_at("info", F.lit("AC")))


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Alignment lines: name, flag, reference, position, mapq, cigar, seq, qual33 and typed tags as a map."""
    parts = spark.read.text(paths).filter(~F.startswith("value", F.lit("@")) & (F.trim("value") != "")).select(F.split("value", "\t").alias("c"))
    one = lambda k: F.element_at("c", k)
    tags = F.map_from_entries(F.transform(F.slice("c", F.lit(12), F.size("c")), lambda t: F.struct(F.substring_index(t, ":", 1).alias("key"), F.regexp_replace(t, "^[^:]*:[^:]*:", "").alias("value"))))
    return parts.select(one(1).alias("read_id"), one(2).cast("int").alias("flag"), one(3).alias("ref_id"), one(4).cast("long").alias("pos"), one(5).cast("int").alias("mapq"), one(6).alias("cigar"), one(10).alias("seq"), one(11).alias("qual33"), tags.alias("tags"))


def alignment_table(sam: DataFrame) -> DataFrame:
    """Read begin and end, matches and score from the CIGAR and the tags XM (mismatches), XO (gap opens), XG (gap bases); 0 where unmapped."""
    from seqframe.functions.sequence import cigar_length

    tag = lambda t: F.coalesce(F.try_element_at("tags", F.lit(t)).cast("int"), F.lit(0))
    mapped = F.col("cigar") != "*"
    alnlen = cigar_length("cigar", "MID")
    match = alnlen - tag("XM") - tag("XG")
    score = 10 * match - 9 * tag("XM") - 29 * tag("XO") - 3 * (tag("XG") - tag("XO"))
    begin = F.when(F.col("cigar").rlike(r"^\d+M"), 1).otherwise(-1)
    out = lambda c: F.when(mapped, c).otherwise(0)
    return sam.select("read_id", "ref_id", "pos", out(begin).alias("read_begin"), out(cigar_length("cigar", "MI")).alias("read_end"), out(F.col("pos") + cigar_length("cigar", "MD") - 1).alias("ref_end"), out(match).alias("matches"), out(score).alias("score"))


def read_enzymes(spark: SparkSession, path: str) -> DataFrame:
    """(name, cut, site, type) from blocks ``TYPE n ENZYMES`` of names and sites; cut marks, brackets and digits leave the site."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("n", "line"))  # a reference list of a few hundred lines
    kind = F.regexp_extract("line", r"TYPE (\S+) ENZYMES", 1)
    w = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    typed = lines.withColumn("type", F.last(F.when(kind != "", kind), ignorenulls=True).over(w))
    words = F.regexp_extract("line", r"^\s*(\S+)\s+(\S+)\s*$", 1), F.regexp_extract("line", r"^\s*(\S+)\s+(\S+)\s*$", 2)
    return typed.filter((words[0] != "") & (kind == "") & F.col("type").isNotNull()).select(words[0].alias("name"), words[1].alias("cut"), F.regexp_replace(words[1], r"[\^()/\d-]", "").alias("site"), "type")
