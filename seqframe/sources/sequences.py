"""Readers of sequence files. Text is cut into records by Spark's line separator and taken apart by column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _records(spark: SparkSession, paths: str | list[str], separator: str) -> DataFrame:
    """(value, src): records with the separator taken off, and their file."""
    return spark.read.option("lineSep", separator).text(paths).select(F.col("value"), F.col("_metadata.file_path").alias("src"))


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(seq_id, title, seq, src): records from ``>`` to the next; carriage returns go; records that are empty or hold non-letters are left out."""
    r = _records(spark, paths, "\n>").withColumn("value", F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", ""))
    header, body = F.regexp_extract("value", r"^([^\n]*)", 1), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "")
    out = r.select(F.regexp_extract(header, r"^(\S+)", 1).alias("seq_id"), F.trim(F.regexp_replace(header, r"^\S+\s*", "")).alias("title"), body.alias("seq"), "src")
    return out.filter(F.col("seq").rlike("^[A-Za-z*-]+$") & (F.col("seq_id") != ""))


read_two_line_fasta = read_fasta


def read_raw_lines(spark: SparkSession, paths: str | list[str], prefix: str = "s") -> DataFrame:
    """(seq_id, seq): one bare sequence a line; ids from file and place, unique but not dense."""
    lines = spark.read.text(paths).filter(F.trim("value") != "")
    return lines.select(F.concat(F.lit(prefix), F.monotonically_increasing_id().cast("string")).alias("seq_id"), F.trim("value").alias("seq"))


def read_genbank(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(locus, accession, version, gi, definition, organism, lineage, raw) of LOCUS ... // records."""
    r = _records(spark, paths, "\n//\n").filter(F.col("value").rlike(r"(?m)^\s*LOCUS"))
    one = lambda pattern: F.regexp_extract("value", pattern, 1)
    flat = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    return r.select(
        one(r"(?m)^LOCUS\s+(\S+)").alias("locus"), one(r"(?m)^ACCESSION\s+(\S+)").alias("accession"), one(r"(?m)^VERSION\s+\S+?\.(\d+)").cast("int").alias("version"), one(r"(?m)^VERSION.*GI:(\d+)").alias("gi"),
        flat(one(r"(?s)(?:^|\n)DEFINITION\s+(.*?)\n(?=\S)")).alias("definition"), flat(one(r"(?m)^  ORGANISM\s+(.*)$")).alias("organism"),
        F.regexp_replace(flat(one(r"(?s)\n  ORGANISM[^\n]*\n(.*?)\n(?=\S|  [A-Z])")), r"\.$", "").alias("lineage"), F.col("value").alias("raw"), "src",
    )


def read_est(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(gi, organism, raw) of IDENTIFIERS ... || reports; the organism begins in column 16."""
    r = _records(spark, paths, "\n||\n").filter(F.contains("value", F.lit("IDENTIFIERS")))
    return r.select(F.regexp_extract("value", r"(?m)^GenBank gi:\s*(\d+)", 1).alias("gi"), F.trim(F.regexp_extract("value", r"(?m)^Organism:.{6}(.*)$", 1)).alias("organism"), F.col("value").alias("raw"))


def read_sequence_headers(seqs: DataFrame) -> DataFrame:
    """(gi, accession, title, species, seq) from headers such as ``gi|n|ref|acc| title [species]``."""
    h = F.concat_ws(" ", "seq_id", "title")
    bare = F.trim(F.regexp_replace(F.regexp_replace(h, r"^\S+\s*", ""), r"\s*\[[^\]]*\]\s*$", ""))
    return seqs.select(F.regexp_extract(h, r"gi\|(\d+)", 1).alias("gi"), F.regexp_extract(h, r"gi\|\d+\|[^|]*\|([^|\s]+)", 1).alias("accession"), bare.alias("title"), F.regexp_extract(h, r"\[([^\]]*)\]\s*$", 1).alias("species"), "seq")


def read_contig_headers(seqs: DataFrame, name: str = r"^contig_\d+\.(\d+)$") -> DataFrame:
    """(contig_id, seq) from headers such as ``contig_1.25``; sequences of other names are left out."""
    number = F.regexp_extract("seq_id", name, 1)
    return seqs.filter(number != "").select(number.cast("long").alias("contig_id"), "seq")


def read_protein_headers(seqs: DataFrame, species: str = "", name: str = r"^[A-Za-z0-9]+_(\d+)$") -> DataFrame:
    """(protein_id, title, seq) from headers such as ``ABC_00012 | Species title (translation) (120 aa)``: the number without leading zeros, the bare title.

    The species' name and the note of the translation go. A header of another form is an error.
    """
    number, head = F.regexp_extract("seq_id", name, 1), F.regexp_extract("title", r"^\| (.+)$", 1)
    bad = F.raise_error(F.concat(F.lit("not a protein header: "), F.col("seq_id"), F.lit(" "), F.coalesce("title", F.lit(""))))
    bare = F.regexp_replace(head, r" \(translation\) \(\d+ aa\)", "")
    title = F.replace(bare, F.lit(f"{species} "), F.lit("")) if species else bare
    return seqs.select(F.when((number == "") | (F.coalesce(head, F.lit("")) == ""), bad.cast("long")).otherwise(number.cast("long")).alias("protein_id"), title.alias("title"), "seq")


def read_ids(spark: SparkSession, source: str | list[str], name: str = "seq_id") -> DataFrame:
    """Distinct ids from files of words or comma lists (quotes and a leading ``>`` go), or from a list."""
    if isinstance(source, list):
        return spark.createDataFrame([(x,) for x in source], f"{name} string").distinct()
    line = F.when(F.startswith("value", F.lit(">")), F.regexp_extract("value", r"^>(\S+)", 1)).otherwise(F.col("value"))
    words = spark.read.text(source).select(F.explode(F.split(line, r"[\s,]+")).alias(name))
    return words.select(F.regexp_replace(name, "[\"'>]", "").alias(name)).filter(F.col(name) != "").distinct()


def read_library(spark: SparkSession, path: str, header: bool = False, length: int = 21) -> DataFrame:
    """(sequence, library_id, n): rows of sequence and id, counts from 0; a sequence of another length is an error."""
    raw = spark.read.schema("sequence string, library_id string").csv(path, header=header)
    bad = F.length("sequence") != length
    return raw.filter(F.when(bad, F.raise_error(F.concat(F.lit("not of the right length: "), "sequence"))).otherwise(F.lit(True))).withColumn("n", F.lit(0).cast("long"))


def read_clusters(spark: SparkSession, path: str, format: str = "swarm", cutoff: float | None = None) -> DataFrame:
    """(cluster_id, seq_id, place). swarm: one cluster a line, ``_count`` suffixes taken off. mothur: the row of the largest distance up to the cutoff."""
    if format == "swarm":
        lines = spark.read.text(path).filter(F.trim("value") != "")
        ids = F.transform(F.split(F.trim("value"), r"\s+"), lambda x: F.regexp_replace(x, r"_\d+$", ""))
        # the first id is made with the list, a line at a time: beside posexplode it would split the whole line again for each id
        return lines.select(F.element_at(ids, 1).alias("cluster_id"), ids.alias("ids")).select("cluster_id", F.posexplode("ids").alias("place", "seq_id"))
    rows = spark.read.text(path).select(F.split("value", "\t").alias("c")).filter(F.element_at("c", 1).rlike(r"^\d*\.?\d+$"))
    rows = rows.select(F.element_at("c", 1).cast("double").alias("distance"), F.slice("c", F.lit(3), F.size("c")).alias("lists")).filter(F.col("distance") <= cutoff)
    chosen = rows.agg(F.max_by("lists", "distance").alias("lists"))
    one = chosen.select(F.posexplode("lists").alias("k", "list"))
    return one.select(F.concat(F.lit("cl"), F.col("k").cast("string")).alias("cluster_id"), F.posexplode(F.split("list", ",")).alias("place", "seq_id"))


def read_mate_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, stem, mate): ``*_1.fastq`` and ``*_2.fastq``; other names are errors, ``all_1``/``all_2`` are skipped, unequal numbers are an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.fastq").load(folder).select("path")
    named = files.select("path", F.regexp_extract("path", r"([^/]*)\.fastq$", 1).alias("name")).filter(~F.col("name").rlike("^all_[12]$"))
    named = named.select("path", F.regexp_extract("name", r"^(.*)_([12])$", 1).alias("stem"), F.regexp_extract("name", r"_([12])$", 1).cast("int").alias("mate"))
    counts = named.groupBy("stem").agg(F.count(F.when(F.col("mate") == 1, 1)).alias("a"), F.count(F.when(F.col("mate") == 2, 1)).alias("b"))
    checked = named.join(counts, "stem").filter(F.when((F.col("stem") == "") | (F.col("a") != F.col("b")), F.raise_error(F.concat(F.lit("no mate: "), "path"))).otherwise(F.lit(True)))
    return checked.select("path", "stem", "mate")
