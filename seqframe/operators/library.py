"""Counting library entries: matches, one-mismatch correction, summaries, flank classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = 21


def match_library(candidates: DataFrame, library: DataFrame, ending: str = "CTC", key: int = KEY, name: str = "read_id") -> DataFrame:
    """(read, sequence, library_id, in_library): what each read counts for.

    Candidates (c1, c2) are looked up by their first 21 bases. Both in the library: the second counts if the first
    lacks the ending, else the first if the second lacks it, else none (double hit). One: it counts. Each one
    that is not there counts as not in the library; a second with the first's 21 bases is ignored.
    """
    lib = library.select(F.col("sequence"), F.col("library_id"))
    k1, k2 = F.substring("c1", 1, key), F.substring("c2", 1, key)
    rows = candidates.select(name, "c1", "c2", k1.alias("k1"), F.when(F.col("c2").isNotNull() & (k2 != k1), k2).alias("k2"))
    rows = rows.join(lib.select(F.col("sequence").alias("k1"), F.col("library_id").alias("id1")), "k1", "left").join(lib.select(F.col("sequence").alias("k2"), F.col("library_id").alias("id2")), "k2", "left")
    end1, end2 = F.endswith("c1", F.lit(ending)), F.endswith("c2", F.lit(ending))
    both = F.col("id1").isNotNull() & F.col("id2").isNotNull()
    first = F.struct(F.col("k1").alias("sequence"), F.col("id1").alias("library_id"))
    second = F.struct(F.col("k2").alias("sequence"), F.col("id2").alias("library_id"))
    none = F.array().cast("array<struct<sequence:string,library_id:string>>")
    counted = (
        F.when(both, F.when(~end1, F.array(second)).when(~end2, F.array(first)).otherwise(none))
        .when(F.col("id1").isNotNull(), F.array(first))
        .when(F.col("id2").isNotNull(), F.array(second))
        .otherwise(F.when(F.col("k2").isNull(), F.array(first)).otherwise(F.array(first, second)))
    )
    out = rows.select(name, F.explode(counted).alias("c")).select(name, "c.sequence", "c.library_id")
    return out.withColumn("in_library", F.col("library_id").isNotNull())


def double_hits(candidates: DataFrame, library: DataFrame, ending: str = "CTC", key: int = KEY) -> DataFrame:
    """Reads both of whose candidates are different library entries with the ending."""
    k = lambda c: F.substring(c, 1, key)
    seqs = library.select("sequence").distinct()
    both = candidates.filter((k("c1") != k("c2")) & F.endswith("c1", F.lit(ending)) & F.endswith("c2", F.lit(ending)))
    return both.join(seqs, k("c1") == F.col("sequence"), "left_semi").join(seqs.withColumnRenamed("sequence", "s2"), k("c2") == F.col("s2"), "left_semi")


def library_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("sequence", "in_library").agg(F.count("*").alias("n"))


def gapped_keys(seq: str | Column, parts: int = 4) -> Column:
    """(part, hash of the sequence without that part) for each of so many parts of the sequence: of two sequences one substitution apart, just those of the part with it are equal."""
    s = F.col(seq) if isinstance(seq, str) else seq
    n = F.length(s)
    cut = lambda k: F.floor(n * k / parts).cast("int")
    rest = lambda k: F.xxhash64(F.lit(k), n, F.substring(s, F.lit(1), cut(k)), F.substring(s, cut(k + 1) + 1, n))
    return F.array(*[F.struct(F.lit(k).alias("p"), rest(k).alias("k")) for k in range(parts)])


def correct_one_mismatch(counts: DataFrame) -> DataFrame:
    """(sequence, in_library, n): unmatched sequences with exactly one library entry one substitution away are added to it.

    Sequences meet by three of their four quarters, so each is sent four times whatever its length, and are compared in full then.
    """
    keyed = lambda rows, name: rows.select(F.col("sequence").alias(name), F.explode(gapped_keys("sequence")).alias("m")).select(name, "m.p", "m.k")
    near = keyed(counts.filter("not in_library"), "sequence").join(keyed(counts.filter("in_library"), "entry"), ["p", "k"])
    near = near.filter((F.length("sequence") == F.length("entry")) & (F.levenshtein("sequence", "entry", 1) == 1))
    single = near.groupBy("sequence").agg(F.min("entry").alias("entry"), F.max("entry").alias("last")).filter("entry = last").select("sequence", "entry")
    moved = counts.join(single, "sequence", "left")
    target = F.when(~F.col("in_library") & F.col("entry").isNotNull(), F.col("entry")).otherwise(F.col("sequence"))
    return moved.select(target.alias("sequence"), (F.col("in_library") | F.col("entry").isNotNull()).alias("in_library"), "n").groupBy("sequence", "in_library").agg(F.sum("n").alias("n"))


def library_summary(counts: DataFrame, library: DataFrame) -> DataFrame:
    """One row: library entries hit and not, sum of hits, unmatched sequences and their sum."""
    c = counts.agg(
        F.count(F.when(F.col("in_library") & (F.col("n") > 0), 1)).alias("hit"),
        F.coalesce(F.sum(F.when(F.col("in_library"), F.col("n"))), F.lit(0)).alias("hits"),
        F.count(F.when(~F.col("in_library"), 1)).alias("unmatched"),
        F.coalesce(F.sum(F.when(~F.col("in_library"), F.col("n"))), F.lit(0)).alias("unmatched_reads"),
    )
    size = library.agg(F.count_distinct("sequence").alias("entries"))
    return c.crossJoin(size).withColumn("not_hit", F.col("entries") - F.col("hit"))  # one row each


def hit_histogram(counts: DataFrame) -> DataFrame:
    return counts.filter("in_library").groupBy(F.col("n").alias("hits")).agg(F.count("*").alias("n_entries"))


def motif_category_counts(located: DataFrame, short: int = 20) -> DataFrame:
    """(category, n): both flanks, left, right, junk, or an insert shorter than short."""
    category = F.when(F.col("left_ok") & F.col("right_ok"), F.when(F.col("insert_len") < short, "too_short").otherwise("both")).when(F.col("left_ok"), "left").when(F.col("right_ok"), "right").otherwise("junk")
    return located.groupBy(category.alias("category")).agg(F.count("*").alias("n"))


def quality_keys(located: DataFrame) -> DataFrame:
    """Counts by (left, right, stem identity, stem length), and rolled up without the length (null)."""
    keys = located.select(F.round("left_identity", 2).alias("left"), F.round("right_identity", 2).alias("right"), F.round("stem_identity", 2).alias("stem"), "stem_length")
    return keys.groupingSets([["left", "right", "stem", "stem_length"], ["left", "right", "stem"]], "left", "right", "stem", "stem_length").agg(F.count("*").alias("n"), F.grouping("stem_length").alias("rolled"))


def flank_identity_counts(located: DataFrame) -> DataFrame:
    return located.groupBy(F.round("left_identity", 2).alias("left"), F.round("right_identity", 2).alias("right")).agg(F.count("*").alias("n"))
