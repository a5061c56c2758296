"""Statistics of sequences, runs, qualities and tables: all partial aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.functions import sequence as S


def length_stats(df: DataFrame, seq: str = "seq", by: list[str] | None = None) -> DataFrame:
    n = F.length(seq)
    return df.groupBy(*(by or [])).agg(F.avg(n).alias("mean"), F.stddev_samp(n).alias("std"), F.count("*").alias("n"))


def trim_stats(df: DataFrame, trimmed: Column, seq: str = "seq") -> DataFrame:
    """Mean, std and n of the length before and after a trim; sequences trimmed away don't count after."""
    before, after = F.length(seq), F.length(trimmed)
    return df.agg(F.avg(before).alias("mean_before"), F.stddev_samp(before).alias("std_before"), F.count(before).alias("n_before"), F.avg(after).alias("mean_after"), F.stddev_samp(after).alias("std_after"), F.count(after).alias("n_after"))


def length_histogram(df: DataFrame, seq: str = "seq") -> DataFrame:
    return df.groupBy(F.length(seq).alias("length")).agg(F.count("*").alias("n"))


def length_table(df: DataFrame, name: str = "seq_id", seq: str = "seq") -> DataFrame:
    return df.select(name, F.length(seq).alias("length"))


def gc_report(df: DataFrame, name: str = "seq_id", seq: str = "seq") -> DataFrame:
    return df.select(name, S.gc(seq).alias("gc"), F.length(seq).alias("length"))


def gc_summary(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Overall GC over A+C+G+T, N fraction over A+C+G+T+N, total length."""
    total = lambda letters: F.sum(S.count_of(seq, letters))
    return df.agg((total("GC") / total("ACGT")).alias("gc"), (total("N") / total("ACGTN")).alias("n_fraction"), F.sum(F.length(seq)).alias("total_length"))


def pair_count(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.groupBy(first, second).agg(F.count("*").alias("n"))


def homopolymer_histogram(df: DataFrame, seq: str = "seq") -> DataFrame:
    """(base, run, n, fraction): fraction is run * n over all bases."""
    run = df.select(F.explode(S.runs(seq)).alias("r"))
    counts = run.groupBy(F.substring("r", 1, 1).alias("base"), F.length("r").alias("run")).agg(F.count("*").alias("n"))
    return counts.withColumn("fraction", F.col("run") * F.col("n") / F.sum(F.col("run") * F.col("n")).over(Window.partitionBy()))


def tandem_runs(df: DataFrame, least: int = 4, seq: str = "seq") -> DataFrame:
    run = df.select(F.explode(S.runs(seq)).alias("r")).filter(F.length("r") >= least)
    return run.groupBy(F.substring("r", 1, 1).alias("base"), F.length("r").alias("run")).agg(F.count("*").alias("n"))


def tag_histogram(df: DataFrame, value: str | Column) -> DataFrame:
    return df.groupBy(F.round(S.col(value), 2).alias("value")).agg(F.count("*").alias("n"))


def codon_spacing(df: DataFrame, codons: tuple[str, ...] = ("TAG", "TGA", "TAA"), first: int | None = 5000, name: str = "seq_id", seq: str = "seq", order: str = "ord") -> DataFrame:
    """(distance, n): distances between successive codons of the list in each of the first lines."""
    lines = df.orderBy(order).limit(first) if first else df
    # split before each codon: of the parts, the first is the head and the last the tail, the others are as long as the distances
    parts = S.bound(F.split(F.concat(F.lit(" "), F.upper(seq)), f"(?={'|'.join(codons)})"), lambda p: F.slice(p, F.lit(2), F.greatest(F.size(p) - 2, F.lit(0))))
    steps = lines.select(F.explode(parts).alias("part")).select(F.length("part").alias("distance"))
    return steps.groupBy("distance").agg(F.count("*").alias("n"))


def weighted_stats(df: DataFrame, value: str = "value", n: str = "n", by: list[str] | None = None) -> DataFrame:
    """Mean and population std of values that occur n times."""
    v, w = F.col(value), F.col(n)
    g = df.groupBy(*(by or [])).agg(F.sum(w).alias("n"), F.sum(v * w).alias("s"), F.sum(v * v * w).alias("q"))
    mean = F.col("s") / F.col("n")
    return g.select(*(by or []), "n", mean.alias("mean"), F.sqrt(F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0))).alias("std"))


def good_fraction(df: DataFrame, rule: Column, n: str = "n", by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.sum(F.when(rule, F.col(n)).otherwise(0)).alias("good"), F.sum(n).alias("total")).withColumn("fraction", F.col("good") / F.col("total"))


def poly_tail_table(df: DataFrame, name: str = "seq_id", seq: str = "seq") -> DataFrame:
    return df.select(name, S.poly_tail_length(seq).alias("tail"), S.first_n_run(seq).alias("n_run"))


def minimum_quality(df: DataFrame, margin: int = 12, name: str = "read_id", qual: str = "qual") -> DataFrame:
    """Least quality inside the margins and all its 1-based positions."""
    def made(inner: Column) -> Column:
        at = lambda least: F.filter(F.transform(inner, lambda q, i: F.when(q == least, i + margin + 1)), lambda i: i.isNotNull())
        return S.bound(F.array_min(inner), lambda least: F.struct(least.alias("min_q"), at(least).alias("positions")))

    inner = S.bound(F.col(qual), lambda q: F.slice(q, F.lit(margin + 1), F.greatest(F.size(q) - 2 * margin, F.lit(0))))
    rows = df.filter(F.size(qual) > 2 * margin).select(name, S.bound(inner, made).alias("m"))
    return rows.select(name, "m.min_q", "m.positions")


def quality_below(df: DataFrame, q: int, name: str = "read_id", qual: str = "qual", seq: str = "seq", flank: int = 18) -> DataFrame:
    """(read, quality, positions, context): positions under q by quality, and the text around the first."""
    rows = df.select(name, seq, F.posexplode(qual).alias("p", "v")).filter(F.col("v") < q)
    grouped = rows.groupBy(name, "v").agg(F.array_sort(F.collect_list(F.col("p") + 1)).alias("positions"), F.first(seq).alias("s"))
    first = F.element_at("positions", 1)
    begin = F.greatest(first - flank, F.lit(1))
    return grouped.select(name, F.col("v").alias("quality"), "positions", F.substring(F.col("s"), begin, first + flank - begin + 1).alias("context"))


def merge_case(df: DataFrame, key: str = "key", n: str = "n", by: list[str] | None = None) -> DataFrame:
    """Lower-case keys (filled bases) are added to the upper-case ones; fractions are of the group."""
    merged = df.groupBy(*(by or []), F.upper(key).alias(key)).agg(F.sum(n).alias(n))
    return merged.withColumn("fraction", F.col(n) / F.sum(n).over(Window.partitionBy(*(by or []))))


def conflict_check(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys with more than one value of the columns together."""
    return df.groupBy(key).agg(F.count_distinct(F.struct(*columns)).alias("n")).filter("n > 1")


def rank_by_count(df: DataFrame, key: str, n: str = "n", by: list[str] | None = None, k: int | None = None) -> DataFrame:
    """rank by count descending, then key."""
    out = df.withColumn("rank", F.row_number().over(Window.partitionBy(*(by or [])).orderBy(F.desc(n), key)))
    return out.filter(F.col("rank") <= k) if k else out


def composition_bias(df: DataFrame, matrix: DataFrame, query: str = "query", target: str = "target", score: str = "score", unknown: float = -0.945, pseudo: float = 6.0, name: str = "pair_id", letters: str = "ARNDCQEGHILKMFPSTWYV") -> DataFrame:
    """(score - expected) / (score - length * unknown), expected from the compositions with pseudo-counts and a score matrix.

    matrix has (a, b, s) of all letter pairs. The length counts letters of the list only, of the shorter sequence.
    """
    def composition(text: str) -> list[Column]:
        n = [S.count_of(text, x).cast("double") + pseudo / len(letters) for x in letters]
        return n

    rows = df.select(name, score, F.least(*[F.length(F.regexp_replace(c, "[BZXbzx-]", "")) for c in (query, target)]).alias("len"), F.array(*composition(query)).alias("p"), F.array(*composition(target)).alias("q"))
    pairs = matrix.select(F.position(F.col("a"), F.lit(letters)).alias("i"), F.position(F.col("b"), F.lit(letters)).alias("j"), "s")
    table = pairs.filter("i > 0 and j > 0").agg(F.collect_list(F.struct("i", "j", "s")).alias("m"))  # one row of the matrix's fixed size
    total_p = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    total_q = F.aggregate("q", F.lit(0.0), lambda a, x: a + x)
    mean = F.aggregate("m", F.lit(0.0), lambda a, x: a + F.element_at("p", x["i"]) * F.element_at("q", x["j"]) * x["s"]) / (total_p * total_q)
    joined = rows.join(F.broadcast(table))
    expected = F.col("len") * mean
    return joined.select(name, expected.alias("expected"), ((F.col(score) - expected) / (F.col(score) - F.col("len") * unknown)).alias("bias"))
