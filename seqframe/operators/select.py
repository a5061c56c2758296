"""Choosing and routing sequences: filters, id joins, splits, version picks, samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqframe.functions import sequence as S
from seqframe.sources.paths import shared_folder


def filter_length(df: DataFrame, least: int | None = None, most: int | None = None, inclusive: bool = False, seq: str = "seq") -> DataFrame:
    n = F.length(seq)
    if least is not None:
        df = df.filter(n >= least if inclusive else n > least)
    if most is not None:
        df = df.filter(n <= most if inclusive else n < most)
    return df


def filter_mean_quality(df: DataFrame, q: float = 20, qual: str = "qual") -> DataFrame:
    return df.filter(S.mean_quality(qual) > q)


def filter_accuracy(df: DataFrame, accuracy: float, qual: str = "qual") -> DataFrame:
    """Mean quality over that of the accuracy (0.1 to 1, 1 excluded)."""
    if not 0.1 <= accuracy < 1:
        raise ValueError("accuracy must be at least 0.1 and under 1")
    return df.filter(S.mean_quality(qual) > S.accuracy_to_q(F.lit(accuracy)))


def filter_title_contains(df: DataFrame, word: str, longer_than: int = 0, title: str = "title", seq: str = "seq") -> DataFrame:
    return df.filter(F.contains(F.lower(title), F.lit(word.lower())) & (F.length(seq) > longer_than))


def filter_title_not(df: DataFrame, word: str, longer_than: int = 0, title: str = "title", seq: str = "seq") -> DataFrame:
    return df.filter(~F.contains(F.lower(title), F.lit(word.lower())) & (F.length(seq) > longer_than))


def filter_title_any(df: DataFrame, words: list[str], title: str = "title") -> DataFrame:
    """Titles that hold any of the phrases, in either case."""
    return df.filter(reduce(lambda a, b: a | b, [F.contains(F.lower(title), F.lit(w.lower())) for w in words], F.lit(False)))


def filter_gc(df: DataFrame, op: str, x: float, longer_than: int = 0, seq: str = "seq") -> DataFrame:
    value = S.gc(seq)
    return df.filter({">": value > x, "<": value < x, ">=": value >= x, "<=": value <= x}[op] & (F.length(seq) > longer_than))


def filter_unambiguous(df: DataFrame, longer_than: int = 500, seq: str = "seq") -> DataFrame:
    return df.filter(S.is_unambiguous(seq) & (F.length(seq) > longer_than))


def filter_tag(df: DataFrame, tag: str = "rq", op: str = ">", x: float = 0.95, tags: str = "tags") -> DataFrame:
    """By a numeric tag; a row without the tag is an error."""
    value = F.try_element_at(F.col(tags), F.lit(tag)).cast("double")
    checked = F.when(value.isNull(), F.raise_error(F.lit(f"tag {tag} is missing"))).otherwise(value)
    return df.filter({"<": checked < x, ">": checked > x, "=": checked == x}[op])


def route(df: DataFrame, rules: list[tuple[str, Column]], default: str, name: str = "class") -> DataFrame:
    """df with the name of the first rule that holds: several outputs as one table, to be written by class."""
    out = F.lit(default)
    for label, rule in reversed(rules):
        out = F.when(rule, F.lit(label)).otherwise(out)
    return df.withColumn(name, out)


def split_definition(df: DataFrame, text: str = "GSS sequence,", definition: str = "definition") -> DataFrame:
    """Class ``match`` or ``rest``, and the gi number of the record."""
    return route(df, [("match", F.contains(F.col(definition), F.lit(text)))], "rest").withColumn("gi", S.gi_number(definition))


def split_organism(df: DataFrame, name: str, alias: str | None = None, organism: str = "organism") -> DataFrame:
    """Class ``match`` where the organism holds the name or its alias, which is rewritten to the name."""
    hit = F.contains(F.col(organism), F.lit(name))
    if alias:
        df = df.withColumn(organism, F.when(~hit, F.replace(F.col(organism), F.lit(alias), F.lit(name))).otherwise(F.col(organism)))
        hit = F.contains(F.col(organism), F.lit(name))
    return route(df, [("match", hit)], "rest")


# Lineage keywords of the built-in divisions, first match wins.
DIVISIONS = [
    ("sau", ["Archosauria", "Lepidosauria", "Testudines"]),
    ("plc", ["Eutheria"]),
    ("amp", ["Amphibia"]),
    ("bony", ["Actinopterygii", "Coelacanthiformes", "Dipnoi"]),
    ("cart", ["Chondrichthyes"]),
]


def split_lineage(df: DataFrame, divisions: list[tuple[str, list[str]]] = DIVISIONS, lineage: str = "lineage") -> DataFrame:
    """The first division one of whose keywords the lineage holds, else ``rest``."""
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(F.col(lineage), F.lit(w)) for w in words])
    return route(df, [(name, has(words)) for name, words in divisions], "rest", "division")


def residue_position_filter(df: DataFrame, regex: str, seq: str = "seq") -> DataFrame:
    """Proteins that match; ``residues`` has what the pattern's first group caught."""
    return df.filter(F.col(seq).rlike(regex)).withColumn("residues", F.regexp_extract(seq, regex, 1))


def classify_by_rules(df: DataFrame, negative: list[str], positive: list[str], keywords: list[str], motifs: list[str], title: str = "title", seq: str = "seq") -> DataFrame:
    """class 0 false, 1 true, 2 unknown, 3 unsure: title negatives, title positives, hypothetical, keywords, motifs, in order."""
    t = F.lower(title)
    any_of = lambda c, words: reduce(lambda a, b: a | b, [c.rlike(w) for w in words], F.lit(False))
    rules = F.when(any_of(t, negative), 0).when(any_of(t, positive), 1).when(F.contains(t, F.lit("hypothetical")), 2)
    return df.withColumn("class", rules.when(any_of(t, keywords), 1).when(any_of(F.col(seq), motifs), 1).otherwise(3))


def alignment_pass(level: str = "qc", identity_cut: float = 0.95) -> Column:
    """Whether an alignment row is good enough: ``qc`` to absorb, ``salvage`` to keep."""
    c = F.col
    best = F.greatest("cov_ref", "cov_read")
    if level == "qc":
        single = (c("gaplen_ref") == c("gaps_ref")) & (c("gaplen_read") == c("gaps_read"))
        return (c("alnlen") >= 200) & (c("identity") >= identity_cut) & (((c("identity") > 0.989) & (best > 0.8)) | (single & (c("nogap_identity") > 0.989)))
    return ((c("identity") > 0.99) & (c("alnlen") > 200)) | ((best > 0.9) & (c("identity") > identity_cut))


def site_match(identity: float = 0.88, length: int = 16, coverage: float = 0.7) -> Column:
    return (F.col("identity") > identity) & (F.col("alnlen") > length) & (F.col("cov_ref") > coverage)


def bad_site() -> Column:
    return (F.col("identity") < 0.92) | (F.col("gaps_ref") > 2) | (F.col("gaps_read") > 2)


def route_alignment_quality(df: DataFrame, first: str = "q1", second: str = "q2") -> DataFrame:
    """good if either text says VERY HIGH or HIGH NOGAP, else partial, else none if both have no common column, else bad."""
    has = lambda w, both=False: (F.contains(F.col(first), F.lit(w)) & F.contains(F.col(second), F.lit(w))) if both else (F.contains(F.col(first), F.lit(w)) | F.contains(F.col(second), F.lit(w)))
    return route(df, [("good", has("VERY HIGH") | has("HIGH NOGAP")), ("partial", has("PARTIAL")), ("none", has("NO COMMON", True))], "bad")


# Shapes of runs of identities (|) and similarities (:) in good alignments; for simple sequences a stricter list.
GOOD_SPACERS = (
    r"\|{12,}",
    r"\|{4,}.{1,20}?\|:\|{11,}.{1,2}?\|{1,}.{1,20}?\|{4,}",
    r"\|{10,}.{1,200}?\|{10,}",
    r"\|{7,}.{1,100}?\|{10,}.{1,100}?\|{7,}",
    r"(\|{8,}.{1,200}?){3}",
    r"(\|{6,}.{1,100}?){4}",
    r"\|{9,}.{1,20}?\|{9,}:\|{9,}:\|{1,}?",
    r"[\|:]{26,}.{1,10}?\|{4,}",
    r"\|{6,}.{1,2}?\|{6,}:\|{1,}",
    r"(\|{4,}.{1,100}?){6,}",
    r"\|{4,}.{1,50}?(\|{6,}.{1,100}?){2}.{1,100}?\|{4,}",
)
GOOD_SIMPLE_SPACERS = (r"\|{14,}", r"\|{10,}.+\|{10,}", r"(\|{8,}.+){3}", r"(\|{3,}.){3,}.{1,10}?[\|:]{19,}", r"(\|{6,}.+){4}")


# Simple stretches of proteins, whose alignments need more.
SIMPLE_PROTEIN = (
    "S{10,}", "T{10,}", "Q{10,}", "(T.A){9,}", "[TA]{15,}", "[SN]{20,}", "[SD]{20,}", "(T.{1,2}){10,}", "(G..){12,}", "(P.D){9,}", "(A+.{1,4}){20,}",
    "(SS.){10,}", "((S+).{1,2}){10,}", "([QE]+.){10,}", "([TS]+.){10,}", "(Q+.{1,3}){9,}", "(TT.{4}){10,}", "(TTT.{3}){10,}", "(T.P){10,}",
)


def any_of(text: str | Column, rules: tuple[str, ...]) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return reduce(lambda a, b: a | b, [t.rlike(r) for r in rules])


def classify_alignment(df: DataFrame, simple: tuple[str, ...] = SIMPLE_PROTEIN, query: str = "query_text", target: str = "target_text", spacer: str = "spacer", identity: str = "identity") -> DataFrame:
    """good, high-simple or bad, by the shape of the match line; alignments of simple sequences need more. Gaps count as letters of the texts."""
    is_simple = any_of(query, simple) | any_of(target, simple)
    high = (F.col(identity) > 0.95) | any_of(spacer, GOOD_SIMPLE_SPACERS)
    return route(df, [("high-simple", is_simple & high), ("bad", is_simple), ("good", any_of(spacer, GOOD_SPACERS) | (S.sliding_identity(spacer) > 0.6))], "bad")


# ------------------------------------------------------------ hits of a query


def drop_low_top_hit(hits: DataFrame, score: float = 40, query: str = "query", value: str = "score", order: str = "ord") -> DataFrame:
    """Queries whose first hit scores over the cut, with all their hits."""
    first = F.first(value).over(Window.partitionBy(query).orderBy(order))
    return hits.withColumn("__first", first).filter(F.col("__first") > score).drop("__first")


def relative_hit_filter(hits: DataFrame, ratio: float = 0.4, identity: float = 29, overlap: float = 0.35) -> DataFrame:
    """No self hits; queries go whose first hit has identity and overlap of both lengths under the cuts; hits of less than ratio of the top score go."""
    w = Window.partitionBy("query").orderBy("ord")
    own = hits.filter(F.col("query") != F.col("target"))
    own = own.withColumn("__s", F.first("score").over(w)).withColumn("__i", F.first("identity").over(w)).withColumn("__o", F.first("overlap").over(w))
    return own.filter(~((F.col("__i") < identity) & (F.col("__o") < overlap)) & (F.col("score") / F.col("__s") > ratio)).drop("__s", "__i", "__o")


# ------------------------------------------------------------ ids


def pick_by_id(df: DataFrame, ids: DataFrame, on: str = "seq_id") -> DataFrame:
    return df.join(ids.select(on).distinct(), on, "left_semi")


def pick_first_by_id(df: DataFrame, ids: DataFrame, on: str = "seq_id", order: tuple[str, ...] = ("src", "ord")) -> DataFrame:
    """An id is used up at its first match in file order."""
    from seqframe.operators.dedupe import unique_by_id

    return unique_by_id(pick_by_id(df, ids, on), on, order)


def discard_by_id(df: DataFrame, ids: DataFrame, on: str = "seq_id", least: int = 0, seq: str = "seq") -> DataFrame:
    return df.join(ids.select(on).distinct(), on, "left_anti").filter(F.length(seq) >= least)


def split_by_id(df: DataFrame, ids: DataFrame, on: str = "seq_id") -> DataFrame:
    """class ``removed`` for named sequences, else ``saved``."""
    named = ids.select(on).distinct().withColumn("__hit", F.lit(True))
    return df.join(named, on, "left").withColumn("class", F.when(F.col("__hit"), "removed").otherwise("saved")).drop("__hit")


def pick_new_versions(new: DataFrame, old: DataFrame, key: str = "accession", version: str = "version") -> DataFrame:
    """Records whose key is unknown, or known with a smaller version; a missing version is 1."""
    known = old.select(F.col(key), F.coalesce(F.col(version), F.lit(1)).alias("__old")).groupBy(key).agg(F.max("__old").alias("__old"))
    return new.join(known, key, "left").filter(F.col("__old").isNull() | (F.coalesce(F.col(version), F.lit(1)) > F.col("__old"))).drop("__old")


def unseen_ids(old: DataFrame, new: DataFrame, key: str = "accession") -> DataFrame:
    return old.select(key).distinct().join(new.select(key), key, "left_anti")


def compare_read_sets(old: DataFrame, new: DataFrame, on: str = "read_id") -> DataFrame:
    """id, length and mean quality in both sets; 0 where a read is absent."""
    side = lambda df, p: df.select(on, F.length("seq").alias(f"{p}_len"), S.mean_quality("qual").alias(f"{p}_q"))
    both = side(old, "old").join(side(new, "new"), on, "full_outer")
    return both.select(on, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("old_len", "old_q", "new_len", "new_q")])


def id_difference(a: DataFrame, b: DataFrame, on: str = "seq_id") -> DataFrame:
    """(id, side): ``a`` or ``b`` for ids in one only, ``both`` for shared ones."""
    x = a.select(on).distinct().withColumn("__a", F.lit(1))
    y = b.select(on).distinct().withColumn("__b", F.lit(1))
    side = F.when(F.col("__b").isNull(), "a").when(F.col("__a").isNull(), "b").otherwise("both")
    return x.join(y, on, "full_outer").select(on, side.alias("side"))


def shared_ids(a: DataFrame, b: DataFrame, on: str = "seq_id") -> DataFrame:
    return a.select(on).intersect(b.select(on))


def only_in_first(a: DataFrame, b: DataFrame, on: str = "seq_id") -> DataFrame:
    return a.select(on).distinct().join(b.select(on), on, "left_anti")


missing_outputs = only_in_first


# ------------------------------------------------------------ names and numbers


def places(df: DataFrame, order: tuple[str, ...], name: str = "__place") -> DataFrame:
    """df with the place (from 1) of each row in the order of all: dealt by ranges, ranked in each, and offset by the ranges before it.

    The ranges are written once, so that a second look finds the same ones.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "places")
    df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__part", T.IntegerType())])).parquet(path)
    before = dealt.groupBy("__part").agg(F.count("*").alias("__n"))  # one row a range
    before = before.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return dealt.withColumn(name, own).join(F.broadcast(before), "__part").withColumn(name, F.col(name) + F.col("__before")).drop("__part", "__before")


def renumber(df: DataFrame, prefix: str, name: str = "seq_id", title: str = "title", order: tuple[str, ...] = ("src", "ord")) -> DataFrame:
    """Names become prefix + place in file order; the old name goes before the title. No task sorts everything, nor one whole file."""
    out = places(df, order)
    return out.withColumn(title, F.concat_ws(" ", name, title)).withColumn(name, F.concat(F.lit(prefix), F.col("__place").cast("string"))).drop("__place")


def renumber_mates(df: DataFrame, prefix: str, name: str = "read_id", order: str = "ord") -> DataFrame:
    """Mates ``id/1`` and ``id/2`` share a counter by first appearance: prefix + n + ``_strand``."""
    base, mate = F.regexp_extract(name, r"^(.*)/[12]$", 1), F.regexp_extract(name, r"/([12])$", 1)
    first = df.groupBy(base.alias("__base")).agg(F.min(order).alias("__first"))
    numbered = places(first, ("__first", "__base"), "__n")
    return df.withColumn("__base", base).join(numbered, "__base").withColumn("new_id", F.concat(F.lit(prefix), F.col("__n").cast("string"), F.lit("_"), mate)).drop("__base", "__first", "__n")


def swap_title_id(df: DataFrame, clone: str = r"^([A-Za-z]+\d\S*)", name: str = "seq_id", title: str = "title") -> DataFrame:
    """A title that begins with a clone id gives the name; the old id goes to the title as gi_id."""
    found = F.regexp_extract(title, clone, 1)
    rest = F.trim(F.regexp_replace(title, clone, ""))
    return df.select(*[c for c in df.columns if c not in (name, title)], F.when(found != "", found).otherwise(F.col(name)).alias(name), F.when(found != "", F.concat(rest, F.lit(" gi_"), F.col(name))).otherwise(F.col(title)).alias(title))


def sample_exact(df: DataFrame, n: int, seed: int = 0, key: str = "seq_id") -> DataFrame:
    """Exactly n rows without replacement (all, if there are fewer), by hash order."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key, F.xxhash64(*df.columns)).limit(n)


def sample_sizes(df: DataFrame, sizes: list[int], repeats: int = 1, seed: int = 0, key: str = "seq_id") -> DataFrame:
    """Independent samples of several sizes, r times each: one table with columns size and repeat."""
    parts = [sample_exact(df, n, seed * 10_007 + 31 * k + r, key).withColumn("size", F.lit(n)).withColumn("repeat", F.lit(r)) for k, n in enumerate(sizes) for r in range(repeats)]
    return reduce(DataFrame.unionByName, parts)


def head_fraction(df: DataFrame, fraction: float = 0.5, size: Column | None = None, order: tuple[str, ...] = ("src", "ord")) -> DataFrame:
    """The first records of each file whose running size is within the fraction of the file's: dealt by ranges as in ``places``, so no task reads a whole file."""
    spark, path, file = df.sparkSession, shared_folder(df.sparkSession, "heads"), order[0]
    sized = df.withColumn("__size", (size if size is not None else F.length("seq")).cast("long"))
    sized.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema(T.StructType([*sized.schema.fields, T.StructField("__part", T.IntegerType())])).parquet(path)
    ranges = dealt.groupBy(F.col(file).alias("__file"), F.col("__part").alias("__range")).agg(F.sum("__size").alias("__n"))  # one row a file and range
    w = Window.partitionBy("__file")
    ranges = ranges.select("__file", "__range", F.sum("__n").over(w).alias("__all"), F.coalesce(F.sum("__n").over(w.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = F.sum("__size").over(Window.partitionBy("__part", file).orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, 0))
    joined = dealt.withColumn("__run", own).join(ranges, F.col(file).eqNullSafe(F.col("__file")) & (F.col("__part") == F.col("__range")))
    return joined.filter(F.col("__run") + F.col("__before") <= fraction * F.col("__all")).select(*df.columns)


def bucket_by_bases(df: DataFrame, limit: int = 4_000_000_000, file: str = "src", seq: str = "seq") -> DataFrame:
    """(file, bases, bucket): files in order; a bucket closes once it has passed the limit."""
    sizes = df.groupBy(file).agg(F.sum(F.length(seq)).cast("long").alias("bases"))
    steps = sizes.agg(F.sort_array(F.collect_list(F.struct(file, "bases"))).alias("files"))  # one row a file
    start = F.struct(F.lit(0).cast("long").alias("run"), F.lit(0).alias("bucket"), F.array().cast(f"array<struct<{file}:string,bases:long,bucket:int>>").alias("out"))

    def add(state: Column, f: Column) -> Column:
        total = state["run"] + f["bases"]
        done = F.concat(state["out"], F.array(F.struct(f[file].alias(file), f["bases"].alias("bases"), state["bucket"].alias("bucket"))))
        return F.struct(F.when(total > limit, F.lit(0).cast("long")).otherwise(total).alias("run"), (state["bucket"] + (total > limit).cast("int")).alias("bucket"), done.alias("out"))

    return steps.select(F.explode(F.aggregate("files", start, add, lambda s: s["out"])).alias("f")).select("f.*")
