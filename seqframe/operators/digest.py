"""Restriction digests: where enzymes cut sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.sources.paths import spread


def choose(enzymes: DataFrame, kind: str | None = None, weight_over: float | None = None, weight: float | None = None, names: list[str] | None = None) -> DataFrame:
    """Enzymes of one type, by the weight of their site, or by name."""
    rule: Column = F.lit(True)
    if kind is not None:
        rule = rule & (F.col("type") == kind)
    if weight_over is not None:
        rule = rule & (S.site_weight("site") > weight_over)
    if weight is not None:
        rule = rule & (F.abs(S.site_weight("site") - weight) < 1e-9)
    if names is not None:
        rule = rule & F.col("name").isin(*names)
    return enzymes.filter(rule)


def site_words(site: Column) -> Column:
    """Every unambiguous word that a site or its reverse complement stands for."""
    words = F.array(F.lit(""))
    codes = F.create_map(*[F.lit(x) for code, letters in S.IUPAC.items() for x in (code, letters.strip("[]"))])

    def grow(acc: Column, c: Column) -> Column:
        letters = F.coalesce(F.try_element_at(codes, c), c)
        return F.flatten(F.transform(acc, lambda w: F.transform(F.filter(F.split(letters, ""), lambda x: x != ""), lambda x: F.concat(w, x))))

    def every(text: Column) -> Column:
        return F.aggregate(F.filter(F.split(F.upper(text), ""), lambda x: x != ""), words, grow)

    return F.array_distinct(F.concat(every(site), every(S.revcomp(site))))


def expanded_sites(enzymes: DataFrame) -> DataFrame:
    """(name, word): every unambiguous word that a site or its reverse complement stands for."""
    return enzymes.select("name", F.explode(site_words(F.col("site"))).alias("word"))


#: So many words of sites are sent to all tasks; more meet the pieces of sequences in a shuffle.
SENT_WORDS = 10_000


def digest(seqs: DataFrame, enzymes: DataFrame, name: str = "seq_id", seq: str = "seq") -> DataFrame:
    """(seq_id, name, pos): 1-based starts of the sites of every enzyme in every sequence.

    Words of the sites' lengths are looked up by an equi-join, so no sequence meets every enzyme.
    """
    words = expanded_sites(enzymes)
    sizes = words.groupBy(F.length("word")).count().collect()  # a handful of site lengths
    lengths = [r[0] for r in sizes]
    if sum(r[1] for r in sizes) <= SENT_WORDS:
        words = F.broadcast(words)
    s = F.upper(seq)
    at = lambda n: F.when(F.length(s) >= n, F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.struct(i.alias("pos"), F.substring(s, i, F.lit(n)).alias("word")))).otherwise(F.array().cast("array<struct<pos:int,word:string>>"))
    if not lengths:
        return seqs.select(name, F.lit("").alias("name"), F.lit(0).alias("pos")).limit(0)
    pieces = spread(seqs.select(name, seq)).select(name, F.explode(F.concat(*[at(n) for n in sorted(lengths)])).alias("p")).select(name, "p.pos", "p.word")
    return pieces.join(words, "word").select(name, "name", "pos").distinct()


def cuts_by_enzyme(cuts: DataFrame, name: str = "seq_id") -> DataFrame:
    return cuts.groupBy(name, "name").agg(F.array_sort(F.collect_list("pos")).alias("positions"))


def cuts_by_position(cuts: DataFrame, name: str = "seq_id") -> DataFrame:
    return cuts.groupBy(name, "pos").agg(F.array_sort(F.collect_list("name")).alias("enzymes"))


def site_classes(enzymes: DataFrame) -> DataFrame:
    """(name, sites): the sites of each enzyme, sorted; enzymes with the same ones cut at the same places."""
    return enzymes.groupBy("name").agg(F.array_sort(F.collect_set(F.upper("site"))).alias("sites"))


def _site_cuts(seqs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """(seq_id, site, pos) of each different site once, whatever the number of enzymes that have it; no row comes twice."""
    sites = classes.select(F.explode("sites").alias("site")).distinct()
    return digest(seqs, sites.select(F.col("site").alias("name"), "site"), name).withColumnRenamed("name", "site")


def cut_counts(seqs: DataFrame, enzymes: DataFrame, name: str = "seq_id") -> DataFrame:
    """(name, n_cuts) of the enzymes that cut at all: places are counted by classes of enzymes with the same sites."""
    named = site_classes(enzymes)
    classes = named.select("sites").distinct()
    cuts = _site_cuts(seqs, classes, name)
    # of a class of one site every cut is a place of its own; only where there are more two cuts may be one place
    one = cuts.groupBy("site").agg(F.count("*").alias("n_cuts")).select(F.array("site").alias("sites"), "n_cuts")
    several = classes.filter(F.size("sites") > 1).select("sites", F.explode("sites").alias("site"))
    more = cuts.join(several, "site").select("sites", name, "pos").distinct().groupBy("sites").agg(F.count("*").alias("n_cuts"))
    return named.join(one.join(classes, "sites", "left_semi").unionByName(more), "sites").select("name", "n_cuts")


def _classes_not_cutting(seqs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """seq_id and ``classes``, the rows of classes (sites, and more) without a site in the sequence; a sequence is looked through within its row."""
    known = classes.withColumn("words", F.flatten(F.transform("sites", site_words)))
    every = known.agg(F.collect_list(F.struct(*known.columns)).alias("every"))  # one row: as many entries as there are different sites
    rows = spread(seqs.select(name, F.upper("seq").alias("text"))).join(F.broadcast(every))
    cuts = lambda c: F.coalesce(F.exists(c["words"], lambda w: F.contains(F.col("text"), w)), F.lit(False))
    return rows.select(name, F.filter("every", lambda c: ~cuts(c)).alias("classes"))


def not_cutting(seqs: DataFrame, enzymes: DataFrame, name: str = "seq_id") -> DataFrame:
    """(seq_id, name) of enzymes without a site in the sequence."""
    named = site_classes(enzymes)
    left = _classes_not_cutting(seqs, named.select("sites").distinct(), name)
    return left.select(name, F.explode("classes").alias("c")).select(name, "c.sites").join(named, "sites").select(name, "name")


def not_cutting_counts(seqs: DataFrame, enzymes: DataFrame, name: str = "seq_id") -> DataFrame:
    """(seq_id, n): the number of enzymes without a site in the sequence, where there are any; no pair of both is made."""
    left = _classes_not_cutting(seqs, site_classes(enzymes).groupBy("sites").agg(F.count("*").alias("n")), name)
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda a, c: a + c["n"])
    return left.select(name, total.alias("n")).filter("n > 0")
