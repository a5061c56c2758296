"""Taxonomy: divisions of ids, descendants, routing by taxon, name repair."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.functions.sequence import col
from seqframe.sources.paths import shared_folder


def ids_in_divisions(ids: DataFrame, edges: DataFrame, divisions: list) -> DataFrame:
    """Distinct ids (gi) whose taxon (taxid) is in one of the divisions."""
    return ids.join(edges.filter(F.col("division").isin(divisions)).select("taxid"), "taxid").select("gi").distinct()


def sequences_in_divisions(seqs: DataFrame, ids: DataFrame, edges: DataFrame, divisions: list) -> DataFrame:
    return seqs.join(ids_in_divisions(ids, edges, divisions), "gi", "left_semi")


def route_by_taxonomy(entries: DataFrame, division_of: DataFrame, default: str = "unmapped", name: str = "entry_id", ids: str = "ids") -> DataFrame:
    """Each entry's division: that of its first id that has one, else ``unmapped``."""
    rows = entries.select(name, F.posexplode(ids).alias("at", "gi")).join(division_of, "gi")
    first = rows.groupBy(name).agg(F.min_by("division", "at").alias("division"))
    return entries.join(first, name, "left").withColumn("division", F.coalesce("division", F.lit(default)))


def below(edges: DataFrame, root: int) -> DataFrame:
    """(taxid): the root and all taxa under it, a join a level, each level written to the shared folder until one is empty."""
    spark = edges.sparkSession
    up = edges.select("taxid", F.col("parent"))
    level = edges.filter(F.col("taxid") == root).select("taxid").distinct()
    found = []
    while True:
        path = shared_folder(spark, "taxa")
        level.write.parquet(path)
        level = spark.read.schema("taxid " + dict(edges.dtypes)["taxid"]).parquet(path)
        if not level.head(1):
            return reduce(DataFrame.unionByName, found, level)
        found.append(level)
        # a taxon that is its own parent is no child
        level = up.join(level.withColumnRenamed("taxid", "parent"), "parent").filter(F.col("taxid") != F.col("parent")).select("taxid").distinct()


def is_descendant(taxa: DataFrame, edges: DataFrame, root: int) -> DataFrame:
    """taxa with ``descendant``: 1 below or at the root, 0 elsewhere, -1 for unknown taxa."""
    inside = below(edges, root).distinct().withColumn("__in", F.lit(1))
    known = edges.select("taxid").distinct().withColumn("__known", F.lit(1))
    out = taxa.join(known, "taxid", "left").join(inside, "taxid", "left")
    return out.withColumn("descendant", F.when(F.col("__known").isNull(), -1).otherwise(F.coalesce("__in", F.lit(0)))).drop("__in", "__known")


# Repairs of organism names, in order of use.
NAME_REPAIRS = ((r"^\s+|\s+$", ""), (r"\s+", " "), (r" (?:strain|str\.|isolate) .*$", ""), (r"(?i) Virus\b", " virus"), (r" sp\..*$", " sp."))


def repair_name(name: str | Column) -> Column:
    return reduce(lambda s, r: F.regexp_replace(s, *r), NAME_REPAIRS, col(name))


def non_members(seqs: DataFrame, names: DataFrame, edges: DataFrame, root: int) -> DataFrame:
    """Sequences whose repaired organism name is not below the root."""
    named = seqs.withColumn("__name", repair_name("organism")).join(names.select(F.col("name").alias("__name"), "taxid"), "__name", "left")
    placed = is_descendant(named, edges, root)
    return placed.filter(F.coalesce("descendant", F.lit(-1)) != 1).select(*seqs.columns)
