"""Search hits: consolidation, selection, best hits, taxonomy of hits."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: E-values below this are stored as 0.
TINY = 6e-171


class Disjoint:
    """Ranges of which no two meet, in order; empty ones (end before begin) meet nothing."""

    def __init__(self):
        self.begin: list[int] = []
        self.end: list[int] = []

    def meets(self, begin: int, end: int) -> bool:
        at = bisect_right(self.begin, end) - 1
        return begin <= end and at >= 0 and self.end[at] >= begin

    def add(self, begin: int, end: int) -> None:
        if begin <= end:
            at = bisect_right(self.begin, begin)
            self.begin.insert(at, begin)
            self.end.insert(at, end)


def keep_disjoint(hits: DataFrame, margin: int = 1) -> DataFrame:
    """hits with ``kept``: in file order a match is kept if it overlaps no kept match of its query and target.

    Ranges may touch by ``margin`` bases; an overlap of the query or the target range counts. Rows come sorted by
    query, target and order, so a task goes through all its pairs in one pass.
    """
    schema = T.StructType([*hits.schema.fields, T.StructField("kept", T.BooleanType())])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, on_query, on_target = None, Disjoint(), Disjoint()
        for pdf in batches:
            if pdf.empty:
                continue
            pair = list(zip(pdf["query"], pdf["target"], strict=True))
            new = np.array([x != y for x, y in zip(pair, [last, *pair[:-1]], strict=True)])
            # a first row is kept, and one that no other of its pair follows needs no index
            alone = new & np.append(new[1:], False)
            kept = np.ones(len(pdf), bool)
            ranges = [pdf[c].to_numpy() for c in ("qstart", "qend", "tstart", "tend")]
            for k in np.flatnonzero(~alone).tolist():
                if new[k]:
                    on_query, on_target = Disjoint(), Disjoint()
                # two ranges share over margin places if they still meet with margin off their ends
                a, b, c, d = (r[k] for r in ranges)
                a, b, c, d = min(a, b), max(a, b) - margin, min(c, d), max(c, d) - margin
                kept[k] = not (on_query.meets(a, b) or on_target.meets(c, d))
                if kept[k]:
                    on_query.add(a, b)
                    on_target.add(c, d)
            last = pair[-1]
            yield pdf.assign(kept=kept)

    n = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hits.repartition(n, "query", "target").sortWithinPartitions("query", "target", "ord").mapInPandas(fold, schema)


def consolidate_hits(hits: DataFrame, margin: int = 1) -> DataFrame:
    """One row for each query and target: length-weighted identity, sums of length and score, kept/total, least E, product of E."""
    return summarise_kept(keep_disjoint(hits, margin))


def summarise_kept(flagged: DataFrame) -> DataFrame:
    on = lambda c: F.sum(F.when(F.col("kept"), c))
    small = lambda c: F.when(c < TINY, F.lit(0.0)).otherwise(c)
    zero = F.max(F.when(F.col("kept") & (F.col("evalue") < TINY), 1).otherwise(0))
    logs = F.sum(F.when(F.col("kept") & (F.col("evalue") >= TINY), F.ln("evalue")))
    return flagged.groupBy("query", "target").agg(
        (on(F.col("identity") * F.col("length")) / on(F.col("length"))).alias("identity"),
        on(F.col("length")).alias("length"),
        on(F.col("score")).alias("score"),
        (on(F.lit(1)) / F.count("*")).alias("kept_ratio"),
        small(F.min(F.when(F.col("kept"), F.col("evalue")))).alias("min_evalue"),
        small(F.when(zero == 1, F.lit(0.0)).otherwise(F.exp(logs))).alias("evalue_product"),
        F.min("ord").alias("ord"),
    )


def select_hits(hits: DataFrame, score: float = 0.9, identity: float = 0.95, length: float = 0.7) -> DataFrame:
    """The first hit of a query, and those that score over score * top, or whose identity and length are over shares of the running maxima."""
    w = Window.partitionBy("query").orderBy("ord")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = hits.withColumn("__n", F.row_number().over(w)).withColumn("__s", F.first("score").over(w)).withColumn("__i", F.max("identity").over(running)).withColumn("__l", F.max("length").over(running))
    close = (F.col("identity") > identity * F.col("__i")) & (F.col("length") > length * F.col("__l"))
    return h.filter((F.col("__n") == 1) | (F.col("score") > score * F.col("__s")) | close).drop("__n", "__s", "__i", "__l")


def best_hit(hits: DataFrame) -> DataFrame:
    """The hit of each query with the highest score, then target, then file order."""
    w = Window.partitionBy("query").orderBy(F.desc("score"), "target", "ord")
    return hits.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def ortholog_hits(hits: DataFrame) -> DataFrame:
    return select_hits(consolidate_hits(hits))


def add_taxon(hits: DataFrame, taxa: DataFrame, on: str = "target", strict: bool = True) -> DataFrame:
    """Hits with the columns of their target's taxon; a target that is missing there is an error."""
    out = hits.join(taxa.withColumn("__known", F.lit(True)), on, "left")
    if strict:
        out = out.filter(F.when(F.col("__known").isNull(), F.raise_error(F.concat(F.lit("no taxon for "), F.col(on)))).otherwise(F.lit(True)))
    return out.drop("__known")


def taxonomy_map(hits: DataFrame, taxa: DataFrame) -> DataFrame:
    return best_hit(add_taxon(hits, taxa))
