"""Duplicates: by id, by sequence, by sequence on either strand, and unions without them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqframe.functions import sequence as S


def duplicate_ids(df: DataFrame, on: str = "seq_id") -> DataFrame:
    return df.groupBy(on).agg(F.count("*").alias("n")).filter("n > 1")


def unique_by_id(df: DataFrame, on: str = "seq_id", order: tuple[str, ...] = ("src", "ord")) -> DataFrame:
    """The first record of each id in file order: a minimum of structs, so partial results meet before the shuffle."""
    rest = [c for c in df.columns if c not in order and c != on]
    first = df.groupBy(on).agg(F.min(F.struct(*order, *rest)).alias("r"))
    return first.select(on, *[F.col(f"r.{c}").alias(c) for c in df.columns if c != on]).select(df.columns)


def unique_by_sequence(df: DataFrame, seq: str = "seq", name: str = "seq_id", order: tuple[str, ...] = ("src", "ord")) -> DataFrame:
    """One record for each distinct sequence: the first id, how many there were, and the other ids in order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(name).alias("id"))))
    g = df.groupBy(seq).agg(rows.alias("r"))
    ids = F.transform("r", lambda x: x["id"])
    return g.select(F.element_at(ids, 1).alias(name), seq, F.size("r").alias("n"), F.slice(ids, F.lit(2), F.greatest(F.size("r") - 1, F.lit(0))).alias("dropped"))


def _combined(rows: pa.Table) -> pa.Table:
    """Rows (k1, k2, n, m, sums, o, s) of a table by key: counts and sums by place added up, the first s by o; ordered by key."""
    k1, k2, o = (rows.column(c).to_numpy() for c in ("k1", "k2", "o"))
    order = np.lexsort((o, k2, k1))
    k1, k2 = k1[order], k2[order]
    first = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))[: len(order)]
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    lists = pa.concat_arrays(rows.column("sums").chunks).take(pa.array(order))
    sizes = np.asarray(lists.value_lengths()).astype(np.int64)
    wide = np.maximum.reduceat(sizes, first) if len(first) else sizes
    begin = np.cumsum(wide) - wide
    place = np.repeat(begin[group] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    total = np.zeros(int(wide.sum()), np.int64)
    np.add.at(total, place, np.asarray(lists.flatten()))
    added = lambda c: pa.array(np.add.reduceat(rows.column(c).to_numpy()[order], first) if len(first) else np.empty(0, np.int64))
    sums = pa.ListArray.from_arrays(pa.array(np.append(begin, len(total)).astype(np.int32)), pa.array(total))
    return pa.table([pa.array(k1[first]), pa.array(k2[first]), added("n"), added("m"), sums, pa.array(o[order[first]]), rows.column("s").combine_chunks().take(pa.array(order[first]))], names=["k1", "k2", "n", "m", "sums", "o", "s"])


def collapse_strands(df: DataFrame, seq: str = "seq", qual: str = "qual", order: str = "ord", least: int = 20) -> DataFrame:
    """(seq, n, qual): sequences equal to each other or to a reverse complement are one.

    The sequence is as first seen, n the number of copies, qual the mean at each position rounded up
    (reversed for copies of the other strand). Sequences under ``least`` long are left out. A sequence goes as one row with the sums of its
    qualities; copies meet in each batch before the shuffle and in the sorted partitions after it.
    """
    rc = S.revcomp(seq)
    rows = df.filter(F.length(seq) >= least).select(F.col(seq).alias("s"), F.col(qual).alias("q"), F.col(order).cast("long").alias("o"), F.least(F.col(seq), rc).alias("key"))
    values = F.transform(F.when(F.col("s") == F.col("key"), F.col("q")).otherwise(F.reverse("q")), lambda v: F.coalesce(v.cast("long"), F.lit(0)))
    # two hashes stand for the key
    one = rows.select(F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"), F.lit(1).cast("long").alias("n"), F.col("q").isNotNull().cast("long").alias("m"), F.coalesce(values, F.array().cast("array<long>")).alias("sums"), F.coalesce("o", F.lit(1 << 62)).alias("o"), "s")

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield from _combined(pa.Table.from_batches([batch])).to_batches()

    def all_of_a_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if len(batch):
                rows = pa.Table.from_batches([batch])
                rows = _combined(rows if held is None else pa.concat_tables([held, rows]))
                # the last key of a batch may go on in the next one
                yield from rows.slice(0, len(rows) - 1).to_batches()
                held = rows.slice(len(rows) - 1)
        if held is not None:
            yield from held.to_batches()

    schema = "k1 long, k2 long, n long, m long, sums array<long>, o long, s string"
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = one.mapInArrow(some, schema).repartition(n, "k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(all_of_a_key, schema)
    quals = F.transform("sums", lambda v: F.ceil(v / F.col("m")).cast("int"))
    return whole.select(F.col("s").alias("seq"), "n", F.when(F.col("s") == F.least(F.col("s"), S.revcomp("s")), quals).otherwise(F.reverse(quals)).alias("qual"))


def abundance_histogram(df: DataFrame, seq: str = "seq") -> DataFrame:
    """(copies, n_unique)"""
    return df.groupBy(seq).agg(F.count("*").alias("copies")).groupBy("copies").agg(F.count("*").alias("n_unique"))


def redundancy(df: DataFrame, seq: str = "seq") -> DataFrame:
    per = df.groupBy(seq).agg(F.count("*").alias("c"))
    return per.agg(F.sum("c").alias("total"), F.count("*").alias("n_unique")).withColumn("redundancy", F.col("total") / F.col("n_unique"))


def combine_unique(a: DataFrame, b: DataFrame, seq: str = "seq") -> DataFrame:
    """Distinct sequences of a, plus those of b that are not in a."""
    first = unique_by_sequence(a, seq)
    return first.unionByName(unique_by_sequence(b.join(a.select(seq), seq, "left_anti"), seq))


def merge_by_id(parts: list[DataFrame], on: str = "seq_id") -> DataFrame:
    """Union in which the first table with an id wins."""
    tagged = [p.withColumn("__part", F.lit(k)) for k, p in enumerate(parts)]
    whole = reduce(DataFrame.unionByName, tagged)
    return unique_by_id(whole, on, ("__part", "src", "ord")).drop("__part")


def concat_mates(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def first_rows(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("__r = 1").drop("__r")
