"""Windows along one sequence as long tables: complexity, pair scores, peaks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqframe.functions import sequence as S


def windows(df: DataFrame, score: Callable[[Column, Column], Column], window: int, name: str, seq: str) -> DataFrame:
    """(name, pos, total): sums of the scores of neighbouring letters in each window that fits, made within the row."""
    totals = S.sums(S.neighbours(F.upper(seq), score), window - 1)
    return df.filter(F.length(seq) >= window).select(name, F.posexplode(totals).alias("p", "total")).select(name, (F.col("p") + 1).alias("pos"), "total")


def sliding_complexity(df: DataFrame, window: int = 20, name: str = "seq_id", seq: str = "seq") -> DataFrame:
    """(name, pos, value): int(9 * changes / window) for each start whose window fits."""
    change = lambda a, b: ((a != b) & (a != "N") & (b != "N")).cast("int")
    return windows(df, change, window, name, seq).select(name, "pos", F.floor(9 * F.col("total") / window).cast("int").alias("value"))


def pair_score(df: DataFrame, base: str = "A", window: int = 10, name: str = "seq_id", seq: str = "seq") -> DataFrame:
    """(name, pos, value): (pairs of the base - other pairs) / 2 in each window; N matches."""
    score = lambda a, b: F.when(a.isin(base, "N") & b.isin(base, "N"), 1).otherwise(-1)
    return windows(df, score, window, name, seq).select(name, "pos", (F.col("total") / 2).alias("value"))


def find_peaks(series: DataFrame, base: float = 0, name: str = "seq_id") -> DataFrame:
    """(name, begin, end, area, height, top): islands of values of at least base that come after a value equal to base."""
    w = Window.partitionBy(name).orderBy("pos")
    high = F.col("value") >= base
    s = series.withColumn("h", high.cast("int")).withColumn("prev", F.lag("value").over(w))
    s = s.withColumn("start", F.when((F.col("h") == 1) & (F.coalesce(F.lag("h").over(w), F.lit(0)) == 0), 1).otherwise(0))
    s = s.withColumn("island", F.sum("start").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("h = 1")
    g = s.groupBy(name, "island").agg(F.min("pos").alias("begin"), F.max("pos").alias("end"), F.sum(F.col("value") - base).alias("area"), F.max("value").alias("height"), F.max(F.struct("value", -F.col("pos"))).alias("t"))
    return g.select(name, "begin", "end", "area", "height", (-F.col("t.col2")).alias("top"))


def max_peak(peaks: DataFrame, name: str = "seq_id") -> DataFrame:
    """The peak of largest area, the first of equals."""
    return peaks.groupBy(name).agg(F.max_by(F.struct("begin", "end", "area", "height", "top"), F.struct("area", -F.col("begin"))).alias("p")).select(name, "p.*")


def _islands(text: pa.Array, letter: str, window: int, base: float) -> tuple[np.ndarray, ...]:
    """(row, begin, end, area, height, top) of the islands of pair scores of all texts of a batch, 1-based; each text has at least ``window`` letters."""
    if not pc.all(pc.equal(pc.utf8_length(text), pc.binary_length(text))).as_py():
        text = pc.replace_substring_regex(text, "[^\\x00-\\x7F]", "?")  # one byte a letter
    size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(size) - size
    letters = np.frombuffer("".join(text.to_pylist()).encode(), np.uint8)
    like = (letters == ord(letter)) | (letters == ord("N"))
    total = np.concatenate([[0], np.cumsum(np.where(like[:-1] & like[1:], 1, -1))])
    fits = size - window + 1
    row = np.repeat(np.arange(len(size)), fits)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(fits) - fits, fits)
    at = first[row] + pos
    value = (total[at + window - 1] - total[at]) / 2
    high = value >= base
    row, pos, value = row[high], pos[high], value[high]
    begins = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (pos[1:] != pos[:-1] + 1))[: len(row)])
    if not len(begins):
        return row, pos, pos, value, value, pos
    ends = np.append(begins[1:], len(row)) - 1
    height = np.maximum.reduceat(value, begins)
    top = np.minimum.reduceat(np.where(value == np.repeat(height, ends - begins + 1), pos, pos.max()), begins)
    return row[begins], pos[begins] + 1, pos[ends] + 1, np.add.reduceat(value - base, begins), height, top + 1


def pair_peaks(df: DataFrame, letter: str = "A", window: int = 10, base: float = 0, name: str = "seq_id", seq: str = "seq", largest: bool = False) -> DataFrame:
    """(name, begin, end, area, height, top): ``find_peaks`` of ``pair_score``, made within the row; with ``largest`` only the ``max_peak`` of each."""
    kinds = {"begin": T.LongType(), "end": T.LongType(), "area": T.DoubleType(), "height": T.DoubleType(), "top": T.LongType()}
    rows = df.filter(F.length(seq) >= window).select(name, F.upper(seq).alias("__seq"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            made = _islands(batch.column(1), letter, window, base)
            if largest:
                order = np.lexsort((made[1], -made[3], made[0]))
                keep = order[np.append(True, made[0][order][1:] != made[0][order][:-1])[: len(order)]]
                made = tuple(m[keep] for m in made)
            columns = [pa.array(m, pa.float64() if c in ("area", "height") else pa.int64()) for c, m in zip(kinds, made[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(made[0])), *columns], names=[name, *kinds])

    return rows.mapInArrow(run, T.StructType([rows.schema[name], *[T.StructField(c, t) for c, t in kinds.items()]]))
