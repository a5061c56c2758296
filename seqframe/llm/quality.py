"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of word characters and runs of other marks. Features are hashed
1- and 2-grams of lower-cased tokens, and 1- to 3-grams of token shapes (letter case,
digits, marks, length, repeats of the token one or two before), so that layout counts
even where every word is new. A text's feature values are its n-gram frequencies, and
its score is the logistic of a sparse dot product with the weights.

Training is on a sample of labelled rows of a documented bound (``max_rows``, taken by
seeded hash): the sample is dealt into ``shards`` by hash, each shard runs FTRL-proximal
over its rows in hash order until it has made ``updates`` steps, and the weights are averaged. All else covers all rows.

Null and empty texts have no features and score by the intercept. Label rows that are
null, or whose document is absent, teach nothing; of contradicting labels each counts.
Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import WORDS_AND_MARKS, Tokens, add_columns, field, mix, quoted, rolling, slices

BITS = 18
#: Features with these offsets belong to words and to shapes.
_GROUPS = ((1, "w"), (2, "w"), (1, "s"), (2, "s"), (3, "s"))
_CASE = np.zeros(256, np.int64)
_CASE[0x41:0x5B] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[0x30:0x3A] = 1


def shapes(t: Tokens) -> np.ndarray:
    """A small code for the look of each token."""
    if not len(t.start):
        return np.empty(0, np.uint64)
    upper = np.concatenate(([0], np.cumsum(_CASE[t.data])))
    digit = np.concatenate(([0], np.cumsum(_DIGIT[t.data])))
    n = t.end - t.start
    ups, digits = upper[t.end] - upper[t.start], digit[t.end] - digit[t.start]
    look = np.where(digits > 0, 3, np.where((ups > 1) & (2 * ups > n), 2, np.where(ups > 0, 1, 0)))
    mark = t.kind == 2
    look = np.where(mark, 4 + t.data[t.start].astype(np.int64) % 64, look)
    size = np.minimum(n, np.where(mark, 3, 16)) // np.where(mark, 1, 6)
    text = np.searchsorted(t.first, np.arange(len(n)), side="right")
    same = [np.zeros(len(n), bool), np.zeros(len(n), bool)]
    for k in (1, 2):
        same[k - 1][k:] = (t.hash[k:] == t.hash[:-k]) & (text[k:] == text[:-k])
    return (look + 128 * size + 1024 * (same[0] & ~mark) + 2048 * (same[1] & ~mark)).astype(np.uint64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, one text after the other, and where each text's begin; n-grams stay within their text."""
    t = Tokens(texts, WORDS_AND_MARKS)
    n, look = len(t.hash), shapes(t)
    text_end = np.repeat(t.first[1:], np.diff(t.first))
    columns = []
    for k, (size, kind) in enumerate(_GROUPS):
        grams = rolling(t.hash if kind == "w" else mix(look + np.uint64(1)), size)
        number = (mix(grams + np.uint64(k + 1)) >> np.uint64(64 - BITS)).astype(np.int64)
        # a gram over the end of its text is the one number that all texts share for it
        columns.append(np.where(np.arange(n) + size <= text_end, number, k))
    return (np.stack(columns, axis=1).reshape(-1) if n else np.empty(0, np.int64)), t.first * len(_GROUPS)


def train(rows: pd.DataFrame, updates: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """FTRL-proximal over rows (columns text, label); the weights, the intercept last."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    examples = []
    texts = pa.RecordBatch.from_arrays([pa.array(rows["text"].fillna(""), pa.string())], names=["t"])
    for part in slices(texts, "t"):
        numbers, first = features(part.column("t"))
        for a, b in zip(first[:-1], first[1:], strict=True):
            at, count = np.unique(numbers[a:b], return_counts=True)
            examples.append((np.append(at, size - 1).astype(np.int32), np.append(count * (len(_GROUPS) / max(1, count.sum())), 1.0).astype(np.float32)))
    labels = rows["label"].to_numpy(float)
    for _ in range(-(-updates // max(1, len(rows)))):
        for (at, x), y in zip(examples, labels, strict=True):
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(size))


def fit(docs: DataFrame, labels: DataFrame, learns: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 16_000, shards: int = 8, updates: int = 24_000, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01, seed: int = 5) -> np.ndarray:
    """Weights learnt from at most about max_rows of the labelled documents where ``learns`` (a Column on docs) holds."""
    known = labels.filter(F.col(quoted(label)).isNotNull()).select(F.col(quoted(doc_id)).alias("__id"), F.col(quoted(label)).cast("int").alias("label"))
    kept = F.least(F.lit(1.0), F.lit(float(max_rows)) / F.greatest(F.lit(1), F.lit(known.count())))
    lucky = F.xxhash64(F.lit(seed), "__id")
    known = known.filter(F.pmod(lucky, F.lit(1_000_000)) < kept * 1_000_000)
    rows = docs.filter(learns).select(F.col(quoted(doc_id)).alias("__id"), F.col(quoted(text)).alias("text")).join(known, "__id")
    rows = rows.select("__id", "text", "label", F.xxhash64(F.lit(seed + 1), "__id").alias("h")).withColumn("shard", F.pmod("h", F.lit(shards)))

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        w = train(pdf.sort_values(["h", "text", "label"], kind="stable"), updates, alpha, beta, l1, l2)
        return pd.DataFrame({"n": [len(pdf)], "w": [w.astype(np.float32).tobytes()]})

    parts = rows.groupBy("shard").applyInPandas(shard, "n long, w binary").collect()  # a fixed number of rows of fixed size
    out = np.zeros((1 << BITS) + 1)
    for part in sorted(parts, key=lambda r: (r["n"], r["w"])):
        out += np.frombuffer(part["w"], np.float32) / len(parts)
    return out.astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", name: str = "score", drop_text: bool = False) -> DataFrame:
    """docs with the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        w = shared.value

        def step(texts: pa.Array):
            numbers, first = features(texts)
            total = np.concatenate(([0.0], np.cumsum(w[numbers], dtype=np.float64)))
            dots = (total[first[1:]] - total[first[:-1]]) / np.maximum(1, np.diff(first)) * len(_GROUPS)
            return [pa.array(1 / (1 + np.exp(-np.clip(dots + w[-1], -35, 35))))]

        return step

    return add_columns(docs, text, [field(name, "double")], make, drop_text)


def crc(doc_id: str | Column, n: int) -> Column:
    """crc32 of an id's decimal text, modulo n; ids that are null count as empty text."""
    return F.crc32(F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit("")).cast("binary")) % n
