"""Hard negatives by Fagin's threshold algorithm over integer vectors.

Rows are dealt by hash into shards of at most about SHARD_ROWS rows, so a label that a third of all rows have makes no large
group; anchors are dealt into groups of at most about GROUP_ROWS. Each (shard, group) is one
task: every dimension has a list of the shard's rows sorted by their component there. An anchor reads the list of each dimension from
the end that its sign favours (sorted access), scores each row that it meets for the first time by its whole
vector (random access), and knows that no row not yet met scores more than the threshold, the sum of its products with the last
components read. It stops once the threshold lies strictly below the k-th score of every window, so equal
scores are not lost, or below a window's lower bound. The shards' best are merged by windows.

Two passes: the positives (best rows of the anchor's label, found in lists of that label alone), then the negatives of every positive's window.

Rows with a null label, a null vector or a null component take no part. Vectors of unequal length count as if filled up with zeros.
Ids may be null (last among ties) and may repeat: each row counts for itself, an anchor is no positive of its own, copies of it
are. Scores are exact; if they could pass 63 bits an OverflowError is raised. Empty tables give an empty result, as do anchors without
other rows of their label. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.common import quoted, small_batches, written

#: Rows in a shard and anchors in a group, about. There are LEAST shards or more where a shard keeps a thousand rows.
SHARD_ROWS, GROUP_ROWS, LEAST = 32_768, 4_096, 12
#: Depth of the first round of sorted access; each round goes half as deep again.
FIRST_DEPTH = 8
POSITIVES = "arow long, anchor_id long, alabel int, prow long, positive_id long, positive_score long"
NEGATIVES = "arow long, anchor_id long, prow long, positive_id long, positive_score long, nrow long, negative_id long, negative_score long"


def quantised(vector: str | Column, factor: float = 256.0) -> Column:
    """floor(factor * x) of every component, null if the vector or a component is null, not a number or infinite."""
    vector = F.col(quoted(vector)) if isinstance(vector, str) else vector
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(factor) * x.cast("double")).cast("long")))


class Lists:
    """Rows with, for each dimension, their order by its component."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.met = 0

    def rounds(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(rows met for the first time, their scores, threshold) after each round; the last threshold is -inf.

        A consumer that needs nothing at or below a threshold stops there.
        """
        n = len(self.vectors)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):  # every score is 0
            self.met += n
            yield np.arange(n), np.zeros(n, anchor.dtype), -np.inf
            return
        seen, done, depth = np.zeros(n, bool), 0, FIRST_DEPTH
        while done < n:
            depth = min(n, depth)
            mark = np.zeros(n, bool)
            mark[self.order[n - depth : n - done, up].ravel()] = True
            mark[self.order[done:depth, down].ravel()] = True
            mark &= ~seen
            seen |= mark
            new = np.flatnonzero(mark)
            self.met += len(new)
            bound = anchor[up] @ self.vectors[self.order[n - depth, up], up] + anchor[down] @ self.vectors[self.order[depth - 1, down], down]
            done = depth
            over = done == n or seen.all()
            yield new, self.vectors[new] @ anchor, -np.inf if over else bound
            if over:
                return
            depth += max(1, depth // 2)

    def best(self, anchor: np.ndarray, k: int, order: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best rows but skip, best first; of equal scores the least place in order goes first."""
        rows, scores = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        for new, made, bound in self.rounds(anchor):
            other = new != skip
            rows, scores = _first(np.append(rows, new[other]), np.append(scores, made[other]), k, order)
            if len(rows) == k and bound < scores[-1]:
                break
        return rows, scores

    def within(self, anchor: np.ndarray, windows: list[tuple[int, int]], k: int, order: np.ndarray, allowed: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each (least, greatest) score the k best allowed rows in between, best first."""
        kept = [(np.empty(0, np.int64), np.empty(0, self.vectors.dtype)) for _ in windows]
        live = [i for i, (low, high) in enumerate(windows) if low <= high]
        if not live:
            return kept
        for new, made, bound in self.rounds(anchor):
            own = allowed[new]
            new, made = new[own], made[own]
            for i in live:
                low, high = windows[i]
                fits = (made >= low) & (made <= high)
                if fits.any():
                    kept[i] = _first(np.append(kept[i][0], new[fits]), np.append(kept[i][1], made[fits]), k, order)
            live = [i for i in live if not (bound < windows[i][0] or len(kept[i][0]) == k and bound < kept[i][1][-1])]
            if not live:
                break
        return kept


def _first(rows: np.ndarray, scores: np.ndarray, k: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(rows) > 4 * k:
        keep = scores >= np.partition(scores, -k)[-k]
        rows, scores = rows[keep], scores[keep]
    at = np.lexsort((order[rows], -scores))[:k]
    return rows[at], scores[at]


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    sizes = np.asarray(lists.value_lengths(), np.int64)
    flat = np.asarray(lists.flatten(), np.int64)
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max([0, *(np.asarray(c.value_lengths()).max(initial=0) for column in columns for c in column.chunks)])


def _exact(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where every sum of products is below 2**53, else as integers."""
    largest = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (rows, anchors)]
    most = largest[0] * largest[1] * max(1, rows.shape[1])
    if most < 1 << 53:
        return rows.astype(np.float64), anchors.astype(np.float64)
    if most >= 1 << 63:
        raise OverflowError("scores of these vectors may pass 63 bits")
    return rows, anchors


def _shard(rows: pa.Table, anchors: pa.Table) -> tuple[Lists, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Lists of the shard, the anchors' vectors, the shard's row numbers, its order of ties, its ids."""
    width = _width(rows.column("v"), anchors.column("v"))
    vectors, wanted = _exact(_matrix(rows.column("v"), width), _matrix(anchors.column("v"), width))
    ids = pa.concat_arrays(rows.column("id").chunks)
    number = rows.column("row").to_numpy()
    tie = np.empty(len(ids), np.int64)
    tie[np.lexsort((number, ids.fill_null(0).to_numpy(zero_copy_only=False), ~ids.is_valid().to_numpy(zero_copy_only=False)))] = np.arange(len(ids))
    return vectors, wanted, number, tie, ids


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(rows) and len(anchors):
            vectors, wanted, number, tie, ids = _shard(rows, anchors)
            label = rows.column("label").to_numpy()
            own, arow, aid = anchors.column("label").to_numpy(), anchors.column("row").to_numpy(), anchors.column("id").to_pylist()
            for value in np.unique(own):
                here = np.flatnonzero(label == value)
                if not len(here):
                    continue
                lists = Lists(vectors[here])
                for q in np.flatnonzero(own == value):
                    found, scores = lists.best(wanted[q], k, tie[here], _place(number[here], arow[q]))
                    out += [(arow[q], aid[q], value, number[here[x]], ids[int(here[x])].as_py(), int(s)) for x, s in zip(found, scores, strict=True)]
        return _rows(out, POSITIVES)

    return run


def _negatives(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(rows) and len(anchors):
            vectors, wanted, number, tie, ids = _shard(rows, anchors)
            label, lists = rows.column("label").to_numpy(), Lists(vectors)
            for q, anchor in enumerate(anchors.select(["row", "id", "label", "positives"]).to_pylist()):
                score = [p["positive_score"] for p in anchor["positives"]]
                windows = [(-(-low * s // 100), high * s // 100) for s in score]
                each = dict(zip(distinct := sorted(set(windows)), lists.within(wanted[q], distinct, k, tie, label != anchor["label"]), strict=True))
                for p, w in zip(anchor["positives"], windows, strict=True):
                    out += [(anchor["row"], anchor["id"], p["prow"], p["positive_id"], p["positive_score"], number[x], ids[int(x)].as_py(), int(s)) for x, s in zip(*each[w], strict=True)]
        return _rows(out, NEGATIVES)

    return run


def _place(numbers: np.ndarray, number: int) -> int:
    at = np.flatnonzero(numbers == number)
    return int(at[0]) if len(at) else -1


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*[x.split() for x in schema.split(", ")], strict=True)
    kind = {"int": pa.int32(), "long": pa.int64()}
    return pa.table({n: pa.array([r[i] for r in rows], kind[t]) for i, (n, t) in enumerate(zip(names, kinds, strict=True))})


def _met(rows: DataFrame, anchors: DataFrame, shards: int, groups: int, run, schema: str) -> DataFrame:
    """run on every shard with every group of anchors."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("group", every(groups)).groupBy("shard", "group")
    dealt = anchors.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).withColumn("shard", every(shards))
    return left.cogroup(dealt.groupBy("shard", "group")).applyInArrow(run, schema)


def _ranked(found: DataFrame, by: list[str], score: str, id: str, row: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc_nulls_last(id), row)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, vec_id: str = "vec_id", vector: str = "vector", label: str = "label", shard_rows: int = SHARD_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows where anchor holds.

    vector is an array of integers. For each of an anchor's first ``positives`` other rows of its label: the first
    ``negatives`` rows of other labels whose score is from low to high percent of the positive's.
    """
    spark = rows.sparkSession
    small_batches(spark)
    v = F.col(quoted(vector))
    plain = rows.filter(F.col(quoted(label)).isNotNull() & F.forall(v, lambda x: x.isNotNull()))
    plain = plain.select(F.monotonically_increasing_id().alias("row"), F.col(quoted(vec_id)).cast("long").alias("id"), F.col(quoted(label)).cast("int").alias("label"), v.cast("array<long>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    stored = written(plain, "vectors")  # row numbers are fixed from here on
    size = stored.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors")).first()
    shards = max(1, -(-size["n"] // shard_rows), min(LEAST, size["n"] // 1024))
    groups = max(1, -(-size["anchors"] // group_rows))
    dealt = stored.select("row", "id", "label", "v", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"))
    asked = written(stored.filter("anchor").select("row", "id", "label", "v"), "anchors")

    found = _met(dealt, asked, shards, groups, _positives(positives), POSITIVES)
    first = _ranked(found, ["arow"], "positive_score", "positive_id", "prow", positives)
    windows = first.groupBy(F.col("arow").alias("row")).agg(F.collect_list(F.struct("prow", "positive_id", "positive_score")).alias("positives"))
    windows = written(windows, "positives")
    found = _met(dealt, asked.join(windows, "row"), shards, groups, _negatives(negatives, low, high), NEGATIVES)
    best = _ranked(found, ["arow", "prow"], "negative_score", "negative_id", "nrow", negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
