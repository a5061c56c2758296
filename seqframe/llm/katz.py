"""Language-model scores by Katz backoff with Good-Turing discounts and exactly normalised backoff weights.

Tokens are lower-cased (A-Z) words between ASCII white space, then one end token a text.
Unigrams are Good-Turing counts with the unseen mass on one unknown type, so they add up
to one over the training types and it. A seen bigram (h, w) has probability
d(c) c(h, w) / c(h); else bow(h) p(w) with

    bow(h) = (1 - sum of d(c) c(h, w) / c(h)) / (1 - sum of p(w)),   sums over the seen w after h,

which makes p(. | h) add up to one exactly. Discounts d(c) for c up to ``cutoff`` come from counts of counts of
the whole corpus. Evaluation backs off recursively: bigram, unigram, unknown.

with the denominators c(h) + 1/2, so that a history whose continuations are all frequent
keeps some mass for others.

Work is split by block and by bucket. A block is a run of documents of one input partition,
about BLOCK_BYTES of text. Blocks list their distinct uni- and bigrams, with training
counts, as packed sorted keys by bucket of the key's hash, so a hot word is one entry a
block; a bucket adds up the counts of all blocks and answers each
block in the order of its list (a row for each block and bucket that has n-grams, so there are fewer rows than n-grams). Blocks then evaluate their tokens and sum up what the bigrams they own
add to their histories. Backoff weights are sums by history, joined only to the (document, history)
pairs that back off. The driver sees only counts of counts.

``fit`` stores a model: a table of n-grams and counts, partitioned by order and in rows by bucket, a table of
backoff weights by history, and the counts of counts. ``apply`` scores any documents with a stored model;
``score`` learns and scores in one go.

Tokens are named by 64-bit hashes. Null and empty texts have only the end token. Repeated
rows count as often as they are there. Columns beyond id and text don't matter. The documents must be
a table or another plan whose partitions are the same in each run; a block whose list and answer differ raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seqframe.llm.common import NOT_SPACE, mix, quoted, slices, small_batches, token_hashes, written

#: Bytes of text in a block, and bytes of all text for each bucket.
BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 3 << 20
END = np.uint64(0x7E57ED0F5E7E11CE)
_START = np.uint64(0x517A27B3C0FFEE11)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end token, and where each text's begin."""
    hashes, begins = token_hashes(texts, NOT_SPACE)
    counts = np.diff(begins) + 1
    first = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(int(first[-1]), np.uint64)
    ends = first[1:] - 1
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[is_end] = END
    out[~is_end] = hashes
    return out, first


def bigrams(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Name of the bigram that ends at each token; a text begins after a start mark."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[first[:-1]] = _START
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0xD6E8FEB86659FD93) + words)


def discounts(counts_of_counts: dict[int, int], cutoff: int) -> np.ndarray:
    """Good-Turing discounts d(1..cutoff) in Katz's form; 1 where the counts of counts can't give one."""
    n = [0.0] + [float(counts_of_counts.get(k, 0)) for k in range(1, cutoff + 2)]
    out = np.ones(cutoff + 1)
    if n[1] > 0:
        rest = (cutoff + 1) * n[cutoff + 1] / n[1]
        for c in range(1, cutoff + 1):
            if n[c] > 0 and rest < 1:
                d = ((c + 1) * n[c + 1] / (c * n[c]) - rest) / (1 - rest)
                if 0 < d < 1:
                    out[c] = d
    return out


def _pack(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, of six bytes each where all of them fit."""
    steps = np.diff(keys, prepend=np.uint64(0))
    if len(steps) > 1 and int(steps[1:].max()) < 1 << 48:
        return b"6" + keys[:1].tobytes() + np.ascontiguousarray(steps[1:].view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
    return b"8" + keys.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if len(data) == 1:
        return np.empty(0, np.uint64)
    if data[:1] == b"8":
        return np.frombuffer(data, np.uint64, offset=1)
    rest = np.frombuffer(data, np.uint8, offset=9).reshape(-1, 6)
    wide = np.zeros((len(rest) + 1, 8), np.uint8)
    wide[1:, :6] = rest
    steps = wide.reshape(-1).view(np.uint64)
    steps[0] = np.frombuffer(data, np.uint64, 1, 1)[0]
    return np.cumsum(steps, dtype=np.uint64)


def _small(counts: np.ndarray) -> bytes:
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(counts) or int(counts.max()) <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def _large(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of keys, so that lists in key order are in bucket order."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class _Block:
    """Tokens and bigrams of a block: distinct names in order, and which of them each token is."""

    def __init__(self, texts: pa.Array):
        self.tokens, self.first = tokens(texts)
        self.words, self.word = np.unique(self.tokens, return_inverse=True)
        self.pairs, at, self.pair = np.unique(bigrams(self.tokens, self.first), return_index=True, return_inverse=True)
        self.pair_word = self.word[at]
        before = np.empty_like(self.word)
        before[1:] = self.word[:-1]
        before[self.first[:-1]] = len(self.words)  # the start of a text
        self.before = before
        self.pair_before = before[at]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) of the blocks of one partition."""
    from pyspark import TaskContext

    number, held, size = TaskContext.get().partitionId() << 20, [], 0
    for whole in batches:
        for batch in slices(whole, "text"):
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= BLOCK_BYTES:
                yield number, pa.Table.from_batches(held)
                number, held, size = number + 1, [], 0
    if held:
        yield number, pa.Table.from_batches(held)


def _texts(rows: pa.Table) -> pa.Array:
    return pa.concat_arrays([c for c in rows.column("text").chunks]) if rows.num_rows else pa.array([], pa.string())


LISTS = "kind int, bucket long, block long, keys binary, counts binary"
#: Answers to blocks; block -1 has the counts of counts, block -2 the n-grams and counts of the bucket.
ANSWERS = "kind int, bucket long, block long, keys binary, counts binary, owned binary, stats map<long,long>"
#: Keys of stats beside counts: distinct n-grams, n-grams, ends.
TYPES, TOTAL, ENDS = -1, -2, -3


@dataclass
class Model:
    """A stored model."""

    ngrams: DataFrame
    backoff: DataFrame
    buckets: int
    cutoff: int
    stats: dict[int, dict[int, int]]

    def __post_init__(self):
        self.total, self.types, self.texts = (self.stats[1].get(k, 0) for k in (TOTAL, TYPES, ENDS))
        self.one, self.two = (discounts(self.stats[k], self.cutoff) for k in (1, 2))
        lost = sum(self.stats[1].get(c, 0) * c * (1 - self.one[c]) for c in range(1, self.cutoff + 1))
        # the unknown type has what the discounts leave, or half a count
        self.scale = max(self.total + (0.5 if lost <= 0 else 0.0), 0.5)
        self.unknown = (lost if lost > 0 else 0.5) / self.scale

    def discounted(self, c: np.ndarray, order: int) -> np.ndarray:
        d = self.one if order == 1 else self.two
        return c * np.where(c <= self.cutoff, d[np.minimum(c, self.cutoff)], 1.0)


def _lists(docs: DataFrame, buckets: int) -> DataFrame:
    """What each block has: (kind 1 or 2, bucket, block, packed keys, training counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _blocks(batches):
            block = _Block(_texts(rows))
            learns = np.repeat(np.array(rows.column("learns").to_pylist(), bool), np.diff(block.first))
            for kind, keys, which in ((1, block.words, block.word), (2, block.pairs, block.pair)):
                counts = np.bincount(which[learns], minlength=len(keys))
                home = _bucket(keys, buckets)
                edges = np.flatnonzero(np.diff(home, prepend=-1))
                ends = np.append(edges[1:], len(keys))
                packed = [[kind] * len(edges), home[edges], [number] * len(edges), [_pack(keys[a:b]) for a, b in zip(edges, ends, strict=True)], [_small(counts[a:b]) for a, b in zip(edges, ends, strict=True)]]
                types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(packed, types, strict=True)], names=["kind", "bucket", "block", "keys", "counts"])

    return docs.mapInArrow(run, LISTS)


def _answer(lists: pd.DataFrame, cutoff: int) -> pd.DataFrame:
    """Totals of one bucket, for each block in the order of its list; a name is owned by the first block that learns it."""
    lists = lists.sort_values("block", kind="stable").reset_index(drop=True)
    keys = [_unpack(x) for x in lists["keys"]]
    counts = [_large(x) for x in lists["counts"]]
    sizes = np.array([len(k) for k in keys])
    every, own = np.concatenate(keys), np.concatenate(counts)
    names, which = np.unique(every, return_inverse=True)
    total = np.bincount(which, weights=own, minlength=len(names)).astype(np.int64)
    place = np.full(len(names), len(every))
    np.minimum.at(place, which[own > 0], np.flatnonzero(own > 0))
    owned = place[which] == np.arange(len(every))
    ends = np.cumsum(sizes)
    value, n = np.unique(total[total > 0], return_counts=True)
    low = value <= cutoff + 1
    stats = {int(v): int(c) for v, c in zip(value[low], n[low], strict=True)} | {TYPES: int((total > 0).sum()), TOTAL: int(total.sum()), ENDS: int(total[names == END].sum())}
    kind, bucket = int(lists["kind"].iloc[0]), int(lists["bucket"].iloc[0])
    rows = [(kind, bucket, int(b), b"", _small(total[which[e - s : e]]), np.packbits(owned[e - s : e]).tobytes(), None) for b, s, e in zip(lists["block"], sizes, ends, strict=True)]
    rows += [(kind, bucket, -1, b"", b"", b"", stats), (kind, bucket, -2, _pack(names[total > 0]), _small(total[total > 0]), b"", None)]
    return pd.DataFrame(rows, columns=["kind", "bucket", "block", "keys", "counts", "owned", "stats"])


def _look_up(lists: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
    """Stored counts of one bucket, for each block in the order of its list."""
    names = np.concatenate([np.empty(0, np.uint64), *[_unpack(x) for x in stored["keys"]]])
    counts = np.concatenate([np.empty(0, np.int64), *[_large(x) for x in stored["counts"]]])
    rows = []
    for kind, bucket, block, packed in zip(lists["kind"], lists["bucket"], lists["block"], lists["keys"], strict=True):
        keys = _unpack(packed)
        at = np.minimum(np.searchsorted(names, keys), max(len(names) - 1, 0))
        found = np.where(names[at] == keys, counts[at], 0) if len(names) else np.zeros(len(keys), np.int64)
        rows.append((kind, bucket, block, b"", _small(found), np.packbits(np.zeros(len(keys), bool)).tobytes(), None))
    return pd.DataFrame(rows, columns=["kind", "bucket", "block", "keys", "counts", "owned", "stats"])


def _joined(table: pa.Table, kind: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"])
    counts = [_large(r["counts"]) for r in rows]
    owned = [np.unpackbits(np.frombuffer(r["owned"], np.uint8), count=len(c)).astype(bool) for r, c in zip(rows, counts, strict=True)]
    out = np.concatenate(counts) if counts else np.empty(0, np.int64)
    if len(out) != size:
        raise ValueError("a block's answer doesn't match its documents: the input's partitions changed between two runs; write the documents first")
    return out, np.concatenate(owned) if owned else np.empty(0, bool)


EVALUATED = "kind int, block long, place int, id long, learns boolean, history long, n long, known long, base double, x double, y double"


def _source(docs: DataFrame, learns: Column, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(quoted(doc_id)).cast("long").alias("id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))


def _evaluated(source: DataFrame, replies: DataFrame, model: Model) -> DataFrame:
    """Rows of three kinds: 0 texts with the sums of what needs no backoff weight, 1 parts of histories, 2 backing off by text and history."""
    schema = to_arrow_schema(T._parse_datatype_string(EVALUATED))
    total, types, texts, unknown, scale = model.total, model.types, model.texts, model.unknown, model.scale
    plain = Model(None, None, model.buckets, model.cutoff, model.stats)  # without tables, for the tasks
    discounted = plain.discounted

    def evaluate(key, rows: pa.Table, given: pa.Table) -> pa.Table:
        block = _Block(_texts(rows))
        c1, _ = _joined(given, 1, len(block.words))
        c2, owned = _joined(given, 2, len(block.pairs))
        p1 = np.where(c1 > 0, discounted(c1, 1) / scale, unknown)
        own_history = np.append(c1, texts)  # the last one is the start of a text
        base = np.log10((c1 + 1) / (total + types + 1))
        mass = discounted(c2, 2)
        with np.errstate(divide="ignore"):
            direct = np.log10(mass) - np.log10(own_history[block.pair_before] + 0.5)
        seen = c2 > 0
        # what backs off: p(w) now, the history's weight later (1 for a history that was never learnt)
        logs = np.where(seen, direct, np.log10(p1)[block.pair_word])
        begin = block.first[:-1]
        sums = lambda v: np.add.reduceat(v, begin) if len(begin) else np.empty(0)
        n = np.diff(block.first)
        number, places = int(key[0].as_py()), np.arange(len(n))
        names = np.append(block.words, _START)
        parts = [{"kind": [0] * len(n), "place": places, "id": rows.column("id"), "learns": rows.column("learns"), "n": n, "known": sums((c1[block.word] > 0).astype(np.int64)), "base": sums(base[block.word]), "x": sums(logs[block.pair])}]
        # bigrams that this block owns, by history: discounted mass and probability of the seen words
        mine = owned & seen
        by_history = np.bincount(block.pair_before[mine], weights=mass[mine], minlength=len(names)), np.bincount(block.pair_before[mine], weights=p1[block.pair_word[mine]], minlength=len(names))
        at = np.flatnonzero(by_history[0])
        parts.append({"kind": [1] * len(at), "history": names[at].view(np.int64), "n": own_history[at], "x": by_history[0][at], "y": by_history[1][at]})
        off = np.flatnonzero(~seen[block.pair] & (own_history[block.before] > 0))
        owner = np.searchsorted(block.first, off, side="right") - 1
        both, times = np.unique(owner * len(names) + block.before[off], return_counts=True)
        parts.append({"kind": [2] * len(both), "place": both // len(names), "history": names[both % len(names)].view(np.int64), "n": times})
        tables = []
        for part in parts:
            length = len(part["kind"])
            part["block"] = [number] * length
            columns = []
            for f in schema:
                v = part.get(f.name)
                columns.append(pa.nulls(length, f.type) if v is None else v.combine_chunks().cast(f.type) if isinstance(v, pa.ChunkedArray) else pa.array(v, f.type))
            tables.append(pa.table(columns, schema=schema))
        return pa.concat_tables(tables).combine_chunks()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            for batch in rows.to_batches():
                yield batch.append_column("block", pa.array([block] * batch.num_rows, pa.int64()))

    numbered = source.mapInArrow(number, "id long, text string, learns boolean, block long")
    replies = replies.filter("block >= 0").select("block", "kind", "bucket", "counts", "owned")
    return written(numbered.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(evaluate, EVALUATED), "evaluated")


def _scores(done: DataFrame, weights: DataFrame, total: int) -> DataFrame:
    off = done.filter("kind = 2").select("block", "place", "history", "n").join(weights, "history").groupBy("block", "place").agg(F.sum(F.col("n") * F.col("w")).alias("more"))
    scored = done.filter("kind = 0").join(off, ["block", "place"], "left")
    return scored.select(
        F.col("id").alias("doc_id"), (~F.col("learns")).alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("x") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )


def _learnt(docs: DataFrame, learns: Column, doc_id: str, text: str, cutoff: int) -> tuple[DataFrame, Model]:
    """(evaluated rows, model) of one pass over all documents."""
    source = _source(docs, learns, doc_id, text)
    small_batches(docs.sparkSession)
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    buckets = int(max(4, size // BUCKET_BYTES))
    answers = written(_lists(source, buckets).groupBy("kind", "bucket").applyInPandas(lambda pdf: _answer(pdf, cutoff), ANSWERS), "ngrams")
    stats: dict[int, dict[int, int]] = {1: {}, 2: {}}
    for r in answers.filter("block = -1").select("kind", F.explode("stats").alias("c", "n")).groupBy("kind", "c").agg(F.sum("n").alias("n")).collect():
        stats[r["kind"]][r["c"]] = r["n"]
    model = Model(answers.filter("block = -2").select("kind", "bucket", "keys", "counts"), None, buckets, cutoff, stats)
    done = _evaluated(source, answers, model)
    histories = done.filter("kind = 1").groupBy("history").agg(F.sum("x").alias("mass"), F.sum("y").alias("p"), F.max("n").alias("c"))
    model.backoff = histories.select("history", F.log10((1 - F.col("mass") / (F.col("c") + 0.5)) / (1 - F.col("p"))).alias("w"))
    return done, model


def score(docs: DataFrame, learns: Column, doc_id: str = "doc_id", text: str = "text", cutoff: int = 5) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): log10 probabilities of whole texts.

    ``learns`` tells the documents that are learnt from; base_score is the add-one unigram score.
    """
    done, model = _learnt(docs, learns, doc_id, text, cutoff)
    return _scores(done, model.backoff, model.total)


def fit(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", cutoff: int = 5) -> Model:
    """Learn from all docs and store the model under folder: ``ngrams`` (partitioned by order), ``backoff`` and ``stats``."""
    _, model = _learnt(docs, F.lit(True), doc_id, text, cutoff)
    model.ngrams.write.partitionBy("kind").parquet(f"{folder}/ngrams")
    model.backoff.write.parquet(f"{folder}/backoff")
    rows = [(model.buckets, cutoff, kind, int(c), int(n)) for kind, counts in model.stats.items() for c, n in counts.items()]
    docs.sparkSession.createDataFrame(rows or [(model.buckets, cutoff, 1, 0, 0)], "buckets int, cutoff int, kind int, c long, n long").coalesce(1).write.parquet(f"{folder}/stats")
    return load(docs.sparkSession, folder)


def load(spark: SparkSession, folder: str) -> Model:
    rows = spark.read.parquet(f"{folder}/stats").collect()  # counts of counts up to the cutoff
    stats: dict[int, dict[int, int]] = {1: {}, 2: {}}
    for r in rows:
        stats[r["kind"]][r["c"]] = r["n"]
    ngrams = spark.read.schema("bucket long, keys binary, counts binary, kind int").parquet(f"{folder}/ngrams")
    return Model(ngrams, spark.read.schema("history long, w double").parquet(f"{folder}/backoff"), rows[0]["buckets"], rows[0]["cutoff"], stats)


def apply(model: Model, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``score`` for documents that the model has not learnt from."""
    source = _source(docs, F.lit(False), doc_id, text)
    lists = _lists(source, model.buckets).groupBy("kind", "bucket")
    replies = written(lists.cogroup(model.ngrams.groupBy("kind", "bucket")).applyInPandas(_look_up, ANSWERS), "replies")
    return _scores(_evaluated(source, replies, model), model.backoff, model.total)
