"""Phrase collocations by prefix-free parsing: what repeats in the corpus is counted once, with its frequency.

Texts are cut at punctuation and line ends into pieces, pieces into words. A piece is parsed into chunks: one begins at the piece's
first word and wherever the hash of the next ``longest - 1`` words is a trigger, so equal text is parsed alike wherever it stands. A
chunk goes on ``longest - 1`` words into the next one. It owns the phrases that begin before the next chunk's first word, so each phrase
of up to ``longest`` words lies whole in the one chunk that owns it, and overlaps are counted once. The distinct chunks with their
numbers of occurrences are the dictionary, a stored table; everything after reads it and not the texts.

Phrases are counted in the dictionary's chunks, weighted by their occurrences, in three passes by 64-bit hash: words, then pairs of frequent
words, then phrases of frequent pairs only (a phrase is no more frequent than its parts). What is frequent goes to the next pass as a bitmap of
FILTER_BITS bits, a fixed size. A bit may stand for several phrases, so a pass may count more than it must, never less. A last
pass counts the survivors by their exact words, so no result rests on a hash; a task sums up what it has read and sends one packed row to each
bucket of phrases, where the sums meet.

Null texts are empty, a null lang is ``und`` and joins rows with that lang. Rows that repeat count each time; ids and extra columns
don't matter. An empty table gives an empty result. Texts of any length are worked on whole: parsing takes memory in proportion
to the longest one. Products are made with 38 decimal digits; beyond, Spark raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.common import LOWER, SLICE_BYTES, Tokens, heavy_keys, mix, quoted, rolling, slices, small_batches, spread_join, written

#: One in PERIOD windows of words is a trigger.
PERIOD = 16
#: Bits of a filter of frequent phrases; 8 MB.
FILTER_BITS = 1 << 26
#: Partial sums that a task holds before it hands them on.
HELD = 1 << 20
#: Buckets of phrases in the last pass: one for so many chunks, and the least number; so a bucket's size doesn't grow with the corpus.
BUCKET_CHUNKS, LEAST_BUCKETS = 1 << 18, 64
PHRASE = ["lang", "words", "phrase"]
#: Ranks are cut first in so many parts of a language.
PARTS = 64

BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IN_PIECES = np.where(BREAKS, 0, 1).astype(np.uint8)
IN_PIECES[[0x20, 0x09]] = 0
IN_CHUNKS = np.ones(256, np.uint8)
IN_CHUNKS[0x20] = 0


def _joined(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Strings: the bytes of data from each start on."""
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at]))


def _portions(size: np.ndarray) -> Iterator[slice]:
    """Slices of about SLICE_BYTES, at least one item each."""
    total, at = np.cumsum(size), 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE_BYTES, side="right")))
        yield slice(at, end)
        at = end


def parse(texts: pa.Array, longest: int = 5, period: int = PERIOD) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(chunks, whether each ends its piece, number of its text), in order: words in lower case (A-Z), one space between."""
    t, context = Tokens(texts, IN_PIECES), longest - 1
    n = len(t.start)
    if not n:
        return
    owner = np.repeat(np.arange(len(t)), np.diff(t.first))
    breaks = np.cumsum(BREAKS[t.data], dtype=np.int32)[t.start]
    fresh = np.ones(n, bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (breaks[1:] != breaks[:-1])
    piece = np.cumsum(fresh) - 1
    end = np.append(np.flatnonzero(fresh)[1:], n)[piece]
    trigger = (np.arange(n) + context <= end) & (rolling(t.hash, context) % np.uint64(period) == 0) if context else np.ones(n, bool)
    first = np.flatnonzero(fresh | trigger)
    following = np.append(first[1:], n)
    last = following >= end[first]
    beyond = np.where(last, end[first], following + context)
    # all words one after another, one space between
    size = t.end - t.start
    place = np.cumsum(size + 1) - size - 1
    plain = np.full(int(place[-1] + size[-1]), 0x20, np.uint8)
    for part in _portions(size):
        s = size[part]
        step = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
        plain[step + np.repeat(place[part], s)] = LOWER[t.data[step + np.repeat(t.start[part], s)]]
    begin, stop = place[first], place[beyond - 1] + size[beyond - 1]
    for part in _portions(stop - begin):
        yield _joined(plain, begin[part], (stop - begin)[part]), last[part], owner[first[part]]


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 5, period: int = PERIOD) -> DataFrame:
    """(lang, last, chunk, n): the distinct chunks of each language, how often each occurs; stored."""
    small_batches(docs.sparkSession)
    source = docs.select(F.coalesce(F.col(quoted(lang)).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = []
                for chunks, last, owner in parse(batch.column("text"), longest, period):
                    rows = pa.table({"lang": batch.column("lang").take(pa.array(owner)), "last": pa.array(last), "chunk": chunks, "n": pa.array(np.ones(len(last), np.int64))})
                    found.append(_summed(rows, ["lang", "last", "chunk"]))
                if found:
                    yield from _summed(pa.concat_tables(found), ["lang", "last", "chunk"]).to_batches()

    chunks = source.mapInArrow(run, "lang string, last boolean, chunk string, n long")
    return written(chunks.groupBy("lang", "last", "chunk").agg(F.sum("n").alias("n")), "dictionary")


def _summed(rows: pa.Table, keys: list[str]) -> pa.Table:
    return rows.group_by(keys).aggregate([("n", "sum")]).select([*keys, "n_sum"]).rename_columns([*keys, "n"])


class Phrases:
    """Phrases of a batch of the dictionary: keys by length and first word, and which of them the chunks own."""

    def __init__(self, batch: pa.RecordBatch, longest: int):
        self.t = t = Tokens(batch.column("chunk"), IN_CHUNKS)
        sizes = np.diff(t.first)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        last = batch.column("last").to_numpy(zero_copy_only=False)
        at = np.arange(len(self.owner)) - t.first[self.owner]
        self.room = sizes[self.owner] - at
        self.own = at < (sizes - np.where(last, 0, longest - 1))[self.owner]
        self.weight = batch.column("n").to_numpy()
        langs = batch.column("lang").dictionary_encode()
        names = Tokens(langs.dictionary.cast(pa.binary()), np.ones(256, np.uint8))
        salt = np.zeros(len(langs.dictionary), np.uint64)  # an empty name has no token
        salt[np.diff(names.first) > 0] = names.hash
        self.salt = salt[langs.indices.to_numpy()][self.owner]

    def keys(self, n: int) -> np.ndarray:
        return mix((self.t.hash if n == 1 else rolling(self.t.hash, n)) ^ self.salt ^ np.uint64(n))


class Filter:
    """The frequent phrases of a pass as a bitmap by the first bits of their keys."""

    def __init__(self, rows: list, bits: int):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.map = np.zeros(bits // 8, np.uint8)
        for bucket, bitmap in rows:
            self.map[bucket * 4096 : bucket * 4096 + 4096] = np.frombuffer(bitmap, np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.map[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _frequent(p: Phrases, filters: list[Filter]) -> np.ndarray:
    """Where two frequent words, or a frequent pair, begin."""
    if len(filters) == 1:
        word = filters[0](p.keys(1))
        return word & np.append(word[1:], False)[: len(word)] & (p.room > 1)
    return filters[1](p.keys(2)) & (p.room > 1)


def _candidates(p: Phrases, filters: list[Filter], longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, first words) of the phrases to count after as many passes as there are filters; after all, the survivors."""
    if not filters:
        yield 1, p.own
        return
    if len(filters) == 1:
        yield 2, p.own & _frequent(p, filters)
        return
    pair = _frequent(p, filters)
    if len(filters) == 3:
        yield 1, p.own & filters[0](p.keys(1))
        yield 2, p.own & pair
    run = pair
    for n in range(3, longest + 1):
        run = run & np.append(pair[n - 2 :], np.zeros(n - 2, bool))[: len(pair)]
        here = p.own & run & (p.room >= n)
        yield n, here & filters[2](p.keys(n)) if len(filters) == 3 else here


def _counted(source: DataFrame, filters: list, longest: int) -> DataFrame:
    """(key, n) of the phrases of this pass."""

    def sums(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, weights = (np.concatenate(x) for x in zip((np.empty(0, np.uint64), np.empty(0, np.int64)), *held, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1])) if len(keys) else np.empty(0, np.int64)
        return keys[first], np.add.reduceat(weights, first) if len(first) else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in filters]
        held, size = [], 0
        out = lambda x: pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1])], names=["key", "n"])
        for whole in batches:
            for batch in slices(whole, "chunk"):
                p = Phrases(batch, longest)
                own = sums([(p.keys(n)[here], p.weight[p.owner[here]]) for n, here in _candidates(p, known, longest)])
                held.append(own)
                size += len(own[0])
                if size > HELD:
                    held = [sums(held)]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield out(held[0])
                        held, size = [], 0
        if held:
            yield out(sums(held))

    return source.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _filter(counted: DataFrame, least: int, bits: int):
    """The keys counted least times or more as a broadcast bitmap; the driver gets bits / 8 bytes at most."""
    place = F.shiftrightunsigned("key", 64 - (bits.bit_length() - 1)) + 1
    rows = counted.filter(F.col("n") >= least).select(place.alias("p")).groupBy((F.bitmap_bucket_number("p") - 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map")).collect()
    return counted.sparkSession.sparkContext.broadcast(Filter([(r["bucket"], r["map"]) for r in rows], bits))


def count_phrases(chunks: DataFrame, least: int = 100, longest: int = 5, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, words, phrase, n): every phrase of up to ``longest`` words that occurs ``least`` times or more in its language; stored."""
    if longest < 2:
        raise ValueError("phrases have two words or more")
    if bits < 1 << 15 or bits & (bits - 1):
        raise ValueError("bits must be a power of two, 32768 or more")
    filters: list = []
    for _ in range(3):
        filters.append(_filter(_counted(chunks, filters, longest), least, bits))
    buckets = max(LEAST_BUCKETS, -(-chunks.count() // BUCKET_CHUNKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in filters]
        held, size = [], 0
        for whole in batches:
            for batch in slices(whole, "chunk"):
                p = Phrases(batch, longest)
                for n, here in _candidates(p, known, longest):
                    at = np.flatnonzero(here)
                    begin, stop = p.t.start[at], p.t.end[at + n - 1]
                    for part in _portions(stop - begin):
                        owner = p.owner[at[part]]
                        rows = pa.table({"lang": batch.column("lang").take(pa.array(owner)), "words": pa.array(np.full(len(owner), n, np.int32)), "phrase": _joined(p.t.data, begin[part], (stop - begin)[part]), "n": pa.array(p.weight[owner])})
                        held.append(_summed(rows, PHRASE))
                        size += len(held[-1])
                if size > HELD:
                    held = [_summed(pa.concat_tables(held), PHRASE)]
                    size = len(held[0])
                    if size > HELD // 2:
                        yield _packed(held[0], buckets)
                        held, size = [], 0
        if held:
            yield _packed(_summed(pa.concat_tables(held), PHRASE), buckets)

    def merge(rows: pa.Table) -> pa.Table:
        found = _summed(pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in rows.column("packed")]), PHRASE)
        return found.filter(pc.greater_equal(found.column("n"), least))

    packed = chunks.mapInArrow(run, "bucket int, packed binary")
    stored = written(packed.groupBy("bucket").applyInArrow(merge, "lang string, words int, phrase string, n long"), "phrases")
    for f in filters:
        f.destroy()
    return stored


def _packed(rows: pa.Table, buckets: int) -> pa.RecordBatch:
    """One row a bucket: the phrases whose hash falls there, as a compressed Arrow stream."""
    t = Tokens(rows.column("phrase").combine_chunks().cast(pa.binary()), np.ones(256, np.uint8))
    bucket = (t.hash % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rows, first = rows.take(pa.array(order)), np.flatnonzero(np.diff(bucket[order], prepend=-1))
    packed = []
    for a, b in zip(first, np.append(first[1:], len(order)), strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows.slice(a, b - a).combine_chunks())
        packed.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(bucket[order][first]), pa.array(packed, pa.binary())], names=["bucket", "packed"])


def _sizes(chunks: DataFrame, longest: int) -> DataFrame:
    """(lang, n): all words of each language."""
    own = F.length("chunk") - F.length(F.replace("chunk", F.lit(" "), F.lit(""))) + 1 - F.when(F.col("last"), 0).otherwise(longest - 1)
    return chunks.groupBy("lang").agg(F.sum(F.col("n") * own).alias("n"))


def _within(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longest_n): the greatest count of a longer phrase that holds the phrase."""
    longer = phrases.filter("words > 2").withColumn("w", F.split("phrase", " "))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    return longer.select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer_n"))


def score_phrases(phrases: DataFrame, sizes: DataFrame, cover: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all phrases of two words or more, without those that a longer one covers.

    A longer phrase covers one inside it that it is at least cover percent as frequent as. Of all cuts in two the lowest scoring counts, of ties the first.
    """
    key = lambda c: F.struct("lang", F.col(c).alias("phrase"))
    kept = phrases.filter("words > 1").join(_within(phrases), ["lang", "phrase"], "left").filter(F.col("longer_n").isNull() | (100 * F.col("longer_n") < cover * F.col("n")))
    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    first = F.array_join(F.slice(F.split("phrase", " "), 1, F.col("k")), " ")
    cuts = cuts.withColumn("head", first).withColumn("tail", F.col("phrase").substr(F.length("head") + 2, F.length("phrase")))
    counts = phrases.select(key("phrase").alias("key"), F.col("n").alias("part"))
    for part, name in (("head", "l"), ("tail", "r")):  # a common word heads many phrases
        rows = written(cuts.withColumn("key", key(part)).drop(part), f"cuts-{part}")
        cuts = spread_join(rows, counts, "key", heavy_keys(rows, "key")).drop("key").withColumnRenamed("part", name)
    exact = lambda x, y: x.cast("decimal(19,0)") * y.cast("decimal(19,0)")
    scored = cuts.join(F.broadcast(sizes), "lang") if sizes.count() <= 10_000 else cuts.join(sizes, "lang")
    scored = scored.withColumn("over", exact(1000 * F.col("a"), F.col("n"))).withColumn("under", exact(F.col("l"), F.col("r")))
    best = F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r")).alias("best")
    return scored.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def mine(docs: DataFrame, least: int = 100, top: int = 2000, longest: int = 5, cover: int = 100, text: str = "text", lang: str = "lang", period: int = PERIOD, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by score, count and phrase."""
    chunks = dictionary(docs, text, lang, longest, period)
    scored = written(score_phrases(count_phrases(chunks, least, longest, bits), _sizes(chunks, longest), cover), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    few = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
