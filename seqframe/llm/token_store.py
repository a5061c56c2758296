"""Binary store of token ids: interleaved range asymmetric numeral coding in independent blocks.

One stored file holds the ids of consecutive documents:

    header      magic, version, scale bits, lanes, steps a segment, segments a block, numbers of ids, documents, symbols
    table       the file's symbols and their frequencies, shared by all its blocks (static model)
    documents   length of each document
    blocks      for each: number of ids, CRC-32 of the ids, and checkpoints: lane states and stream place of each segment
    stream      32-bit words of all blocks

Ids of a block go to its lanes in turn. A checkpoint restarts the lanes, so every
segment decodes by itself and all segments of a file decode at once in numpy lanes.
The checksum of a block is verified as it is read.

Files are rows of a Parquet table (binary column ``file``), which any store that
Spark writes to can hold, and which are decoded in parallel, one row at a time.

Null and empty texts have only the end id. Documents are in ascending id order, null
ids first; rows of equal id are ordered by text. Extra columns are not stored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.llm.common import kept, quoted, shared_folder

LANES, STEPS, SEGMENTS = 32, 128, 4
BLOCK = LANES * STEPS * SEGMENTS
LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sHBBHHQQII")
#: Ids in one stored file, unless one document is longer.
FILE_IDS = 1 << 20
#: Chunks and words whose ids a worker keeps; a store is emptied when it is full.
KEPT_CHUNKS = 200_000
FILES = "part int, seq int, start bigint, n_tokens bigint, doc_ids array<bigint>, file binary"


def model(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols, frequencies that add up to a power of two, and that power."""
    symbols, counts = np.unique(ids, return_counts=True)
    bits = int(min(22, max(12, np.ceil(np.log2(len(symbols) + 1)) + 4)))
    total = 1 << bits
    share = np.maximum(1, np.floor(counts * ((total - len(symbols)) / counts.sum()))).astype(np.int64)
    share[np.argmax(share)] += total - share.sum()
    return symbols.astype(np.uint32), share.astype(np.uint32), bits


def encode(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One stored file of the given ids and document lengths."""
    ids = ids.astype(np.uint32, copy=False)
    if not len(ids):
        return _HEAD.pack(b"SQTI", 1, 12, LANES, STEPS, SEGMENTS, 0, len(lengths), 0, 0) + np.asarray(lengths, "<u4").tobytes()
    symbols, freq, bits = model(ids)
    begin = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    blocks = -(-len(ids) // BLOCK)
    dense = np.full(blocks * BLOCK, int(np.argmax(freq)), np.uint32)
    dense[: len(ids)] = np.searchsorted(symbols, ids)
    units = blocks * SEGMENTS
    # (steps, all lanes of all segments)
    grid = np.ascontiguousarray(dense.reshape(units, STEPS, LANES).transpose(1, 0, 2)).reshape(STEPS, units * LANES)
    f64 = freq.astype(np.uint64)
    shift, word = np.uint64(bits), np.uint64(32)
    state = np.full(units * LANES, LOW, np.uint64)
    words = np.zeros((STEPS, units * LANES), np.uint32)
    moved = np.zeros((STEPS, units * LANES), bool)
    limit = np.uint64((1 << 31 >> bits) << 32)
    for step in range(STEPS - 1, -1, -1):
        f, c = f64[grid[step]], begin[grid[step]]
        out = state >= limit * f
        words[step] = (state & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        moved[step] = out
        state = np.where(out, state >> word, state)
        quotient = state // f
        state = (quotient << shift) + (state - quotient * f) + c
    by_unit = moved.reshape(STEPS, units, LANES).transpose(1, 0, 2)
    stream = np.ascontiguousarray(words.reshape(STEPS, units, LANES).transpose(1, 0, 2))[by_unit]
    places = np.concatenate(([0], np.cumsum(by_unit.sum(axis=(1, 2)))[:-1])).astype("<u8")
    sums = np.array([zlib.crc32(ids[b * BLOCK : (b + 1) * BLOCK].tobytes()) for b in range(blocks)], "<u4")
    return b"".join((
        _HEAD.pack(b"SQTI", 1, bits, LANES, STEPS, SEGMENTS, len(ids), len(lengths), len(symbols), len(stream)),
        symbols.astype("<u4").tobytes(), freq.astype("<u4").tobytes(), np.asarray(lengths, "<u4").tobytes(),
        sums.tobytes(), places.tobytes(), state.astype("<u8").tobytes(), stream.astype("<u4").tobytes(),
    ))


def decode(file: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, document lengths) of a stored file; ValueError if it is damaged."""
    magic, version, bits, lanes, steps, segments, n, docs, symbols_n, stream_n = _HEAD.unpack_from(file)
    if magic != b"SQTI" or version != 1:
        raise ValueError("not a token store file")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(file, kind, count, at)
        at += out.nbytes
        return out

    blocks = -(-n // (lanes * steps * segments))
    units = blocks * segments
    symbols, freq, lengths = take("<u4", symbols_n), take("<u4", symbols_n), take("<u4", docs)
    sums, places, states, stream = take("<u4", blocks), take("<u8", units), take("<u8", units * lanes), take("<u4", stream_n)
    if not n:
        return np.empty(0, np.uint32), lengths
    slot = np.repeat(np.arange(symbols_n, dtype=np.uint32), freq)
    begin = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    f64 = freq.astype(np.uint64)
    state, mask, shift = states.copy(), np.uint64((1 << bits) - 1), np.uint64(bits)
    stream = np.append(stream, np.uint32(0)).astype(np.uint64)
    place = places.astype(np.int64)
    out = np.empty((steps, units * lanes), np.uint32)
    for step in range(steps):
        low = state & mask
        found = slot[low]
        out[step] = found
        state = f64[found] * (state >> shift) + low - begin[found]
        more = state < LOW
        rank = np.cumsum(more.reshape(units, lanes), axis=1)
        source = (place[:, None] + rank - 1).reshape(-1)[more]
        state[more] = (state[more] << np.uint64(32)) | stream[source]
        place += rank[:, -1]
    ids = symbols[out.reshape(steps, units, lanes).transpose(1, 0, 2).reshape(-1)[:n]]
    size = lanes * steps * segments
    for b in range(blocks):
        if zlib.crc32(ids[b * size : (b + 1) * size].tobytes()) != sums[b]:
            raise ValueError(f"block {b} does not match its checksum")
    return ids, lengths


class ChunkEncoder:
    """Ids of texts by a tokenizers file whose pre-tokens never cross white space; ids of chunks are kept.

    That holds when white space only separates (the pre-tokenizer drops it); texts
    with characters that str and the pattern class differently go to the library whole.
    A chunk of Latin letters and then ASCII marks (no quote, no ``<``) is one or two lower-cased pre-tokens,
    which the library's model encodes without the normaliser's bookkeeping.
    """

    _ODD = re.compile("[\x1c-\x1f]")
    _SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*)([!-&(-/:;=-@\\[-`{-~]*)")

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [x["type"] for x in spec["pre_tokenizer"].get("pretokenizers", [])]
        changes = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        self.plain = steps == ["Split", "ByteLevel"] and changes == ["NFC", "Replace", "Lowercase"]
        printable = [n for n in range(256) if 0x21 <= n <= 0x7E or 0xA1 <= n <= 0xAC or 0xAE <= n]
        others = [n for n in range(256) if n not in printable]
        self.letters = {n: chr(n) for n in printable} | {n: chr(256 + k) for k, n in enumerate(others)}
        self.marks: dict[str, bytes] = {"": b""}
        parts = self._bytes(["one", "Two,", "one  Two,", " one\n\tTwo, "])
        if not parts[0] + parts[1] == parts[2] == parts[3]:
            raise ValueError("a tokenizer for which white space only separates is needed")

    def _bytes(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        found = self.library.model.tokenize(word.encode().decode("latin-1").translate(self.letters))
        out = self.words[word] = b"".join([t.id.to_bytes(4, "little") for t in found])
        return out

    def _learn(self, chunks: list[str]) -> None:
        if len(self.words) > KEPT_CHUNKS:
            self.words.clear()
        others, simple = [], self._SIMPLE.fullmatch
        for chunk in chunks:
            match = simple(chunk) if self.plain else None
            if match:
                word, marks = match[1].lower(), match[2]
                if marks not in self.marks:
                    if len(self.marks) > KEPT_CHUNKS:
                        self.marks = {"": b""}
                    self.marks[marks] = self._bytes([marks])[0]
                self.known[chunk] = (self.words.get(word) or self._word(word) if word else b"") + self.marks[marks]
            else:
                others.append(chunk)
        if others:
            self.known.update(zip(others, self._bytes(others), strict=True))

    def ids(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        if self._ODD.search(text):
            return self._bytes([text])[0]
        chunks, known = text.split(), self.known
        found = list(map(known.get, chunks))
        if None in found:
            # emptied only here, before what is missing is learnt; what was found is at hand
            if len(known) > KEPT_CHUNKS:
                known.clear()
            self._learn(list(dict.fromkeys([c for c, x in zip(chunks, found, strict=True) if x is None])))
            found = [known[c] if x is None else x for c, x in zip(chunks, found, strict=True)]
        return b"".join(found)


def encoder(path: str) -> ChunkEncoder:
    return kept(f"ids {path}", lambda: ChunkEncoder(path))


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1) -> None:
    """Encode all texts, in ascending id order, into stored files under ``folder``."""
    ordered = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, own = TaskContext.get().partitionId(), encoder(tokenizer)
        ids: list[bytes] = []
        names: list[int | None] = []
        seq = start = held = 0

        def file() -> pa.RecordBatch:
            lengths = np.array([len(x) // 4 for x in ids], np.uint32)
            whole = np.frombuffer(b"".join(ids), "<u4")
            row = [[part], [seq], [start], [len(whole)], [names], [encode(whole, lengths)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["part", "seq", "start", "n_tokens", "doc_ids", "file"])

        for batch in batches:
            for name, body in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(own.ids(body) + end)
                names.append(name)
                held += len(ids[-1]) // 4
                if held >= FILE_IDS:
                    yield file()
                    seq, start, held, ids, names = seq + 1, start + held, 0, [], []
        if ids:
            yield file()

    ordered.mapInArrow(run, FILES).write.parquet(folder)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row a document from stored files: doc_id, start, n_tokens, ids_crc32 and, on demand, ids."""
    files = spark.read.schema(FILES).parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = decode(row["file"])
                ends = np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
                columns = [pa.array([row["part"]] * len(lengths), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + begins, pa.int64()), pa.array(lengths.astype(np.int64)), pa.array(sums, pa.int64())]
                names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(begins, ends[-1:]), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    from pyspark.sql import Window

    # one row for each range of ids written, so neither the window nor the broadcast grows with the documents
    before = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    docs = files.mapInArrow(run, kind)
    return docs.join(before, "part").withColumn("start", F.col("start") + F.col("before")).drop("part", "before")


def store_tokens(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the documents' ids to stored files in the shared folder and return what is read back from them."""
    folder = shared_folder(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, folder, **options)
    return read_tokens(docs.sparkSession, folder)


