"""Shared pieces of the corpus operators: tables, Arrow batches of texts, word hashes, shared folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one step in a task works on at once (a longer text is still worked on whole).
SLICE_BYTES = 1 << 20
#: Bytes of rows that Spark and a Python worker exchange at once, where the session still has Spark's own bound.
ARROW_BYTES = 4 << 20
#: A key is heavy if it has more than one in HEAVY rows, so there are fewer than HEAVY of them; its rows are dealt over SALTS tasks.
HEAVY, SALTS = 1000, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Arrow batches in executors and workers."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, "67108864b") in ("67108864b", "64m", "64MB"):
        spark.conf.set(name, str(ARROW_BYTES))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir.

    Where that setting is absent and Spark runs on this machine alone (local tests) a temporary folder is made and set.
    """
    small_batches(spark)
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="seqframe-")
        context.setCheckpointDir(base)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """df, computed once and reread from a table in the shared folder: lineage ends there."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def heavy_keys(rows: DataFrame, *columns: str) -> DataFrame | None:
    """(key): values of any of the columns that more than one in HEAVY of the rows, and more than HEAVY rows, have; None if there are none.

    There are fewer than HEAVY of a column, so the driver can hold them. rows is a table.
    """
    least = max(rows.count() / HEAVY, HEAVY)
    one = rows.select(F.explode(F.array(*columns)).alias("key")) if len(columns) > 1 else rows.select(F.col(columns[0]).alias("key"))
    found = one.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > least).select("key").collect()
    return rows.sparkSession.createDataFrame(found, one.schema) if found else None


def spread_join(left: DataFrame, right: DataFrame, key: str, heavy: DataFrame | None, how: str = "inner") -> DataFrame:
    """left joined with right, which has at most one row a key; rows of heavy keys are dealt over SALTS tasks, with a copy of right's row in each."""
    if heavy is None:
        return left.join(right, key, how)
    marked = F.broadcast(heavy.select(F.col("key").alias(key), F.lit(True).alias("__heavy")))  # a few thousand rows at most
    salt = F.when(F.col("__heavy"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    salts = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    a = left.join(marked, key, "left").withColumn("__salt", salt).drop("__heavy")
    b = right.join(marked, key, "left").withColumn("__salt", F.explode(salts)).drop("__heavy")
    return a.join(b, [key, "__salt"], how).drop("__salt")


_kept: dict = {}


def kept(name: str, make: Callable):
    """What a worker process keeps from task to task: one thing at a time, so that operators don't add up."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + SLICE_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def add_columns(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[], Callable], drop_text: bool = False) -> DataFrame:
    """df with columns computed from whole texts in Arrow batches.

    make() runs once in each task; what it returns gets a pa.Array of texts
    (null becomes empty) and returns one pa.Array or list for each field.
    An input column with the name of a new field is replaced.
    """
    small_batches(df.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in new and not (drop_text and c == text)]
    source = df.select(*[F.col(quoted(c)) for c in kept], *([] if text in kept else [F.col(quoted(text))]))
    schema = T.StructType([source.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        step = None
        types = [to_arrow_type(f.dataType) for f in fields]
        for whole in batches:
            pa.default_memory_pool().release_unused()
            for batch in slices(whole, text):
                step = step or make()
                made = step(pc.fill_null(batch.column(text), ""))
                arrays = [a if isinstance(a, pa.Array) else pa.array(a, type=t) for a, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + arrays, names=kept + [f.name for f in fields])

    return source.mapInArrow(run, schema)


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind) if not isinstance(kind, T.DataType) else kind)


# ---------------------------------------------------------------- word hashes

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_MASK = (1 << 64) - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(int(_P), -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, _P, np.uint64))
        down = np.cumprod(np.full(n, inverse, np.uint64))
    return up, down


_power_cache: list = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > 2 * SLICE_BYTES:  # one token this long: not kept
        return _powers(n)
    if len(_power_cache[0]) < n:
        _power_cache[:] = _powers(max(n, SLICE_BYTES + (1 << 16)))
    return _power_cache[0][:n], _power_cache[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash are usable."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Classes of bytes: 0 separates tokens; a token is a run of one other class.
WORDS = np.zeros(256, np.uint8)
WORDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
NOT_SPACE = np.ones(256, np.uint8)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = 0
WORDS_AND_MARKS = WORDS + (NOT_SPACE & (WORDS == 0)) * np.uint8(2)


def _separator(data: np.ndarray, classes: np.ndarray, at: int) -> int:
    """Place of the first separator from ``at`` on, else the end."""
    while at < len(data):
        found = np.flatnonzero(classes[data[at : at + (1 << 16)]] == 0)
        if len(found):
            return at + int(found[0])
        at += 1 << 16
    return len(data)


def _tokens(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, class, hash) of the tokens; none goes over one of the offsets."""
    n = len(data)
    kind = classes[data]
    change = np.empty(n + 1, bool)
    change[:1] = change[-1:] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    change[offsets] = True
    edges = np.flatnonzero(change)
    live = kind[edges[:-1]] != 0 if n else np.empty(0, bool)
    start, end = edges[:-1][live], edges[1:][live]
    up, down = powers(n)
    with np.errstate(over="ignore"):
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTE_CODE[LOWER[data]] * up, out=total[1:])
        return start, end, kind[start], mix((total[end] - total[start]) * down[start])


class Tokens:
    """Tokens of a slice of texts: 64-bit hash, place in the bytes, and where each text's tokens begin."""

    def __init__(self, texts: pa.Array, classes: np.ndarray = WORDS):
        texts = texts.cast(pa.binary()) if not pa.types.is_binary(texts.type) else texts
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        buffer = texts.buffers()[2]
        self.data = data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.empty(0, np.uint8)
        self.text_offsets = offsets = offsets - offsets[0]
        # a long text goes in pieces that end at separators, so that memory stays in proportion to SLICE_BYTES
        cuts, at = [0], 0
        while len(data) - at > 2 * SLICE_BYTES:
            at = _separator(data, classes, at + SLICE_BYTES)
            cuts.append(at)
        cuts.append(len(data))
        pieces = [_tokens(data[a:b], offsets[(offsets >= a) & (offsets <= b)] - a, classes) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.start, self.end = (np.concatenate([p[k] + a for p, a in zip(pieces, cuts[:-1], strict=True)]) for k in (0, 1))
        self.kind, self.hash = (np.concatenate([p[k] for p in pieces]) for k in (2, 3))
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.first) - 1


def token_hashes(texts: pa.Array, classes: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, where each text's begin) of any number of texts, a slice at a time."""
    hashes, counts = [], []
    for batch in slices(pa.RecordBatch.from_arrays([texts], names=["t"]), "t"):
        t = Tokens(batch.column("t"), classes)
        hashes.append(t.hash)
        counts.append(np.diff(t.first))
    first = np.concatenate([[0], *counts]).cumsum()
    return np.concatenate(hashes) if hashes else np.empty(0, np.uint64), first


def rolling(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n tokens that begin at each token (those over the end wrap and are to be left out)."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(tokens), np.uint64)
        for k in range(n):
            out = out * np.uint64(0xD6E8FEB86659FD93) + np.roll(tokens, -k)
    return mix(out)
