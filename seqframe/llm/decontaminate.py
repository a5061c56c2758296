"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

Text is normalised by lower-casing A-Z and taking words of ASCII letters,
digits and all non-ASCII characters. Words of the benchmark are numbered and the
automaton runs over word numbers, so each document is scanned once and a match is a
word range, which is mapped back to character offsets of the original text.

Null and empty texts have no words and no hits. A null item id still marks words
but is not listed. Repeated rows give repeated results. Input columns named like
an output column are replaced.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import add_columns, field, quoted

#: Bytes of benchmark text in one automaton. A larger benchmark is dealt into several automata, run one after another.
AUTOMATON_BYTES = 4 << 20

_KEEP = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256)).lower()
_WORD = re.compile(rb"[^ ]+")
SPANS = "array<struct<item_id:string,word_start:int,word_end:int,char_start:int,char_end:int>>"


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_KEEP).split()


def _symbol(n: int) -> str:
    return chr(n + 1 if n + 1 < 0xD800 else n + 0x801)


class Scanner:
    """The automaton of some benchmark items, and the scan of one text."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.numbers: dict[bytes, str] = {}
        found: dict[str, set] = {}
        for item, text in items:
            words = normal_words(text)
            symbols = "".join(self.numbers.setdefault(w, _symbol(len(self.numbers) + 1)) for w in words)
            for i in range(max(1, len(symbols) - window + 1) if symbols else 0):
                found.setdefault(symbols[i : i + window], set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for key, ids in found.items():
            self.automaton.add_word(key, (len(key), tuple(ids)))
        self.empty = not found
        if not self.empty:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[dict]]:
        """Number of words, and for each item the merged word ranges its windows cover."""
        words = normal_words(text)
        if self.empty or not words:
            return len(words), []
        get = self.numbers.get
        ranges: dict = {}
        for end, (length, items) in self.automaton.iter("".join([get(w, "\0") for w in words])):
            for item in items:
                own = ranges.setdefault(item, [])
                # windows of one item may differ in length only when the same id has several texts
                if own and end + 1 - length <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(own[-1][0], end + 1 - length), end + 1
                else:
                    own.append([end + 1 - length, end + 1])
        if not ranges:
            return len(words), []
        raw = text.encode("utf-8", "surrogatepass")
        places = [m.span() for m in _WORD.finditer(raw.translate(_KEEP))]
        chars = lambda at: len(raw[:at].decode("utf-8", "surrogatepass"))
        spans = [{"item_id": i, "word_start": a, "word_end": b, "char_start": chars(places[a][0]), "char_end": chars(places[b - 1][1])} for i, own in ranges.items() for a, b in own]
        return len(words), sorted(spans, key=lambda s: (s["word_start"], s["word_end"], s["item_id"] or ""))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """docs with ``n_words int`` and ``spans``: the word and character ranges of benchmark windows in each text."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(quoted(item_id)).cast("string").alias("i"), F.coalesce(F.col(quoted(item_text)), F.lit("")).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("b")).first()["b"]
    shards = max(1, -(-2 * total // AUTOMATON_BYTES))
    items = items.withColumn("shard", F.pmod(F.xxhash64("t"), F.lit(shards)))
    out = docs
    for shard in range(shards):
        part = [(r["i"], r["t"]) for r in items.filter(F.col("shard") == shard).select("i", "t").collect()]
        out = _scan(out, spark.sparkContext.broadcast(part), text, window, first=shard == 0)
    return out


def _scan(docs: DataFrame, shared, text: str, window: int, first: bool) -> DataFrame:
    def make():
        scanner = Scanner(shared.value, window)

        def step(texts: pa.Array):
            found = [scanner.scan(t) for t in texts.to_pylist()]
            return [n for n, _ in found], [s for _, s in found]

        return step

    names = ("n_words", "spans") if first else ("__words", "__spans")
    out = add_columns(docs, text, [field(names[0], "int"), field(names[1], SPANS)], make)
    return out if first else out.withColumn("spans", F.concat("spans", "__spans")).drop("__words", "__spans")


def leak_digest(found: DataFrame) -> DataFrame:
    """Counts of hit words and items from ``spans``, and the flag ``contaminated``."""
    spans, plain = F.col("spans"), F.size("spans") == 0
    words = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["word_start"], s["word_end"] - 1))))
    items = F.array_sort(F.array_distinct(F.filter(F.transform(spans, lambda s: s["item_id"]), lambda i: i.isNotNull())))
    return (
        found.withColumn("n_hit", F.when(plain, F.lit(0)).otherwise(F.size(words)).cast("long"))
        .withColumn("n_items", F.when(plain, F.lit(0)).otherwise(F.size(items)).cast("long"))
        .withColumn("items_sha256", F.sha2(F.when(plain, F.lit("")).otherwise(F.array_join(items, ",")), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .withColumn("n_words", F.col("n_words").cast("long"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    kept = docs.columns
    tagged = docs.select(F.struct(*[F.col(quoted(c)) for c in kept]).alias("__row"), F.col(quoted(text)).alias("__body"))
    found = find_leaks(tagged, benchmark, text="__body", **options)
    return found.filter(F.size("spans") == 0).select("__row.*")
