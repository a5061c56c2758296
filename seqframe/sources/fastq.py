"""FASTQ through Spark's text source, so that any path Spark can read will do and files are read by ranges.

Records are cut where a line begins with ``@``. A quality line may begin with it too: then the record comes in
two pieces, of three lines and of one, which follow each other in the file. Pieces of one range are put together
as it is read; a record that is cut by the border of two ranges leaves a piece in each, and these few pieces are joined in file order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqframe.functions import sequence as S

PIECES = "head string, seq string, qual33 string, src string, ord long, part int"
#: Kinds of rows: a whole record, its first three lines, its quality line alone.
WHOLE, FIRST, LAST = 0, 1, 2


#: A whole record with a quality; what differs from it is looked at line by line.
RECORD = r"^(?P<head>[^\n]*)\n(?P<seq>[^\n]*)\n\+[^\n]*\n(?P<qual33>[^\n]+)"


def _pieces(cut: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole records of a range, or with ``cut`` the pieces at its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # a first piece that waits for its quality line
        here: tuple = ()  # its file, and where its range begins and ends
        place: dict[tuple[str, int], int] = {}
        for batch in batches:
            if not len(batch):
                continue
            value, src, start, length = (batch.column(c) for c in ("value", "src", "start", "length"))
            value = pc.replace_substring(value, "\r", "")
            plain = pc.match_substring_regex(value, RECORD).to_numpy(zero_copy_only=False)
            starts = start.to_numpy(zero_copy_only=False)
            # numbers of the records in their ranges
            at = np.arange(len(batch))
            changes = (starts[1:] != starts[:-1]) | pc.not_equal(src.slice(1), src.slice(0, len(src) - 1)).to_numpy(zero_copy_only=False)
            begins = [0, *(np.flatnonzero(changes) + 1).tolist(), len(batch)]
            for lo, hi in zip(begins, begins[1:]):
                key = src[lo].as_py(), int(starts[lo])
                at[lo:hi] += place.get(key, -1) + 1 - lo
                place[key] = int(at[hi - 1])
            out: list[tuple] = []
            odd = np.flatnonzero(~plain).tolist()[::-1]
            while odd or before:
                # while a piece waits, the next row is looked at, whatever it is
                k = (0 if before[0] is not batch else before[1] + 1) if before else odd[-1]
                if k >= len(batch):
                    break
                if odd and odd[-1] == k:
                    odd.pop()
                text, file, begin, number = value[k].as_py(), src[k].as_py(), int(starts[k]), int(at[k])
                lines = text.removesuffix("\n").split("\n")
                piece, before = before[2] if before else None, None
                if piece and (file, begin) not in ((here[0], here[1]), (here[0], here[2])):
                    out.append(piece)
                    piece = None
                if piece:
                    # the quality line that began with @, of this range or of the next one read here
                    if len(lines) != 1:
                        raise ValueError(f"no quality line after {piece[0]} of {file}")
                    out.append((*piece[:2], "@" + lines[0], *piece[3:5], WHOLE))
                elif plain[k]:
                    pass
                elif len(lines) >= 4 and lines[2].startswith("+"):
                    out.append((lines[0], lines[1], lines[3], file, begin + number, WHOLE))
                elif len(lines) == 3 and lines[2].startswith("+"):
                    before, here = (batch, k, (lines[0], lines[1], None, file, begin + number, FIRST)), (file, begin, begin + length[k].as_py())
                elif len(lines) == 1 and number == 0 and begin > 0:
                    out.append((None, None, "@" + lines[0], file, begin, LAST))
                elif text.strip():
                    raise ValueError(f"no record at {text[:40]!r} of {file}")
            if not cut and plain.any():
                keep = pa.array(plain)
                parts = pc.extract_regex(value.filter(keep), RECORD)
                yield pa.RecordBatch.from_arrays([*parts.flatten(), src.filter(keep), pa.array((starts + at)[plain]), pa.array(np.full(int(plain.sum()), WHOLE, np.int32))], names=NAMES)
            yield from _batch(out, cut)
        if before:
            yield from _batch([before[2]], cut)

    return run


NAMES = ["head", "seq", "qual33", "src", "ord", "part"]


def _batch(rows: list[tuple], cut: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string()] * 4 + [pa.int64(), pa.int32()]
    if rows := [r for r in rows if (r[5] != WHOLE) == cut]:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=NAMES)


def read_fastq(spark: SparkSession, path: str | list[str], offset: int = 33) -> DataFrame:
    """(read_id, title, seq, qual, src, ord) with decoded qualities; ord grows along a file."""
    raw = spark.read.option("lineSep", "\n@").text(path).select("value", F.col("_metadata.file_path").alias("src"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_block_length").alias("length"))
    whole = raw.mapInArrow(_pieces(False), PIECES).drop("part")
    cut = raw.mapInArrow(_pieces(True), PIECES)
    after = Window.partitionBy("src").orderBy("ord", F.desc("part"))  # at most two pieces a range
    mended = cut.withColumn("next", F.lead("qual33").over(after)).filter(F.col("part") == FIRST)
    mended = mended.filter(F.when(F.col("next").isNull(), F.raise_error(F.concat(F.lit("no quality line after "), "head"))).otherwise(F.lit(True)))
    rows = whole.unionByName(mended.select("head", "seq", F.col("next").alias("qual33"), "src", "ord"))
    name = F.regexp_replace("head", "^@", "")
    return rows.select(F.regexp_extract(name, r"^(\S*)", 1).alias("read_id"), F.trim(F.regexp_replace(name, r"^\S*", "")).alias("title"), "seq", S.decode_quality("qual33", offset).alias("qual"), "src", "ord")
