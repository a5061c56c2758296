"""Trims of whole tables: by quality, by poly-A peaks and complexity, in staged columns."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqframe.functions import sequence as S
from seqframe.sources.paths import spread


def trim_low_quality(df: DataFrame, window: int = 6, cut: int = 20, longer_than: int = 17, seq: str = "seq", qual: str = "qual") -> DataFrame:
    """Reads cut before the first window whose mean quality is below the cut; those left with more than 17 bases stay."""
    keep = df.withColumn("__keep", S.keep_length_by_quality(qual, window, cut))
    cutdown = keep.withColumn(seq, F.substring(F.col(seq), F.lit(1), F.col("__keep"))).withColumn(qual, F.slice(F.col(qual), F.lit(1), F.col("__keep")))
    return cutdown.filter(F.col("__keep") > longer_than).drop("__keep")


def trim_sweep(df: DataFrame, grid: tuple[tuple[int, int], ...] = ((4, 20), (5, 20), (6, 20), (4, 19), (5, 19), (6, 19))) -> DataFrame:
    """(window, cut, mean, std, n): length statistics of each trim of the grid, in one pass over the reads."""
    kept = F.array(*[F.struct(F.lit(w).alias("window"), F.lit(c).alias("cut"), S.keep_length_by_quality("qual", w, c).alias("n")) for w, c in grid])
    rows = df.select(F.explode(kept).alias("t")).select("t.*").filter("n > 17")
    return rows.groupBy("window", "cut").agg(F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"), F.count("*").alias("n_reads"))


# Lengths that let the left side of an inner run stay: of A, X and N runs; the head before a T run that goes.
LEFT_OF_A, LEFT_OF_X, LEFT_OF_N, HEAD_OF_T = 400, 170, 160, 40


def _one_side(text: str, pattern: str, enough: int, again: bool) -> str:
    """The left group of a match if it is longer than enough or than the right one, else that; again until nothing matches."""
    while match := re.search(pattern, text):
        text = match[1] if len(match[1]) > max(enough, 0) or len(match[1]) > len(match[2]) else match[2]
        if not again:
            break
    return text


def trim_simple_text(text: str) -> str:
    text = text.upper()
    for pattern, keep in S.SIMPLE_TRIMS:
        text = re.sub(pattern, keep.replace("$1", r"\1"), text)
    match = re.search("^(.+)[NA]{28,}(.+)$", text)
    if match and (len(match[1]) > len(match[2]) or len(match[1]) > LEFT_OF_A):
        text = match[1]
    match = re.search("^(.+)T{26,}(.+)$", text)
    if match and len(match[1]) < HEAD_OF_T:
        text = match[2]
    text = _one_side(text, "([ACGT]+)X+([ACGT]+)", LEFT_OF_X, True)
    text = re.sub(S.N_TAIL, "", text)
    return _one_side(text, "([ACGT]+)N{3,}([ACGT]+)", LEFT_OF_N, True)


def simple_trim(df: DataFrame, seq: str = "seq") -> DataFrame:
    """End trims of simple pieces, then one side of inner A, T, X and N runs."""
    return _kernel(df, seq, trim_simple_text)


# A junk end may hold better windows if it is so many times longer than these, or is longer than 40 and they are shorter than 27;
# junk begins, or ends, at one of these runs; a text is simple if over 0.9 of its windows are below 4.
JUNK_RATIO, JUNK_LONG, GOOD_SHORT = 2.8, 40, 27
POLYMER = re.compile("A{6}|C{6}|G{6}|T{6}|N")
SIMPLE_SHARE, SIMPLE_BELOW = 0.9, 4


def complexity_values(text: str, window: int) -> list[int]:
    """int(9 * changes / window) of each window that fits."""
    if len(text) < window:
        return []
    letters = np.frombuffer(text.upper().encode("utf-32-le"), "<u4")
    known = letters != ord("N")
    steps = (letters[1:] != letters[:-1]) & known[1:] & known[:-1]
    total = np.concatenate([[0], np.cumsum(steps)])
    return (9 * (total[window - 1 :] - total[: len(total) - window + 1]) // window).tolist()


def _junk(values: str, better: str) -> int:
    """Length of the junk at the head of a string of window values: windows of 0 and 1, or some better ones and then many more of these."""
    if plain := re.match("[01]+", values):
        return plain.end()
    mixed = re.match(f"({better}+?)([01]+)", values)
    if mixed:
        good, bad = len(mixed[1]), len(mixed[2])
        if bad / good > JUNK_RATIO or (bad > JUNK_LONG and good < GOOD_SHORT):
            return mixed.end()
    return 0


def complexity_trim_text(text: str, window: int) -> tuple[str, int]:
    """(text, code): -1 too short, 1 simple (both whole), else the sum of 2 for a tail and 3 for a head cut.

    A junk tail goes from its first polymer or N on; a junk head goes up to the last one in the window after it.
    """
    if len(text) <= window:
        return text, -1
    values = complexity_values(text, window)
    if sum(v < SIMPLE_BELOW for v in values) > SIMPLE_SHARE * len(values):
        return text, 1
    code, digits = 0, "".join(map(str, values))
    tail = _tail_junk(digits)
    if tail and (found := POLYMER.search(text, len(digits) - tail)):
        text, digits, code = text[: found.start()], digits[: found.start()], 2
    head = _junk(digits, "[0-5]")
    if head:
        ends = [m.end() for m in re.finditer("A{6,}|C{6,}|G{6,}|T{6,}", text[head : head + window])] or [m.end() for m in re.finditer("N", text[head : head + window])]
        text, code = text[head + (ends[-1] if ends else 0) :], code + 3
    return text, code


def _tail_junk(digits: str) -> int:
    """The same at the tail: from the first run of 0 and 1 that only windows up to 6 follow."""
    if plain := re.search("[01]+$", digits):
        return len(plain[0])
    mixed = re.search("([01]+)([0-6]+?)$", digits)
    if mixed and (len(mixed[1]) / len(mixed[2]) > JUNK_RATIO or (len(mixed[1]) > JUNK_LONG and len(mixed[2]) < GOOD_SHORT)):
        return len(mixed[0])
    return 0


def complexity_trim(df: DataFrame, window: int = 20, least: int = 32, seq: str = "seq") -> DataFrame:
    """Low-complexity ends cut, with ``code`` (see complexity_trim_text); -1 too where fewer than ``least`` letters are left; null sequences have -1."""
    names = [c for c in df.columns if c != "code"]
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField("code", T.IntegerType())])

    def one(text: str | None) -> tuple[str | None, int]:
        if text is None:
            return None, -1
        cut, code = complexity_trim_text(text, window)
        return cut, code if len(cut) >= least else -1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cut = [one(s) for s in pdf[seq]]
            pdf[seq], pdf["code"] = [s for s, _ in cut], [c for _, c in cut]
            yield pdf[[*names, "code"]]

    return spread(df).mapInPandas(run, schema)


def poly_peaks(text: str, base: str, window: int = 10) -> list[tuple[int, int, float, float, int]]:
    """(begin, end, area, height, top), 0-based, of islands of positive pair scores of the base."""
    steps = [1 if text[k] in (base, "N") and text[k + 1] in (base, "N") else -1 for k in range(len(text) - 1)]
    if len(steps) < window - 1:
        return []
    total = sum(steps[: window - 1])
    scores = [total / 2]
    for k in range(window - 1, len(steps)):
        total += steps[k] - steps[k - window + 1]
        scores.append(total / 2)
    out, k = [], 0
    while k < len(scores):
        if scores[k] > 0:
            j = k
            while j < len(scores) and scores[j] > 0:
                j += 1
            part = scores[k:j]
            out.append((k, j - 1, sum(part), max(part), k + part.index(max(part))))
            k = j
        else:
            k += 1
    return out


def _cut_tail(text: str, near: int, area: float, window: int = 10) -> str:
    """text before the largest poly-A peak that reaches within ``near`` of the end and has at least the area."""
    close = [p for p in poly_peaks(text, "A", window) if len(text) - (p[1] + window) <= near and p[2] >= area]
    if not close:
        return text
    begin = max(close, key=lambda p: (p[2], -p[0]))[0]
    while begin < len(text) and text[begin] != "A":
        begin += 1
    return text[:begin]


# How near to the end a peak must reach, and its least area.
POLY_NEAR, POLY_AREA = 45, 20
_SWAP = str.maketrans("ACGTacgt", "TGCAtgca")


def _cut_head(text: str, near: int, area: float) -> str:
    return _cut_tail(text[::-1].translate(_SWAP), near, area)[::-1].translate(_SWAP)


def remove_poly_a(df: DataFrame, near: int = POLY_NEAR, area: float = POLY_AREA, seq: str = "seq") -> DataFrame:
    """The tail from a poly-A peak near the 3' end cut off."""
    return _kernel(df, seq, lambda s: _cut_tail(s, near, area))


def remove_poly_t(df: DataFrame, near: int = POLY_NEAR, area: float = POLY_AREA, seq: str = "seq") -> DataFrame:
    """The head up to a poly-T peak near the 5' end cut off."""
    return _kernel(df, seq, lambda s: _cut_head(s, near, area))


def _mean(values: list[int]) -> float:
    return sum(values) / len(values) if values else 0.0


def cut_peak_text(text: str, window: int = 20) -> str:
    """The text before its largest poly-A peak, if more stands before than after it and is no simpler by 0.3, or is complex (over 5) and long, or little follows."""
    peaks = poly_peaks(text, "A")
    if not peaks:
        return text
    begin, end = max(peaks, key=lambda p: (p[2], -p[0]))[:2]
    values = complexity_values(text, window)
    before, after = _mean(values[:begin]), _mean(values[end + 10 :])
    left = len(values) - end - 10
    goes = begin > left and (before > after - 0.3 or (before > 5 and (left < 50 or begin > 150)))
    start = text.find("A", begin)
    return text[: start if start >= 0 else begin] if goes else text


def cut_peak(df: DataFrame, window: int = 20, seq: str = "seq") -> DataFrame:
    """Everything from the largest poly-A peak on cut off, where the complexity on both sides of it allows that."""
    return _kernel(df, seq, lambda s: cut_peak_text(s, window))


def cut_tail_after_peak_text(text: str, window: int = 20) -> str:
    """What follows the largest poly-A peak goes, if it is shorter or simpler than what stands before it; the peak stays."""
    peaks = poly_peaks(text, "A")
    if not peaks:
        return text
    begin, end = max(peaks, key=lambda p: (p[2], -p[0]))[:2]
    values = complexity_values(text, window)
    stop = end + 10
    while stop > begin and text[stop - 1 : stop] not in ("A", "a"):
        stop -= 1
    shorter = len(text) - stop < begin
    return text[:stop] if shorter or _mean(values[:begin]) > _mean(values[stop:]) else text


def cut_tail_after_peak(df: DataFrame, window: int = 20, seq: str = "seq") -> DataFrame:
    return _kernel(df, seq, lambda s: cut_tail_after_peak_text(s, window))


# An island of pair scores counts with an area over 25, a width over 7 or a height over 1.
PEAK_AREA, PEAK_WIDTH, PEAK_HEIGHT = 25, 7, 1


def short_read_peaks(text: str, window: int = 10) -> list[tuple[int, int, float, float, int]]:
    """(begin, end, area, height, top), 0-based, end excluded: islands of scores of ``window`` pairs of letters (half of AA pairs less others).

    An island begins where the score rises from 0 and goes on while it is not below 0; one that is positive from the first letter is none.
    """
    letters = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
    like = (letters == ord("A")) | (letters == ord("N"))
    if len(letters) <= window:
        return []
    total = np.concatenate([[0], np.cumsum(np.where(like[:-1] & like[1:], 1, -1))])
    scores = (total[window:] - total[:-window]) / 2
    begins = np.flatnonzero((scores[1:] > 0) & (scores[:-1] == 0)) + 1
    below = np.append(np.flatnonzero(scores < 0), len(scores))
    out, last = [], 0
    for b in begins.tolist():
        if b >= last:
            last = int(below[np.searchsorted(below, b)])
            part = scores[b:last]
            area, height = float(part.sum()), float(part.max())
            if area > PEAK_AREA or last - b > PEAK_WIDTH or height > PEAK_HEIGHT:
                out.append((b, last, area, height, b + int(part.argmax())))
    return out


def _peak_goes(values: list[int], begin: int, end: int, window: int = 10) -> bool:
    """Whether a peak may be cut: more stands before than after it, and that is no simpler by 0.3, or complex (over 5) and long, or little follows."""
    left = len(values) - end - window
    before, after = _mean(values[:begin]), _mean(values[end + window :])
    return begin > left and (before > after - 0.3 or (before > 5 and (left < 50 or begin > 150)))


def short_read_poly_a_text(text: str, window: int = 20) -> str:
    """A run of nine As with at most nine letters after it goes. If nine As are left, or it did not, peaks are cut from the last to the first at
    the first of their highest places, until one can't be; if any was, the largest of the others is tried once more."""
    cut = re.sub("A{9,}[ACGTN]{1,9}$", "", text)
    if cut != text and "A" * 9 not in cut:
        return cut
    peaks = short_read_peaks(cut)
    n, values = len(peaks), complexity_values(cut, window) if peaks else []

    def goes(peak: tuple) -> bool:
        nonlocal cut, values
        if not _peak_goes(values, peak[0], peak[1]):
            return False
        gone = len(cut) - peak[4]
        cut, values = cut[: peak[4]], values[: max(len(values) - gone, 0)]
        return True

    while peaks and goes(peaks[-1]):
        peaks.pop()
    if peaks and len(peaks) < n:
        goes(max(peaks, key=lambda p: (p[2], -p[0])))
    return cut


def short_read_poly_a(df: DataFrame, seq: str = "seq") -> DataFrame:
    return _kernel(df, seq, short_read_poly_a_text)


def _kernel(df: DataFrame, seq: str, one, dealt: bool = False) -> DataFrame:
    """df with one(text) for each text; ``dealt`` where a kernel before has spread the rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[seq] = [None if s is None else one(s) for s in pdf[seq]]
            yield pdf

    return (df if dealt else spread(df)).mapInPandas(run, df.schema)


def clean_reads(df: DataFrame, least: int = 50, shift: int | None = None, name: str = "read_id") -> DataFrame:
    """Reads of at least 50 bases that are no artifacts, one for each name, qualities shifted on demand."""
    from seqframe.operators.dedupe import unique_by_id

    df = unique_by_id(df.filter((F.length("seq") >= least) & ~S.is_artifact("seq")), name)
    return df.withColumn("qual", S.shift_quality("qual", shift)) if shift else df


def clean_short_reads(df: DataFrame, least: int = 26) -> DataFrame:
    """N-trimmed reads without simple, repeated or polymer sequences, one for each sequence with its count, renumbered by sequence."""
    from pyspark.sql import Window

    # an array of the one text, as Spark puts the whole trim into each place of a filter that names it
    good = lambda s: s.isNotNull() & ~S.is_simple(s) & ~S.is_repeat(s) & ~S.has_long_polymer(s)
    t = df.select(F.explode(F.filter(F.array(S.trim_n_longest("seq", least)), good)).alias("seq"))
    counts = t.groupBy("seq").agg(F.count("*").alias("n"))
    part = F.substring("seq", 1, 4)
    sizes = counts.groupBy(part.alias("p")).agg(F.count("*").alias("m"))
    before = sizes.withColumn("before", F.coalesce(F.sum("m").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("m")
    numbered = counts.withColumn("p", part).withColumn("k", F.row_number().over(Window.partitionBy("p").orderBy("seq"))).join(before, "p")
    return numbered.select(F.concat(F.lit("s"), (F.col("k") + F.col("before")).cast("string")).alias("seq_id"), "seq", "n")


def clean_est_text(text: str, windows: tuple[int, int] = (40, 20), short_reads: bool = False) -> str:
    """Complexity trims where 12 As or Ts stand together, poly-A off where 10 As do, poly-T where 9 Ts do; empty if it is simple or too short for the last window."""
    if re.search("A{12}|T{12}", text):
        text, _ = complexity_trim_text(text, windows[0])
        text, code = complexity_trim_text(text, windows[1])
        if code in (-1, 1):
            return ""
    if "A" * 10 in text:
        text = short_read_poly_a_text(text, windows[1]) if short_reads else _cut_tail(text, POLY_NEAR, POLY_AREA)
    return _cut_head(text, POLY_NEAR, POLY_AREA) if "T" * 9 in text else text


def clean_est(df: DataFrame, least: int = 32, seq: str = "seq", short_reads: bool = False) -> DataFrame:
    """Upper case, simple trims, no junk repeats, then ``clean_est_text``; over ``least`` letters left. Null sequences go."""
    df = simple_trim(df.withColumn(seq, F.upper(seq)), seq)
    df = df.filter((F.length(seq) >= least) & ~S.is_junk_repeat(seq))
    return _kernel(df, seq, lambda s: clean_est_text(s, short_reads=short_reads), dealt=True).filter(F.length(seq) > least)


def clean_est_report(df: DataFrame, least: int = 32, longest: int = 999_999, seq: str = "seq", short_reads: bool = False) -> dict[str, DataFrame]:
    """"clean"; "long", those of it over ``longest`` letters; "raw_lengths" of all sequences and "long_lengths" of the long ones (length, n)."""
    done = clean_est(df, least, seq, short_reads)
    long = done.filter(F.length(seq) > longest)
    lengths = lambda t: t.groupBy(F.length(seq).alias("length")).agg(F.count("*").alias("n"))
    return {"clean": done, "long": long, "raw_lengths": lengths(df), "long_lengths": lengths(long)}


def clean_vector_est(df: DataFrame, least: int = 35, seq: str = "seq") -> DataFrame:
    """Vector X off, N by distance, poly tails exposed, low complexity and peaks cut."""
    df = df.withColumn(seq, S.trim_n_by_distance(S.trim_vector_x(seq, least=least))).filter(F.col(seq).isNotNull())
    df = df.withColumn(seq, S.expose_poly_tail(seq)).filter(F.length(seq) >= least)
    df = complexity_trim(df, 20, least=least, seq=seq).filter("code not in (-1, 1)").drop("code")
    return _kernel(df, seq, cut_peak_text, dealt=True).filter(F.length(seq) >= least)
