"""Edits of pairwise alignments: gap correction, tails, repeats under a bait, stems.

Alignments have ``top`` (the reference), ``bottom`` (the read) and the columns of ``align.RESULT``.
The helpers work on one alignment; the operators run them in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqframe.functions import sequence as S
from seqframe.operators import align
from seqframe.sources.paths import spread

# Columns around a deletion in which an insertion matters, columns in which a staggered gap is looked for,
# longest deletion that is filled outside a homopolymer, columns of the tail that are judged.
NEAR, STAGGER, FILLED, TAIL = 6, 12, 2, 12


def in_homopolymer(whole: str, gapped: str, begin: int, end: int) -> bool:
    """Whether the letters over a gap run [begin, end) of ``gapped`` are one base that goes on, in both rows, at one side of the run."""
    if begin < 1 or begin + 1 >= len(whole) or len(set(whole[begin:end])) != 1:
        return False
    base = whole[begin]
    return whole[begin - 1] == base == gapped[begin - 1] or (end < len(whole) and whole[end] == base == gapped[end])


def _partner(top: str, bottom: list[str], at: int) -> int | None:
    """The single insertion within STAGGER columns that a single deletion at ``at`` is staggered with, left before right."""
    sides = (range(at, max(0, at - STAGGER), -1) if at >= 3 else (), range(at, min(len(top) - 1, at + STAGGER) + 1) if min(len(top) - 1, at + STAGGER) > at + 3 else ())
    for side, step in zip(sides, (-1, 1), strict=True):
        first = next((k for k in side if top[k] == "-"), None)
        if first is None or not bottom[first].isupper() or bottom[first] == "X":
            continue
        beyond = first + step
        last = 0 if step < 0 else min(len(top) - 1, at + STAGGER)
        if (beyond > last if step < 0 else beyond < last) and top[beyond] != "-":
            return first
    return None


def _repeats_beside(top: str, bottom: list[str], at: int) -> bool:
    """Whether a deletion stands next to two equal letters of the read and its letter is one of its neighbours, or follows CA over CAA."""
    n = len(bottom)
    double = (at > 2 and bottom[at - 1] == bottom[at - 2]) or (at + 2 < n and bottom[at + 1] == bottom[at + 2])
    beside = (at > 0 and top[at] == bottom[at - 1]) or (at < n - 1 and top[at] == bottom[at + 1])
    return (double and beside) or (at > 2 and bottom[at - 2 : at] == ["C", "A"] and top[at - 2 : at + 1] == "CAA")


def correct_gaps(top: str, bottom: str) -> tuple[str, str]:
    """The alignment with sequencing errors in gaps marked: spurious insertions are X, filled deletions lower-case letters of the reference.

    Gaps of three letters, or a multiple, are kept. An insertion in a homopolymer is spurious. A deletion without an insertion
    within NEAR columns is filled in a homopolymer, or if it has at most FILLED letters. With one, a staggered
    pair of single gaps is undone (X and a fill), and a letter beside a repeat is filled.
    """
    out, at = list(bottom), 0
    for run in re.finditer("-+", "".join("-" if "-" in pair else "." for pair in zip(top, bottom, strict=True))):
        at = run.start()
        while at < run.end():
            row = top if top[at] == "-" else "".join(out)
            end = at + len(re.match("-*", row[at:])[0])
            if end == at or (end - at) % 3 == 0:
                at = max(end, at + 1)
                continue
            if top[at] == "-" and in_homopolymer("".join(out), top, at, end):
                out[at:end] = "X" * (end - at)
            elif top[at] != "-" and "-" not in top[max(0, at - NEAR) : at + NEAR]:
                if end - at <= FILLED or in_homopolymer(top, "".join(out), at, end):
                    out[at:end] = top[at:end].lower()
            else:
                # one letter at a time: what is left of the gap is looked at anew, and kept once it is a multiple of three
                if top[at] != "-":
                    single = at + 1 >= len(out) or out[at + 1] != "-"
                    partner = _partner(top, out, at) if single else None
                    if partner is not None:
                        out[partner], out[at] = "X", top[at].lower()
                    elif _repeats_beside(top, out, at):
                        out[at] = top[at].lower()
                at += 1
                continue
            at = end
    return top, "".join(out)


def trim_tail(top: str, bottom: str, identity: float, cut: float = 0.85) -> tuple[str, str]:
    """The alignment cut at the first mismatch of its last TAIL columns while fewer than 0.9 of the identity, or of the cut, of them agree."""
    while len(top) >= 3 * TAIL:
        same = sum(a == b for a, b in zip(top[-TAIL - 1 :], bottom[-TAIL - 1 :], strict=True))
        if same / TAIL >= 0.9 * max(cut, identity):
            break
        at = next(k for k in range(len(top) - TAIL, len(top) + 1) if k == len(top) or top[k] != bottom[k])
        if at == len(top):
            break
        top, bottom = top[:at], bottom[:at]
    return top, bottom


def restore_edges(row: dict, ref: str, read: str, most: int = 4) -> dict:
    """Fewer than ``most`` unaligned letters at an end, as many in both (at the tail: enough in the read), put back."""
    top, bottom, begin, read_begin = row["top"], row["bottom"], row["ref_begin"], row["read_begin"]
    if begin == read_begin and 0 < begin < most:
        top, bottom, begin, read_begin = ref[:begin] + top, read[:begin] + bottom, 0, 0
    left, spare = len(ref) - row["ref_end"] - 1, len(read) - row["read_end"] - 1
    if 0 < left < most and spare >= left:
        top, bottom = top + ref[len(ref) - left :], bottom + read[row["read_end"] + 1 : row["read_end"] + 1 + left]
    return {"top": top, "bottom": bottom, "ref_begin": begin, "read_begin": read_begin}


def corrected(alignments: DataFrame, refs: DataFrame | None = None, reads: DataFrame | None = None, cut: float = 0.85) -> DataFrame:
    """Alignments with gaps corrected and tails trimmed; with refs (ref_id, seq) and reads (read_id, seq) edges are put back first."""
    rows = alignments
    if refs is not None and reads is not None:
        r = reads.select("read_id", F.col("seq").alias("__read"))
        rows = rows.join(r, "read_id").join(refs.select("ref_id", F.col("seq").alias("__ref")), "ref_id").withColumn("__read", F.when(F.col("strand") == "-", S.revcomp("__read")).otherwise(F.col("__read")))

    def one(row: dict) -> dict:
        top, bottom = correct_gaps(row["top"], row["bottom"])
        cut_top, cut_bottom = trim_tail(top, bottom, row["identity"], cut)
        out = {"top": cut_top, "bottom": cut_bottom, "ref_begin": row["ref_begin"], "read_begin": row["read_begin"]}
        if "__ref" in row and len(cut_top) == len(top):
            out = restore_edges({**row, **out}, row["__ref"], row["__read"])
        return out

    return _edited(rows, one, ["top", "bottom", "ref_begin", "read_begin"]).select(*alignments.columns)


def _edited(df: DataFrame, one: Callable[[dict], dict], changed: list[str], new: str = "") -> DataFrame:
    schema = T.StructType([*df.schema.fields, *(T._parse_datatype_string(new).fields if new else [])])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = pd.DataFrame([one(r) for r in pdf.to_dict("records")], columns=changed, index=pdf.index)
            for c in changed:
                pdf[c] = made[c]
            yield pdf[[f.name for f in schema]]

    return df.mapInPandas(run, schema)


# ---------------------------------------------------------------- repeats under a bait


def repeat_under(top: str, bottom: str, ref_begin: int, start: int, n: int, base: str) -> tuple[int, str | None]:
    """(repeats of base, None) in the read under the bait's repeat of n letters from ``start`` (0-based), or (0, the other text).

    The region is the repeat of the bait with the gaps before and after it, as far as the read goes on with the base there.
    """
    places = [k for k, c in enumerate(top) if c != "-"]
    first = start - ref_begin
    if not 0 <= first < len(places):
        return 0, None
    x = places[first - 1] + 1 if first else 0
    last = places[first]
    seen = 1
    for k in range(first + 1, min(first + n, len(places))):
        if top[places[k]] != base:
            break
        last, seen = places[k], seen + 1
    y = last + 1
    while y < len(top) and top[y] == "-" and bottom[y] == base:
        y += 1
    text = bottom[x:y].replace("-", "")
    return (len(text), None) if set(text) <= {base} else (0, text)


def repeat_in_bait(reads: DataFrame, bait: str, start: int, n: int, base: str, identity: float = 0.88, coverage: float = 0.7) -> DataFrame:
    """(read_id, strand, repeats, variant): the bait's repeat (1-based start) in the reads that it fishes out; reverse hits are turned."""
    refs = reads.sparkSession.createDataFrame([("bait", bait)], "ref_id string, seq string")
    a = align.align_join(reads, refs, "local", align.SCORES["bait"], seed=False, top=True).filter((F.col("identity") > identity) & (F.col("cov_ref") > coverage))

    def one(row: dict) -> dict:
        repeats, variant = repeat_under(row["top"], row["bottom"], row["ref_begin"], start - 1, n, base)
        return {"repeats": repeats, "variant": variant}

    return _edited(a.select("read_id", "strand", "top", "bottom", "ref_begin"), one, ["repeats", "variant"], "repeats int, variant string").select("read_id", "strand", "repeats", "variant")


def repeat_count_table(repeats: DataFrame) -> DataFrame:
    """(repeats, n, mean): histogram of repeat numbers; mean is that of the reads with any repeat."""
    mean = repeats.filter("repeats > 0").agg(F.avg("repeats").alias("mean"))  # one row
    return repeats.filter("variant is null").groupBy("repeats").agg(F.count("*").alias("n")).join(F.broadcast(mean))


def repeat_variants(repeats: DataFrame) -> DataFrame:
    return repeats.filter("variant is not null").groupBy("variant").agg(F.count("*").alias("n"))


def count_subsequence(reads: DataFrame, bait: str, begin: int, end: int, identity: float = 0.88, coverage: float = 0.99) -> DataFrame:
    """(text, n): what the reads have under the bait's letters begin to end (1-based), forward if it passes, else reverse."""
    refs = reads.sparkSession.createDataFrame([("bait", bait)], "ref_id string, seq string")
    a = align.align_join(reads, refs, "local", align.SCORES["global"], seed=False).filter((F.col("identity") > identity) & (F.col("cov_ref") > coverage))
    first = a.groupBy("read_id").agg(F.max_by(F.struct("top", "bottom", "ref_begin"), F.col("strand") == "+").alias("a")).select("read_id", "a.*")
    found = _edited(first, lambda r: {"text": align.text_under(r["top"], r["bottom"], r["ref_begin"], begin - 1, end - 1)}, ["text"], "text string")
    return found.filter("text <> ''").groupBy("text").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- stems


def stem_consensus(top: str, bottom: str, length: int = 24) -> tuple[str | None, str | None]:
    """(first, second) candidates of a stem from its two gapped arms; second is None where the arms agree.

    An alignment that is too long loses a head of As, or of GG, that only the lower arm lacks or has; else gap columns go, those
    next to the longest repeats first. Too short ones, and those that can't be made to fit, have no candidates; without any
    removable column both arms stay as they are.
    """
    if len(top) < length:
        return None, None
    extra = len(top) - length
    if extra and top[:extra] == "-" * extra and bottom[:extra] == "A" * extra:
        top, bottom = top[extra:], bottom[extra:]
    elif extra == 2 and top.startswith("GGG") and bottom.startswith("--G"):
        top, bottom = top[2:], bottom[2:]
    elif extra:
        columns = []
        for gapped, whole in ((top, bottom), (bottom, top)):
            for k, c in enumerate(gapped):
                if c == "-":
                    ahead = len(re.match(re.escape(whole[k]) + "*", whole[k:])[0])
                    behind = len(re.match(re.escape(whole[k]) + "*", whole[k::-1])[0])
                    repeat = ahead if ahead > 1 else behind
                    if repeat > 1:
                        columns.append((-repeat, k))
        if not columns:
            return top, bottom
        if len(columns) < extra:
            return None, None
        gone = {k for _, k in sorted(columns)[:extra]}
        top, bottom = ("".join(c for k, c in enumerate(row) if k not in gone) for row in (top, bottom))
    filled = lambda a, b: "".join(y if x == "-" else x for x, y in zip(a, b, strict=True))
    first, second = filled(top, bottom), filled(bottom, top)
    return first, None if first == second else second


# How a good arm ends, a common misreading of that, and the identity without end gaps below which arms with other ends are junk.
ARM_END, MISREAD_END, JUNK_ARMS = "CTC", "CCC", 0.82


def stem_candidates(top: str, bottom: str, arms: tuple[str, str] = ("", ""), begins: tuple[int, int] = (0, 0), noterm_identity: float = 1.0, length: int = 24) -> tuple[str | None, str | None]:
    """(first, second) as ``stem_consensus``, with the rules of the ends.

    Arms that don't both end in CTC must be alike between their end gaps; a CCC under or over a CTC is read as CTC. Of arms one letter
    short that end well, the one whose alignment begins at its second letter gets the first back. Candidates that stay too long are
    replaced by the arm of the right length, if there is one.
    """
    if not (top.endswith(ARM_END) and bottom.endswith(ARM_END)):
        if noterm_identity < JUNK_ARMS:
            return None, None
        if top.endswith(ARM_END) and bottom.endswith(MISREAD_END):
            bottom = bottom[: -len(ARM_END)] + ARM_END
        elif bottom.endswith(ARM_END) and top.endswith(MISREAD_END):
            top = top[: -len(ARM_END)] + ARM_END
    if len(top) == length - 1 and top.endswith(ARM_END) and bottom.endswith(ARM_END):
        if begins == (1, 0):
            top, bottom = arms[0][0] + top, "-" + bottom
        elif begins == (0, 1):
            top, bottom = "-" + top, arms[1][0] + bottom
    first, second = stem_consensus(top, bottom, length)
    if first and len(first) > length:
        return next((arm for arm in arms if len(arm) == length), None), None
    return first, second


def stem_pairs(halves: DataFrame, length: int = 24, mode: str = "global") -> DataFrame:
    """halves (top_seq, bottom_seq) with first, second, stem_length (0: no candidates), stem_identity, noterm_identity and identical of their alignment."""
    pairs = halves.withColumns({"ref_seq": F.col("top_seq"), "read_seq": F.col("bottom_seq")})
    kept = ["top", "bottom", "ref_begin", "read_begin", "noterm_identity", "identical"]
    aligned = align.align_pairs(spread(pairs), mode, align.SCORES["stem"]).select(*halves.columns, *kept, F.col("identity").alias("stem_identity"))

    def one(row: dict) -> dict:
        arms = tuple(row[c] if isinstance(row[c], str) else "" for c in ("top_seq", "bottom_seq"))
        first, second = stem_candidates(row["top"], row["bottom"], arms, (row["ref_begin"], row["read_begin"]), row["noterm_identity"], length)
        return {"first": first, "second": second, "stem_length": len(first or "")}

    made = _edited(aligned, one, ["first", "second", "stem_length"], "first string, second string, stem_length int")
    return made.select(*halves.columns, "first", "second", "stem_length", F.round("stem_identity", 2).alias("stem_identity"), "noterm_identity", "identical")


def stems(halves: DataFrame, length: int = 24, identity: float = 0.78, mode: str = "global") -> DataFrame:
    """(read_id, first, second, stem_length, stem_identity) of both arms (read_id, top_seq, bottom_seq) of each insert, aligned globally."""
    made = stem_pairs(halves, length, mode).filter((F.col("stem_identity") >= identity) & (F.col("stem_length") >= length))
    return made.select("read_id", "first", "second", "stem_length", "stem_identity")


# ---------------------------------------------------------------- merging


def zones(top: str, bottom: str, window: int = 50, high: float = 0.97) -> list[tuple[int, int, float]]:
    """(begin, end, identity) of stretches of alignment columns whose windows are all high, or all not."""
    same = [a == b and a != "-" for a, b in zip(top.upper(), bottom.upper(), strict=True)]
    if len(same) < window:
        return [(0, len(same), sum(same) / max(1, len(same)))]
    total = sum(same[:window])
    good = [total >= high * window]
    for k in range(window, len(same)):
        total += same[k] - same[k - window]
        good.append(total >= high * window)
    # a column is high if a high window covers it
    covered = [False] * len(same)
    reach = -1
    for k in range(len(same)):
        if k < len(good) and good[k]:
            reach = k + window - 1
        covered[k] = k <= reach
    out, begin = [], 0
    for k in range(1, len(same) + 1):
        if k == len(same) or covered[k] != covered[begin]:
            out.append((begin, k, sum(same[begin:k]) / (k - begin)))
            begin = k
    return out


def passes_qc(identity: float, length: int) -> Column:
    """Whether an alignment is good enough to join two sequences: nearly the same where they overlap, gaps of single letters aside, and over 0.8 of one of them."""
    c = F.col
    near = (c("cov_ref") > 0.8) | (c("cov_read") > 0.8)
    single = (c("gaplen_ref") - c("gaps_ref") < 3) & (c("gaplen_read") - c("gaps_read") < 3)
    same = ((c("identity") > 0.989) & near) | (single & (c("nogap_identity") > 0.989) & (near | (c("alnlen") > 1100)))
    return (c("alnlen") >= length) & (c("identity") >= identity) & same


def chimera_parts(top: str, bottom: str, read_begin: int, length: int) -> list[dict]:
    """Parts (kind, begin, end) of the read in an alignment with stretches of both kinds; none if there is one kind only or no part to merge.

    Long stretches of over 0.99 are merged, other long ones are scraps.
    """
    stretches = zones(top, bottom)
    if len(stretches) < 2:
        return []
    place, at = [], read_begin
    for c in bottom:
        place.append(at)
        at += c != "-"
    place.append(at)
    parts = [{"kind": "merged" if same > 0.99 else "scrap", "begin": place[a], "end": place[b]} for a, b, same in stretches if b - a > length]
    return parts if any(p["kind"] == "merged" for p in parts) else []


def merge_decision(alignments: DataFrame, reads: DataFrame, identity: float = 0.95, length: int = 200) -> DataFrame:
    """(read_id, ref_id, kind, seq): the parts of reads that consensus sequences absorb (kind merged), and the scraps that are left of these reads.

    A read that passes ``passes_qc`` is merged whole; where it covers over 0.9 of the consensus but less than 0.7 of it is aligned, its ends of more than
    ``length`` letters are scraps as well. Any other long alignment over the identity is looked through for a chimera.
    """
    r = reads.select("read_id", F.col("seq").alias("__read"))
    # neither side's size is foreseen where it comes from a kernel or explode, and none may be broadcast
    rows = alignments.join(r.hint("merge"), "read_id").withColumn("__read", F.when(F.col("strand") == "-", S.revcomp("__read")).otherwise(F.col("__read")))
    part = lambda kind, begin, end: F.struct(F.lit(kind).alias("kind"), begin.cast("int").alias("begin"), end.cast("int").alias("end"))
    zero, size = F.lit(0), F.length("__read")
    over = (F.col("cov_ref") > 0.9) & (F.col("cov_read") < 0.7)
    head = F.when(over & (F.col("read_begin") > length), part("scrap", zero, F.col("read_begin")))
    tail = F.when(over & (size - F.col("read_end") > length), part("scrap", F.col("read_end"), size))
    passed = passes_qc(identity, length)
    own = ["read_id", "ref_id", "__read"]
    whole = rows.filter(passed).select(*own, F.explode(F.array_compact(F.array(part("merged", zero, size), head, tail))).alias("p"))
    covers = (F.col("cov_ref") > 0.7) | (F.col("cov_read") > 0.7)
    others = rows.filter(~passed & (F.col("identity") > identity) & (F.col("alnlen") > 3 * length) & covers).select(*own, "top", "bottom", "read_begin")
    made = _edited(others, lambda x: {"parts": chimera_parts(x["top"], x["bottom"], x["read_begin"], length)}, ["parts"], "parts array<struct<kind:string,begin:int,end:int>>")
    parts = whole.unionByName(made.select(*own, F.explode("parts").alias("p")))
    piece: Column = F.substring(F.col("__read"), F.col("p.begin") + 1, F.col("p.end") - F.col("p.begin"))
    return parts.select("read_id", "ref_id", "p.kind", piece.alias("seq"))
