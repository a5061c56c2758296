"""Pileups of alignments: base, insert and codon counts, consensus, genotypes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqframe.functions import sequence as S
from seqframe.sources.paths import shared_folder


#: Alignment columns that a task works on at once.
COLUMNS = 1 << 20


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins; one byte a letter."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8), offsets - offsets[0]


def _texts(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _columns(batch: pa.RecordBatch, quality: bool) -> list[pa.Array]:
    """Columns of all positions of a batch of alignments, by running counts over their letters."""
    (top, first), (bottom, _) = _letters(batch.column("t")), _letters(batch.column("b"))
    row = np.repeat(np.arange(len(batch)), np.diff(first))
    place = top != 45
    at = np.flatnonzero(place)
    owner = row[at]
    before = np.concatenate([[0], np.cumsum(place)])
    pos = batch.column("ref_begin").to_numpy()[owner] + before[at] - before[first[owner]] + 1
    # what stands between two positions of a row belongs to the first of them
    extra = np.flatnonzero(~place & (bottom != ord("X")) & (bottom != 45))
    behind = before[extra] - 1
    extra = extra[(behind >= 0) & (row[at[behind]] == row[extra])] if len(at) else extra[:0]
    inserted = np.bincount(before[extra] - 1, minlength=len(at)) if len(at) else np.empty(0, np.int64)
    take = pa.array(owner)
    out = [batch.column("read_id").take(take), batch.column("ref_id").take(take), pa.array(pos.astype(np.int32)), batch.column("w").take(take), _texts(bottom[at], np.ones(len(at), np.int64)), _texts(bottom[extra], inserted)]
    if quality:
        letter = (bottom != 45) & ~((bottom >= 97) & (bottom <= 122))
        read = np.concatenate([[0], np.cumsum(letter)])
        lists = batch.column("qs")
        begin, size = lists.offsets.to_numpy()[:-1].astype(np.int64), np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
        index = batch.column("rb").to_numpy()[owner] + read[at] - read[first[owner]]
        known = (index >= 0) & (index < size[owner])
        value = lists.values.take(pa.array(np.where(known, begin[owner] + index, 0), mask=~known))
        lower = pc.floor(pc.multiply(value.cast(pa.float64()), 0.8)).cast(pa.int32())
        out.append(pc.if_else(pa.array(bottom[at] == 45), lower, value.cast(pa.int32())))
    return out


def alignment_columns(alignments: DataFrame, weight: str | None = None, quality: str | None = None) -> DataFrame:
    """(read_id, ref_id, pos, w, base, ins[, q]): one row a reference position (1-based) of each alignment; ``ins`` is what the read has after it.

    X marks a spurious insertion and is left out. The work is linear in the alignment: places are running counts over its letters.
    ``quality`` names the read's array of qualities, in the direction of the alignment;
    q is that of the base, at a filled (lower-case) base that of the next one, at a gap 0.8 of the next one's, rounded down.
    """
    plain = F.coalesce("top", F.lit("")), F.coalesce("bottom", F.lit(""))
    rows = alignments.select("read_id", "ref_id", F.col("ref_begin").cast("int"), plain[0].alias("t"), plain[1].alias("b"), (F.col(weight) if weight else F.lit(1)).alias("w"), *([F.col(quality).alias("qs"), F.col("read_begin").cast("int").alias("rb")] if quality else []))
    schema = T.StructType([rows.schema["read_id"], rows.schema["ref_id"], T.StructField("pos", T.IntegerType()), rows.schema["w"], T.StructField("base", T.StringType()), T.StructField("ins", T.StringType()), *([T.StructField("q", T.IntegerType())] if quality else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, at = np.cumsum(np.asarray(pc.binary_length(batch.column("t"))).astype(np.int64)), 0
            while at < len(batch):
                end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + COLUMNS, side="right")))
                yield pa.RecordBatch.from_arrays(_columns(batch.slice(at, end - at), bool(quality)), names=schema.names)
                at = end

    return rows.mapInArrow(run, schema)


def placed(alignments: DataFrame, weight: str | None = None) -> DataFrame:
    """(read_id, ref_id, ref_begin, w, bases, inserts): one row an alignment; bases has one letter for each reference position it covers.

    inserts has what the read has after each of them, comma-joined, and is null where it has nothing. X marks a spurious insertion and is left out.
    """
    plain = F.coalesce("top", F.lit("")), F.coalesce("bottom", F.lit(""))
    rows = alignments.select("read_id", "ref_id", F.col("ref_begin").cast("int"), (F.col(weight) if weight else F.lit(1)).alias("w"), plain[0].alias("t"), plain[1].alias("b"))
    schema = T.StructType([*rows.schema.fields[:4], T.StructField("bases", T.StringType()), T.StructField("inserts", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, inserts = batch.column("b").to_pylist(), [None] * len(batch)
            for k in np.flatnonzero(pc.match_substring(batch.column("t"), "-").to_numpy(zero_copy_only=False)).tolist():
                held = []
                for x, y in zip(batch.column("t")[k].as_py(), bases[k], strict=True):
                    if x != "-":
                        held.append([y, ""])
                    elif held and y not in "X-":
                        held[-1][1] += y
                bases[k] = "".join(y for y, _ in held)
                inserts[k] = ",".join(i for _, i in held) if any(i for _, i in held) else None
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(bases, pa.string()), pa.array(inserts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def placed_columns(rows: DataFrame) -> DataFrame:
    """(ref_id, pos, w, base, ins) of ``placed`` rows, as ``alignment_columns`` has them; made within the row, so they stay spread as the rows are."""
    letters = rows.filter("bases <> ''").select("ref_id", "ref_begin", "w", F.split("bases", "").alias("letters"), F.split("inserts", ",").alias("extra"))
    each = letters.select("ref_id", "ref_begin", "w", "extra", F.posexplode("letters").alias("i", "base"))
    ins = F.when(F.col("extra").isNull(), "").otherwise(F.get("extra", F.col("i")))
    return each.filter("base <> ''").select("ref_id", (F.col("ref_begin") + F.col("i") + 1).alias("pos"), "w", "base", ins.alias("ins"))


def quality_table(columns: DataFrame) -> DataFrame:
    """(ref_id, pos, mean, std, n): qualities of each position, weighted by copies; columns have q."""
    q, w = F.col("q"), F.col("w")
    rows = columns.filter("q is not null").groupBy("ref_id", "pos").agg(F.sum(w).alias("n"), F.sum(w * q).alias("s"), F.sum(w * q * q).alias("ss"))
    var = (F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)
    return rows.select("ref_id", "pos", (F.col("s") / F.col("n")).alias("mean"), F.when(F.col("n") > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("std"), "n")


def pileup(columns: DataFrame) -> DataFrame:
    """(ref_id, pos, base, n)"""
    return columns.groupBy("ref_id", "pos", "base").agg(F.sum("w").alias("n"))


def inserts(columns: DataFrame) -> DataFrame:
    return columns.filter("ins <> ''").groupBy("ref_id", "pos", "ins").agg(F.sum("w").alias("n"))


def position_table(counts: DataFrame, key: str = "base", position: str = "pos") -> DataFrame:
    """Counts with their share of the position and rank, most first."""
    w = Window.partitionBy("ref_id", position)
    return counts.withColumn("fraction", F.col("n") / F.sum("n").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("n"), key)))


def shown_inserts(columns: DataFrame, least: int = 100, share: float = 0.1) -> DataFrame:
    depth = columns.groupBy("ref_id", "pos").agg(F.sum("w").alias("depth"))
    return inserts(columns).join(depth, ["ref_id", "pos"]).filter((F.col("n") > least) & (F.col("n") > share * F.col("depth")))


#: Positions in a segment of a consensus.
SEGMENT = 1 << 16


def segments(symbols: DataFrame, by: str = "ref_id", size: int = SEGMENT) -> DataFrame:
    """(by, segment, text): the symbols (by, pos, b) of each range of ``size`` positions, joined in order of position; no array is longer than a range."""
    rows = symbols.select(by, F.floor((F.col("pos") - 1) / size).cast("int").alias("segment"), F.struct("pos", "b").alias("r"))
    return rows.groupBy(by, "segment").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["b"]), "").alias("text"))


def joined_segments(parts: DataFrame, by: str = "ref_id", name: str = "consensus") -> DataFrame:
    """(by, name): the segments of each sequence as one text."""
    rows = F.array_sort(F.collect_list(F.struct("segment", "text")))
    return parts.groupBy(by).agg(F.array_join(F.transform(rows, lambda r: r["text"]), "").alias(name))


def consensus_simple(counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """(ref_id, consensus): the most frequent symbol of each position of the reference, - where there is none."""
    return joined_segments(consensus_simple_segments(counts, lengths))


def consensus_simple_segments(counts: DataFrame, lengths: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(ref_id, segment, text) of ``consensus_simple``."""
    top = counts.groupBy("ref_id", "pos").agg(F.max(F.struct("n", (-F.ascii("base")).alias("o"), "base")).alias("t")).select("ref_id", "pos", "t.base")
    long = lengths.filter("length > 0").select("ref_id", F.col("length").cast("int").alias("length"), F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size).cast("int"))).alias("k"))
    every = long.select("ref_id", F.explode(F.sequence(F.col("k") * size + 1, F.least((F.col("k") + 1) * size, F.col("length")))).alias("pos"))
    return segments(every.join(top, ["ref_id", "pos"], "left").select("ref_id", "pos", F.coalesce("base", F.lit("-")).alias("b")), size=size)


def consensus_weighted(columns: DataFrame, gap_lead: float = 0.15, insert_share: float = 0.48) -> DataFrame:
    """(ref_id, consensus): a gap leads only by over gap_lead of the depth, else the second symbol; inserts of over insert_share of the depth are put in."""
    return joined_segments(consensus_weighted_segments(columns, gap_lead, insert_share))


def consensus_weighted_segments(columns: DataFrame, gap_lead: float = 0.15, insert_share: float = 0.48, size: int = SEGMENT) -> DataFrame:
    """(ref_id, segment, text) of ``consensus_weighted``; segments are ranges of positions of the reference."""
    # symbols and inserts are counted in one pass, so that the alignments are walked once
    columns = columns.groupBy("ref_id", "pos", "base", "ins").agg(F.sum("w").alias("w"))
    both = F.array(F.struct(F.lit(0).alias("kind"), F.col("base").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("ins").alias("text")))
    counts = columns.select("ref_id", "pos", "w", F.explode(both).alias("x")).groupBy("ref_id", "pos", "x.kind", "x.text").agg(F.sum("w").alias("n"))
    w = Window.partitionBy("ref_id", "pos").orderBy("kind", F.desc("n"), "text")
    ranked = counts.withColumn("r", F.row_number().over(w))
    of = lambda r, c: F.max(F.when((F.col("kind") == 0) & (F.col("r") == r), F.col(c)))
    one = ranked.groupBy("ref_id", "pos").agg(F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("depth"), of(1, "text").alias("b1"), of(1, "n").alias("n1"), of(2, "text").alias("b2"), of(2, "n").alias("n2"), F.max(F.when((F.col("kind") == 1) & (F.col("text") != ""), F.struct("n", F.col("text").alias("ins")))).alias("i"))
    symbol = F.when(F.col("b1") != "-", F.col("b1")).when(F.col("b2").isNull() | (F.col("n1") - F.col("n2") > gap_lead * F.col("depth")), "").otherwise(F.col("b2"))
    extra = F.when((F.col("i.n") > 1) & (F.col("i.n") > insert_share * F.col("depth")), F.col("i.ins")).otherwise("")
    return segments(one.select("ref_id", "pos", F.concat(symbol, F.coalesce(extra, F.lit(""))).alias("b")), size=size)


def coverage(columns: DataFrame) -> DataFrame:
    """(ref_id, pos, cons, nogap, total): reads with the consensus symbol, without gap, and all."""
    counts = pileup(columns)
    return counts.groupBy("ref_id", "pos").agg(F.max("n").alias("cons"), F.sum(F.when(F.col("base") != "-", F.col("n")).otherwise(0)).alias("nogap"), F.sum("n").alias("total"))


def coverage_summary(cover: DataFrame) -> DataFrame:
    return cover.groupBy("ref_id").agg(*[f(c).alias(f"{n}_{c}") for c in ("cons", "nogap", "total") for n, f in (("mean", F.avg), ("std", F.stddev_samp))])


def codon_counts(columns: DataFrame, frame: int = 0) -> DataFrame:
    """(ref_id, codon_idx, codon, n): whole codons of each read, from the frame on."""
    return per_read_codons(columns, frame).groupBy("ref_id", "codon_idx", "codon").agg(F.sum("w").alias("n"))


def _codon(idx: Column, frame: int) -> Column:
    """The codon of that index of a ``placed`` row, null where the row does not cover all of it."""
    at = idx * 3 + frame - F.col("ref_begin")
    return F.when((at >= 0) & (at + 3 <= F.length("bases")), F.substring(F.col("bases"), (at + 1).cast("int"), F.lit(3)))


def placed_codon_counts(rows: DataFrame, frame: int = 0) -> DataFrame:
    """``codon_counts`` of ``placed`` rows: codons are cut out of a row, without a shuffle by read."""
    first = F.greatest(F.ceil((F.col("ref_begin") - frame) / 3), F.lit(0))
    last = F.floor((F.col("ref_begin") + F.length("bases") - frame) / 3) - 1
    each = rows.filter(first <= last).select("ref_id", "ref_begin", "bases", "w", F.explode(F.sequence(first, last)).alias("codon_idx"))
    return each.select("ref_id", "codon_idx", _codon(F.col("codon_idx"), frame).alias("codon"), "w").groupBy("ref_id", "codon_idx", "codon").agg(F.sum("w").alias("n"))


def placed_genotype(rows: DataFrame, positions: list[int], frame: int = 0) -> DataFrame:
    """``linked_genotype`` of ``placed`` rows, a read's codons cut out of its row."""
    named = rows.select("ref_id", "w", F.concat(*[_codon(F.lit(k), frame) for k in sorted(set(positions))]).alias("genotype")).filter("genotype is not null")
    return _genotypes(named)


def per_read_codons(columns: DataFrame, frame: int = 0) -> DataFrame:
    idx = F.floor((F.col("pos") - 1 - frame) / 3)
    rows = columns.filter(F.col("pos") > frame).withColumn("codon_idx", idx)
    g = rows.groupBy("read_id", "ref_id", "codon_idx", "w").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "").alias("codon"))
    return g.filter(F.length("codon") == 3)


def linked_genotype(columns: DataFrame, positions: list[int], frame: int = 0) -> DataFrame:
    """(ref_id, genotype, aa, n, fraction): codons at the chosen indexes, of reads that cover all of them."""
    c = per_read_codons(columns, frame).filter(F.col("codon_idx").isin(positions))
    parts = F.array_sort(F.collect_list(F.struct("codon_idx", "codon")))
    reads = c.groupBy("read_id", "ref_id", "w").agg(parts.alias("p")).filter(F.size("p") == len(positions))
    named = reads.select("ref_id", "w", F.array_join(F.transform("p", lambda x: x["codon"]), "").alias("genotype"))
    return _genotypes(named)


def _genotypes(named: DataFrame) -> DataFrame:
    counts = named.groupBy("ref_id", "genotype").agg(F.sum("w").alias("n"))
    return counts.withColumn("aa", S.translate("genotype")).withColumn("fraction", F.col("n") / F.sum("n").over(Window.partitionBy("ref_id")))


def genotype_aa(genotypes: DataFrame) -> DataFrame:
    return genotypes.groupBy("ref_id", "aa").agg(F.sum("n").alias("n"))


def alignment_summary(alignments: DataFrame) -> DataFrame:
    """(score, identity, coverage, readlen, n) with two decimals."""
    return alignments.groupBy("score", F.round("identity", 2).alias("identity"), F.round("cov_read", 2).alias("coverage"), F.length(F.replace(F.col("bottom"), F.lit("-"), F.lit(""))).alias("readlen")).agg(F.count("*").alias("n"))


def genotype(reads: DataFrame, refs: DataFrame, positions: list[int], frame: int = 0, identity: float = 0.85, length: int = 20, pairs: DataFrame | None = None) -> dict[str, DataFrame]:
    """Both rounds of genotype counting: the best reference by number of reads, then counts against it with gaps corrected.

    reads are (read_id, seq[, qual]). ``pairs`` are the mates of reads, with the same ids: they are counted
    as reads of their own, and "mates" has the number of each pair of directions. The chosen reference id is the only value that is ordered over all. Reads that fail
    the cuts but have an alignment of 1.5 times the length are kept in "failed".
    """
    from seqframe.operators.align import align_join, join_mates
    from seqframe.operators.gaps import corrected

    own = [c for c in ("read_id", "seq", "qual") if c in reads.columns]
    every = reads.select(*own, F.lit(1).alias("mate"))
    if pairs is not None:
        every = every.unionByName(pairs.select(*own, F.lit(2).alias("mate")))
    # the mate is part of the id while both are aligned
    tagged = every.withColumn("read_id", F.concat("read_id", F.lit("/"), F.col("mate").cast("string")))
    first = align_join(tagged.select("read_id", "seq"), refs, identity=identity, length=length, top=True)
    best = first.groupBy("ref_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ref_id").limit(1).select("ref_id")
    chosen = _written(refs.join(best, "ref_id", "left_semi"), "chosen")
    second = align_join(tagged.select("read_id", "seq"), chosen, identity=identity, length=length, top=True)
    second = _written(corrected(second, chosen, tagged, identity), "second")
    held = second
    if "qual" in own:
        held = second.join(tagged.select("read_id", "qual"), "read_id").withColumn("qual", F.when(F.col("strand") == "-", F.reverse("qual")).otherwise(F.col("qual")))
    columns = alignment_columns(held, quality="qual" if "qual" in own else None)
    counts = pileup(columns)
    rows = placed(held)
    genotypes = placed_genotype(rows, positions, frame)
    out = {
        "alignments": second, "summary": alignment_summary(second), "bases": position_table(counts), "inserts": inserts(columns), "codons": position_table(placed_codon_counts(rows, frame), "codon", "codon_idx"),
        "genotypes": genotypes, "genotypes_aa": genotype_aa(genotypes), "consensus": consensus_simple(counts, chosen.select("ref_id", F.length("seq").alias("length"))),
        "failed": tagged.join(second.select("read_id"), "read_id", "left_anti").filter(F.length("seq") > 1.5 * length),
    }
    if "qual" in own:
        out["qualities"] = quality_table(columns)
    if pairs is not None:
        side = lambda k: second.filter(F.col("read_id").endswith(f"/{k}")).withColumn("read_id", F.regexp_replace("read_id", "/[12]$", ""))
        out["mates"] = join_mates(side(1), side(2)).groupBy("pair").agg(F.count("*").alias("n"))
    return out


def genotype_paired(first: DataFrame, second: DataFrame, refs: DataFrame, positions: list[int], **options) -> dict[str, DataFrame]:
    """``genotype`` over both mates of each read, in both directions, with the table of direction pairs."""
    return genotype(first, refs, positions, pairs=second, **options)


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
