"""Column functions on sequences, qualities and identifiers. No UDF: all of it stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), made once a row: where value is named in a lambda, Spark may put its whole expression there, to be made for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


# ------------------------------------------------------------ strands, parts

# Complements of the nucleotide codes.
NUCLEOTIDES, COMPLEMENTS = "ACGTacgtRYKMBVDHrykmbvdh", "TGCAtgcaYRMKVBHDyrmkvbhd"


def revcomp(seq: str | Column) -> Column:
    """Reverse complement with ambiguity codes; U counts as T."""
    return F.reverse(F.translate(rna_to_dna(seq), NUCLEOTIDES, COMPLEMENTS))


def rna_to_dna(seq: str | Column) -> Column:
    return F.translate(col(seq), "Uu", "Tt")


def subseq(seq: str | Column, begin: int | Column, end: int | Column | None = None) -> Column:
    """1-based inclusive part; without end, to the end of the sequence."""
    s, b = col(seq), F.lit(begin) if isinstance(begin, int) else begin
    e = F.length(s) if end is None else F.lit(end) if isinstance(end, int) else end
    return F.substring(s, b, F.greatest(e - b + 1, F.lit(0)))


def head(seq: str | Column, n: int) -> Column:
    return F.substring(col(seq), 1, n)


def tail(seq: str | Column, n: int) -> Column:
    s = col(seq)
    return F.substring(s, F.greatest(F.length(s) - n + 1, F.lit(1)), F.lit(n))


def delete_range(seq: str | Column, begin: int, end: int) -> Column:
    s = col(seq)
    return F.concat(F.substring(s, 1, begin - 1), F.substring(s, F.lit(end + 1), F.length(s)))


def insert_text(seq: str | Column, after: int, text: str) -> Column:
    s = col(seq)
    return F.concat(F.substring(s, 1, after), F.lit(text), F.substring(s, F.lit(after + 1), F.length(s)))


def replace_range(seq: str | Column, begin: int, end: int, text: str) -> Column:
    s = col(seq)
    return F.concat(F.substring(s, 1, begin - 1), F.lit(text), F.substring(s, F.lit(end + 1), F.length(s)))


def relocate(seq: str | Column, position: int | Column) -> Column:
    """A circular sequence turned so that it begins at the 1-based position."""
    s, p = col(seq), F.lit(position) if isinstance(position, int) else position
    return F.concat(F.substring(s, p, F.length(s)), F.substring(s, F.lit(1), p - 1))


# ------------------------------------------------------------ composition


def count_of(seq: str | Column, letters: str) -> Column:
    """How many of the letters are in the sequence, in either case."""
    s = col(seq)
    both = letters.upper() + letters.lower()
    return F.length(s) - F.length(F.translate(s, both, ""))


def gc(seq: str | Column) -> Column:
    """(G+C)/(A+C+G+T); null if there are none."""
    known = count_of(seq, "ACGT")
    return F.when(known > 0, count_of(seq, "GC") / known)


def n_fraction(seq: str | Column) -> Column:
    known = count_of(seq, "ACGTN")
    return F.when(known > 0, count_of(seq, "N") / known)


def is_unambiguous(seq: str | Column) -> Column:
    return col(seq).rlike("^[ACGTacgt]+$")


def base_fraction(seq: str | Column, base: str) -> Column:
    s = col(seq)
    # two replacements cost far less than one translate, which looks each letter up
    others = F.replace(F.replace(s, F.lit(base.upper())), F.lit(base.lower()))
    return (F.length(s) - F.length(others)) / F.length(s)


def is_simple(seq: str | Column, cut: float = 0.9) -> Column:
    """One of A, C, G, T, N makes more than cut of the sequence."""
    return F.greatest(*[base_fraction(seq, b) for b in "ACGTN"]) > cut


def is_low_complexity(seq: str | Column, cut: float = 0.85) -> Column:
    """At most two of A, C, G, T, N occur, or one is more than cut."""
    kinds = reduce(lambda a, b: a + b, [(count_of(seq, x) > 0).cast("int") for x in "ACGTN"])
    return (kinds <= 2) | is_simple(seq, cut)


# ------------------------------------------------------------ runs

RUN = r"((.)\2*)"


def runs(seq: str | Column) -> Column:
    """All runs of one letter, in order."""
    return F.regexp_extract_all(col(seq), F.lit(RUN), F.lit(1))


def longest_run(seq: str | Column, bases: str = "ACGT") -> Column:
    """Length of the longest run of one of the bases, N counting as any."""
    longest = [F.coalesce(F.array_max(F.transform(F.regexp_extract_all(col(seq), F.lit(f"([{b}N]+)"), F.lit(1)), F.length)), F.lit(0)) for b in bases]
    return F.greatest(*longest)


def is_repeat(seq: str | Column, cut: float = 0.89) -> Column:
    # runs are looked for only where a base and N are so frequent that there can be one
    frequent = F.greatest(*[base_fraction(seq, b) for b in "ACGT"]) + base_fraction(seq, "N") > cut - 1e-9
    return frequent & (longest_run(seq) / F.length(col(seq)) > cut)


def is_artifact(seq: str | Column, run: int = 10, fraction: float = 0.5) -> Column:
    """Runs longer than ``run`` make more than the fraction of the sequence."""
    long = F.filter(F.transform(runs(seq), F.length), lambda n: n > run)
    return F.aggregate(long, F.lit(0), lambda a, n: a + n) > fraction * F.length(col(seq))


def has_long_polymer(seq: str | Column, n: int = 31) -> Column:
    return (F.length(col(seq)) >= n) & col(seq).rlike("|".join(f"{b}{{{n}}}" for b in "ACGT"))


def is_junk_repeat(seq: str | Column, fraction: float = 0.27, run: int = 6) -> Column:
    """Runs of at least ``run`` of one base or N make more than the fraction."""
    total = [F.length(F.array_join(F.regexp_extract_all(col(seq), F.lit(f"({b}{{{run},}})"), F.lit(1)), "")) for b in "ACGTN"]
    return reduce(lambda a, b: a + b, total) > fraction * F.length(col(seq))


def repeat_base_count(seq: str | Column, base: str) -> Column:
    """Number of the base, gaps ignored; null where another letter occurs."""
    s = F.regexp_replace(col(seq), "-", "")
    return F.when(s.rlike(f"^{base}*$"), F.length(s))


# ------------------------------------------------------------ codons, motifs

# Genetic code 1, codons in the order T, C, A, G of each place.
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


# A text with each codon once, and the amino acids of the codons by place in it; place 0 is an unknown codon.
CODONS = "TTTCTTATTGTCCTCATCGTACTAATAGTGCTGATGGCCCACCGCAACAGCGACGGAAAGAGGGTT"
AMINO_ACIDS = "X" + "".join(GENETIC_CODE[sum("TCAG".index(b) * 4 ** (2 - k) for k, b in enumerate(CODONS[i : i + 3]))] for i in range(len(CODONS) - 2))


def translate(seq: str | Column, frame: int = 1, reverse: bool = False) -> Column:
    """Protein of one frame (1-3) by genetic code 1; unknown codons are X, a partial last codon is left out."""
    s = F.replace(F.upper(revcomp(seq) if reverse else col(seq)), F.lit("U"), F.lit("T"))
    codons = F.regexp_extract_all(F.substring(s, frame, (1 << 31) - 1), F.lit("(...)"), F.lit(1))
    amino = F.array(*[F.lit(a) for a in AMINO_ACIDS])
    return F.array_join(F.transform(codons, lambda codon: F.get(amino, F.position(codon, F.lit(CODONS)))), "")


def motif_positions(seq: str | Column, regex: str) -> Column:
    """1-based starts of all matches, overlapping ones too."""
    s = col(seq)
    starts = F.when(F.length(s) > 0, F.sequence(F.lit(1), F.length(s))).otherwise(F.array().cast("array<int>"))
    return F.filter(starts, lambda i: F.substring(s, i, F.length(s)).rlike(f"^(?:{regex})"))


# Classes of the nucleotide codes.
IUPAC = {"N": "[ACGT]", "R": "[AG]", "Y": "[CT]", "M": "[AC]", "K": "[GT]", "S": "[CG]", "W": "[AT]", "B": "[CGT]", "D": "[AGT]", "H": "[ACT]", "V": "[ACG]"}


def iupac_regex(site: str | Column) -> Column:
    """Regular expression of a site with ambiguity codes."""
    # codes go to lower case first, so that the letters of their classes are not replaced again
    out = F.translate(F.upper(col(site)), "".join(IUPAC), "".join(IUPAC).lower())
    for code, cls in IUPAC.items():
        out = F.replace(out, F.lit(code.lower()), F.lit(cls))
    return out


def site_regex(site: str | Column) -> Column:
    """The site or its reverse complement."""
    return F.concat(iupac_regex(site), F.lit("|"), iupac_regex(revcomp(site)))


def site_weight(site: str | Column) -> Column:
    """1 for a fixed base, 1/2 for a two-way code, 1/3 for a three-way code, 0 for N."""
    return count_of(site, "ACGT") + count_of(site, "RYMKSW") * 0.5 + count_of(site, "BDHV") / 3.0


# ------------------------------------------------------------ qualities


def decode_quality(text: str | Column, offset: int = 33) -> Column:
    """Quality text to an array of Phred values."""
    some = F.when(col(text) != "", F.split(col(text), ""))
    return F.transform(F.when(col(text) == "", F.array().cast("array<string>")).otherwise(some), lambda c: F.ascii(c) - offset)


def encode_quality(qual: str | Column, offset: int = 33) -> Column:
    return F.array_join(F.transform(col(qual), lambda q: F.char(q + offset)), "")


def quality_sum(qual: str | Column) -> Column:
    return F.aggregate(col(qual), F.lit(0).cast("long"), lambda a, q: a + q)


def mean_quality(qual: str | Column) -> Column:
    return quality_sum(qual) / F.size(col(qual))


def shift_quality(qual: str | Column, k: int) -> Column:
    return F.transform(col(qual), lambda q: q + k)


def accuracy_to_q(accuracy: str | Column) -> Column:
    """-10 log10(1 - a)."""
    return -10 * F.log10(1 - col(accuracy))


def keep_length_by_quality(qual: str | Column, window: int = 6, cut: int = 20) -> Column:
    """Length left of the first window from the 5' end whose mean quality is below cut; the whole length if there is none."""
    low = lambda q: F.array_position(F.transform(sums(q, window), lambda n: n < cut * window), True)
    return bound(col(qual), lambda q: bound(low(q), lambda at: F.when(at > 0, at - 1).otherwise(F.size(q)).cast("int")))


# ------------------------------------------------------------ trims


def trim_n_ends(seq: str | Column) -> Column:
    return F.regexp_replace(col(seq), "^[Nn]+|[Nn]+$", "")


def trim_n_longest(seq: str | Column, least: int = 26) -> Column:
    """N cut from the ends, then the longest part between inner Ns (the first of equals); null if shorter than least."""
    parts = F.split(trim_n_ends(seq), "[Nn]+")
    best = F.array_max(F.transform(parts, lambda p, i: F.struct(F.length(p).alias("n"), (-i).alias("at"), p.alias("p"))))["p"]
    return bound(F.when(col(seq).rlike("[Nn]"), best).otherwise(col(seq)), lambda b: F.when(F.length(b) >= least, b))


def trim_n_halves(seq: str | Column, least: int = 28) -> Column:
    """N cut from the ends; a head before inner Ns goes if it is less than half of the read, then a tail after them; null if shorter than least."""
    s = trim_n_ends(seq)
    head, rest = F.regexp_extract(s, "^([ACGT]*?)N+([ACGT]+)", 1), F.regexp_extract(s, "^([ACGT]*?)N+([ACGT]+)", 2)
    s = F.when((rest != "") & (F.length(head) < F.length(s) * 0.5), rest).otherwise(s)
    keep, tail = F.regexp_extract(s, "([ACGT]+)N+([ACGT]*?)$", 1), F.regexp_extract(s, "([ACGT]+)N+([ACGT]*?)$", 2)
    s = F.when((keep != "") & (F.length(tail) < F.length(s) * 0.5), keep).otherwise(s)
    return F.when(F.length(s) >= least, s)


# Letters that go with one N, two, ... at the head and at the tail; a tail after five Ns goes whatever its length.
N_HEADS = "^(?:[ACGT]{0,10}N|[ACGT]{0,30}NN|[ACGT]{0,90}NNN)+"
N_TAILS = (10, 30, 90, 270)


def trim_n_by_distance(seq: str | Column) -> Column:
    """Heads and tails with Ns near the end cut, the further in the more Ns there are, until nothing is left to cut.

    A run of Ns goes, with all that follows it, if no more letters lie between it and the end than its length allows. The runs are
    taken from the last to the first, each against the end that is left then.
    """
    s = F.regexp_replace(col(seq), N_HEADS, "")
    runs = F.transform(F.regexp_extract_all(s, F.lit("(N+)[^N]*")), lambda x: F.length(x))
    pieces = F.transform(F.regexp_extract_all(s, F.lit("(N+[^N]*)")), lambda x: F.length(x))
    both = F.reverse(F.arrays_zip(runs.alias("run"), pieces.alias("piece")))
    limit = lambda run: F.coalesce(F.get(F.array(*map(F.lit, N_TAILS)), run - 1), F.lit(1 << 30))
    # the letters between the run and the end: those after it in its piece, and what is left of the later pieces
    left = F.aggregate(both, F.lit(0), lambda t, x: F.when(x["piece"] - x["run"] + t <= limit(x["run"]), 0).otherwise(x["piece"] + t))
    gone = F.aggregate(pieces, F.lit(0), lambda t, x: t + x) - left
    return F.substring(s, F.lit(1), F.length(s) - gone)


def trim_vector_x(seq: str | Column, edge: int = 40, least: int = 35) -> Column:
    """X runs within ``edge`` of an end are cut with what is outside them, again and again; of the two sides of the last inner X the longer stays."""
    s = F.regexp_replace(col(seq), f"^(?:[ACGTN]{{0,{edge}}}X+)+", "")
    s = F.regexp_replace(s, f"(?:X+[ACGTN]{{0,{edge}}})+$", "")
    parts = F.filter(F.split(s, "X+"), lambda p: p != "")
    best = F.array_max(F.transform(parts, lambda p, i: F.struct(F.length(p).alias("n"), (-i).alias("at"), p.alias("p"))))["p"]
    return F.when(F.length(best) >= least, best)


def second_n_rule(seq: str | Column, after: int = 25) -> Column:
    """A sequence with no N, or with one, passes; one whose second N comes after ``after`` is cut before it; others are null."""
    s = F.upper(col(seq))
    first = F.locate("N", s)
    second = F.when(first > 0, F.position(F.lit("N"), s, first + 1)).otherwise(0)
    return F.when((first == 0) | (second == 0), col(seq)).when(second > after, F.substring(col(seq), F.lit(1), second - 1))


def trim_poly_a(seq: str | Column, least: int = 5) -> Column:
    return F.regexp_replace(col(seq), f"[aA]{{{least},}}$", "")


def poly_tail_length(seq: str | Column) -> Column:
    return F.length(F.regexp_extract(col(seq), "([aA]+)$", 1))


def first_n_run(seq: str | Column, least: int = 5) -> Column:
    """Length of the first run of at least ``least`` N."""
    return F.length(F.regexp_extract(col(seq), f"([nN]{{{least},}})", 1))


# Junk outside long T runs at the head and A runs at the tail, in order of use; the first group stays.
POLY_HEADS = ("^[ACGTN]{1,24}(T{12,})", "^[ACGTN]{1,40}(T{17,})", "^[ACGTN]{1,100}(?:GCCC|TCTC|CCGCC)(T{12,})", "^[ACGTN]{1,80}[GC]{9,12}(T{12,})", "^[ACGTN]{1,80}[GC]{9,12}TC(T{12,})", "^[CGT]{1,7}(T{12,})")
POLY_TAILS = ("(A{12,})[ACGTN]{1,5}$", "(A{17,})[ACGTN]{1,35}$", "([AN]{37,})[ACGTN]{1,75}$", "([AN]{80,})[ACGTN]{1,375}$", "(A{12,})GGGCGG[ACGTN]{1,500}", "(A{12,})[GC]{10}TC[ACGTN]{1,500}")


def expose_poly_tail(seq: str | Column) -> Column:
    """Junk outside long T runs at the head and A runs at the tail is removed; after the first run of 30 As and Ns that has an N and ends after 450, all goes."""
    s = reduce(lambda s, rule: F.regexp_replace(s, rule, "$1"), POLY_HEADS + POLY_TAILS, col(seq))
    upto, run = F.regexp_extract(s, "^(.*?[AN]{30,})", 1), F.regexp_extract(s, "([AN]{30,})", 1)
    return F.when((F.length(upto) > 450) & F.contains(run, F.lit("N")), upto).otherwise(s)


# End trims of simple pieces, in order of use; the tail rule for N comes after the inner X runs.
SIMPLE_TRIMS = (
    ("^(?:[AC]{1,2}T{10,}|A{1,2}T{10,}|C{1,2}T{4,}A{4,})", ""),
    ("(?:N[ACGT]{0,6})+$", ""),
    ("(A{17,})[CGTN]$", "$1"),
    ("^(?:[ACGT]{0,6}N)+", ""),
    ("^[ACGN](T{17,})", "$1"),
    ("^(?:[NT]{6,}|[ACGN]{1,2}[NT]{6,}|[ACGT]{1,18}T{14,}|[ACGT]{1,7}T{8,}|[ACGT]{1,7}T{7,}CT{7,})", ""),
    ("(?:[NA]{6,}|[NA]{6,}[CGT]{1,2})$", ""),
    ("A{12,}[CGT][ACGTN]{0,22}$", ""),
)
N_TAIL = "(?:N+[ACGT]{0,18})+$"


def simple_trim(seq: str | Column) -> Column:
    """End trims of simple pieces; the sides of inner runs are chosen by operators.trims.simple_trim."""
    return reduce(lambda s, rule: F.regexp_replace(s, *rule), SIMPLE_TRIMS, F.upper(col(seq)))


# ------------------------------------------------------------ windows over one sequence


def change_windows(seq: str | Column, w: int) -> Column:
    """int(9 * changes / w) for each start; a change is two different neighbours that aren't N."""
    changes = neighbours(F.upper(col(seq)), lambda a, b: ((a != b) & (a != "N") & (b != "N")).cast("int"))
    return F.transform(sums(changes, w - 1), lambda n: F.floor(9 * n / w).cast("int"))


def letters(text: str | Column) -> Column:
    """The characters of a text as an array."""
    return F.filter(F.split(col(text), ""), lambda c: c != "")


def neighbours(text: Column, score: Callable[[Column, Column], Column]) -> Column:
    """Scores of the neighbouring letters of a text, in order."""
    return bound(letters(text), lambda c: F.zip_with(F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), score))


def sums(values: Column, window: int) -> Column:
    """Sums of whole numbers in each window that fits."""
    def made(v: Column) -> Column:
        n = F.size(v) - window + 1
        # element by element, as a slice copies the whole array each time
        return F.when(n >= 1, F.transform(F.sequence(F.lit(0), n - 1), lambda i: reduce(lambda a, b: a + b, [F.get(v, i + k) for k in range(window)]))).otherwise(F.array().cast("array<int>"))

    return bound(values, made)


def sliding_identity(spacer: str | Column, w: int = 60) -> Column:
    """Best mean of match marks over windows of w: ``|`` counts 1, ``:`` 0.5; 0 for shorter texts."""
    halves = F.transform(letters(spacer), lambda c: F.when(c == "|", 2).when(c == ":", 1).otherwise(0))
    return F.when(F.length(col(spacer)) >= w, F.array_max(sums(halves, w)) / (2 * w)).otherwise(0.0)


def hamming(a: str | Column, b: str | Column) -> Column:
    """Differing positions; null for different lengths."""
    x, y = col(a), col(b)
    pairs = F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: (p != q).cast("int"))
    return F.when(F.length(x) == F.length(y), F.aggregate(pairs, F.lit(0), lambda t, d: t + d))


def prefix_diff(a: str | Column, b: str | Column, n: int) -> Column:
    return hamming(F.substring(col(a), 1, n), F.substring(col(b), 1, n))


def suffix_diff(a: str | Column, b: str | Column, n: int) -> Column:
    return hamming(tail(a, n), tail(b, n))


# ------------------------------------------------------------ numbers


def round2(x: str | Column) -> Column:
    return F.round(col(x), 2)


def length_adjust(mean: str | Column) -> Column:
    return F.greatest(F.lit(1.0), 2.5 - 0.009 * col(mean))


def fraction_to_bips(fraction: str | Column) -> Column:
    return (F.round(col(fraction), 4) * 10000).cast("int")


# ------------------------------------------------------------ alignment text


def cigar_length(cigar: str | Column, ops: str = "MIDNSHP=X") -> Column:
    """Sum of the lengths of the given operations."""
    numbers = F.regexp_extract_all(col(cigar), F.lit(rf"(\d+)[{ops}]"), F.lit(1))
    return F.aggregate(numbers, F.lit(0), lambda a, n: a + n.cast("int"))


# ------------------------------------------------------------ identifiers


def normalise_id(header: str | Column) -> Column:
    """Accession of a header: gi|n|db|ACC.v|, UniRef50_X, DB:X.v or the first word."""
    h = F.regexp_replace(col(header), "^>", "")
    first = F.regexp_extract(h, r"^(\S*)", 1)
    return (
        F.when(first.rlike(r"^gi\|\d+\|[^|]*\|[^|]+"), F.regexp_extract(first, r"^gi\|\d+\|[^|]*\|([^|.]+)", 1))
        .when(first.rlike("^UniRef[0-9]+_"), F.regexp_extract(first, "^UniRef[0-9]+_(.*)$", 1))
        .when(first.rlike(r"^[A-Za-z]+:[^.]+"), F.regexp_extract(first, r"^[A-Za-z]+:([^.]+)", 1))
        .otherwise(first)
    )


def gi_number(header: str | Column) -> Column:
    return F.regexp_extract(col(header), r"gi\|(\d+)", 1)


def shorten_movie_name(name: str | Column) -> Column:
    """``ccs`` and what lies between the first and the last slash."""
    return F.concat(F.lit("ccs"), F.regexp_extract(col(name), "^[^/]*/(.*)/[^/]*$", 1))


def strip_key_prefix(key: str | Column) -> Column:
    return F.substring_index(col(key), "_", -1)


def mapping_name(species: str | Column, strain: str | Column) -> Column:
    """The species if it is a scientific name (two words, the first capitalised), else species and strain."""
    return F.when(col(species).rlike("^[A-Z][a-z]+ [a-z]+$"), col(species)).otherwise(F.concat_ws(" ", col(species), col(strain)))


def codon_start(start: str | Column, frame: str | Column) -> Column:
    """1-based offset cs for which (start + cs - 1) mod 3 is the frame."""
    return F.pmod(col(frame) - col(start), F.lit(3)) + 1


def attributes_to_string(attrs: str | Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(col(attrs))), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
