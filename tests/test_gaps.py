"""Gap correction, repeats under a bait, stems, merge decisions, second-round genotypes, trims of text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.operators import align, clusters, gaps, pileup, trims


@pytest.mark.parametrize(
    ("whole", "gapped", "at", "end", "want"),
    [
        ("GATTTCAAA", "GATT-CAAA", 4, 5, True),
        ("GATTTCAA", "GA-TTCAA", 2, 3, True),
        ("TCATAAAAAACGACT", "TCATAAAA--CGACT", 8, 10, True),
        ("TCATAAAAAAAACGACT", "TCAT--AAAAAACGACT", 4, 6, True),
        ("TCGTATTTTTTTCGGCATCA", "TCGTACTTTT---GGCATCA", 10, 13, False),
        ("ACGT", "-CGT", 0, 1, False),
    ],
)
def test_gaps_in_homopolymers(whole, gapped, at, end, want):
    assert gaps.in_homopolymer(whole, gapped, at, end) is want


@pytest.mark.parametrize(
    ("top", "bottom", "want"),
    [
        ("ACCC-TCCCCGG", "ACCCCTCCCCGG", "ACCCXTCCCCGG"),  # an insertion in a homopolymer is crossed out
        ("ACGA-TCCGG", "ACGACTCCGG", "ACGACTCCGG"),  # one elsewhere stays
        ("ACG---TCCGG", "ACGACTTCCGG", "ACGACTTCCGG"),  # three letters are a codon
        ("GATTTCAAACG", "GATT-CAAACG", "GATTtCAAACG"),  # a deletion in a homopolymer is filled
        ("GATTACAGACG", "GATT--AGACG", "GATTacAGACG"),  # one of two letters too
        ("GATTACAGTTTACG", "GATT----TTTACG", "GATT----TTTACG"),  # longer ones stay
        ("GATTACAACG", "GATT---ACG", "GATT---ACG"),
        ("AC-GTCACCGCA", "ACCGTCAC-GCA", "ACXGTCAC-GCA"),  # crossed out before the deletion sees it
        ("AGT-GTCACCGCA", "AGTCGTCAC-GCA", "AGTXGTCACcGCA"),  # a staggered pair to the left
        ("ACCAGTAC-CAGT", "ACC-GTACGCAGT", "ACCaGTACXCAGT"),  # and to the right
        ("ACCAGTACATC-CA", "ACC-GTACATCGCA", "ACCaGTACATCGCA"),  # too far apart: filled alone
    ],
)
def test_corrected_texts(top, bottom, want):
    assert gaps.correct_gaps(top, bottom) == (top, want)


def test_staggered_pairs():
    pairs = [("AC-GTACCGCA", "ACCGTAC-GCA", 7, 2), ("AC-GTCACCGCA", "ACCGTCAC-GCA", 8, 2), ("ACCAGTAC-CA", "ACC-GTACGCA", 3, 8), ("ACCAGTACATC-CA", "ACC-GTACATCGCA", 3, 11), ("ACCAGTAC", "ACC-GTAC", 3, None)]
    for top, bottom, at, want in pairs:
        assert gaps._partner(top, list(bottom), at) == want


def test_tails_and_edges():
    top = "ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGT"
    assert gaps.trim_tail(top, top, 1.0) == (top, top)
    bad = top[:32] + "CCAATTGG"
    assert gaps.trim_tail(top, bad, 0.95)[1] == bad[:32]
    row = {"top": "CCC", "bottom": "CCC", "ref_begin": 2, "read_begin": 2, "ref_end": 4, "read_end": 4}
    assert gaps.restore_edges(row, "AACCCGT", "TACCCGAAA") == {"top": "AACCCGT", "bottom": "TACCCGA", "ref_begin": 0, "read_begin": 0}


def test_second_round_and_mates(spark):
    ref = "ATGGCTTTTGACCATCTGAAACGTGGATCCTACGGCACTGAA"
    short = ref[:8] + ref[9:]  # a T of the run is missing
    refs = spark.createDataFrame([("a", ref), ("b", "CCGGTATCTTACCAAGTGACTCACGGAACGTTGATC")], "ref_id string, seq string")
    rows = [(f"r{k}", short if k % 2 else ref, [30] * (len(ref) - k % 2)) for k in range(6)]
    reads = spark.createDataFrame(rows, "read_id string, seq string, qual array<int>")
    mates = spark.createDataFrame([(n, "".join({"A": "T", "C": "G", "G": "C", "T": "A"}[c] for c in reversed(ref)), [20] * len(ref)) for n, _, _ in rows], "read_id string, seq string, qual array<int>")
    out = pileup.genotype(reads, refs, [1, 2])
    # codon 2 (TTT GAC ...) keeps its frame, the filled letter is in lower case
    assert {r["genotype"].upper() for r in out["genotypes"].collect()} == {"GCTTTT"}
    assert {(r["aa"], r["n"]) for r in out["genotypes_aa"].collect()} == {("AF", 6)}
    assert out["failed"].count() == 0 and out["consensus"].first()["ref_id"] == "a"
    both = pileup.genotype_paired(reads, mates, refs, [1, 2])
    assert [(r["pair"], r["n"]) for r in both["mates"].collect()] == [("+-", 6)]
    q = {r["pos"]: (r["mean"], r["n"]) for r in both["qualities"].collect()}
    assert q[1] == (25.0, 12) and len(q) == len(ref)


def test_repeats_under_a_bait(spark):
    left, right = "ACGTTGCAACGGCTAGCTCG", "CGGATCTTACGGTCAAGCAT"
    bait = left + "T" * 8 + right
    reads = [(f"n{k}", "GG" + left + "T" * k + right + "AC") for k in (6, 8, 9)] + [("v", left + "TTTATTTT" + right), ("rc", "".join({"A": "T", "C": "G", "G": "C", "T": "A"}[c] for c in reversed(left + "T" * 7 + right))), ("none", "ATATATATATATATATATAT")]
    d = spark.createDataFrame(reads, "read_id string, seq string")
    got = {r["read_id"]: (r["repeats"], r["variant"]) for r in gaps.repeat_in_bait(d, bait, 21, 8, "T").collect()}
    assert got == {"n6": (6, None), "n8": (8, None), "n9": (9, None), "v": (0, "TTTATTTT"), "rc": (7, None)}
    table = gaps.repeat_count_table(gaps.repeat_in_bait(d, bait, 21, 8, "T")).collect()
    assert {(r["repeats"], r["n"], r["mean"]) for r in table} == {(k, 1, 7.5) for k in (6, 7, 8, 9)}
    counted = {r["text"]: r["n"] for r in gaps.count_subsequence(d.filter("read_id in ('n8', 'v')"), bait, 19, 30).collect()}
    assert counted == {"CGTTTTTTTTCG": 1, "CGTTTATTTTCG": 1}


@pytest.mark.parametrize(
    ("top", "bottom", "want"),
    [
        ("ACGTACGTACGTACGTACGTACGT", "ACGTACGTACGTACGTACGTACGT", ("ACGTACGTACGTACGTACGTACGT", None)),
        ("ACGTACGTACGTACGTACGTACG", "ACGTACGTACGTACGTACGTACG", (None, None)),
        ("--ACGTACGTACGTACGTACGTACGT", "AAACGTACGTACGTACGTACGTACGT", ("ACGTACGTACGTACGTACGTACGT", None)),
        ("GGGTACGTACGTACGTACGTACGTCC", "--GTACGTACGTACGTACGTACGTCC", ("GTACGTACGTACGTACGTACGTCC", None)),
        ("ACGTACG-ACGTACGTACGTACGTC", "ACGTACGAACGTACGTACGTACGTC", ("ACGTACGACGTACGTACGTACGTC", None)),
        ("ACGTACGTACGTACGTACGTACG-", "ACGTACGTACGTACGTACGTACGT", ("ACGTACGTACGTACGTACGTACGT", None)),
        ("ACGTACGTACGTACGTACGTACGT", "ACGTACGTACGTACGTACGAACGT", ("ACGTACGTACGTACGTACGTACGT", "ACGTACGTACGTACGTACGAACGT")),
    ],
)
def test_stem_consensus(top, bottom, want):
    assert gaps.stem_consensus(top, bottom) == want


ARM = "GATTACAGATTACAGGCATCACTC"


@pytest.mark.parametrize(
    ("top", "bottom", "more", "want"),
    [
        (ARM, ARM, {}, (ARM, None)),
        (ARM, ARM[:-3] + "CCC", {}, (ARM, None)),
        (ARM[:-3] + "CCC", ARM, {}, (ARM, None)),
        (ARM[:-3] + "CCC", ARM[:-3] + "CCC", {}, (ARM[:-3] + "CCC", None)),
        (ARM, ARM[:-3] + "GGC", {"noterm_identity": 0.81}, (None, None)),
        (ARM[1:], ARM[1:], {"arms": (ARM, ARM[1:]), "begins": (1, 0)}, (ARM, None)),
        (ARM[1:], ARM[1:], {"arms": (ARM[1:], ARM), "begins": (0, 1)}, (ARM, None)),
        (ARM[1:], ARM[1:], {"arms": (ARM[1:], ARM[1:])}, (None, None)),
        ("GATTACA-GATCACAGGCATCACTC", "GATTACATGA-CACAGGCATCACTC", {"arms": ("GATTACAGATCACAGGCATCACTC", "")}, ("GATTACAGATCACAGGCATCACTC", None)),
        ("GATTACA-GATCACAGGCATCACTC", "GATTACATGA-CACAGGCATCACTC", {}, (None, None)),
    ],
)
def test_stem_ends(top, bottom, more, want):
    assert gaps.stem_candidates(top, bottom, **more) == want


def test_stem_classes(spark):
    """Each way that a read can count or not, and null, empty and short reads."""
    left, right = "TTGGACCATGTTCCGAATACGCATGGACTTACCGGTACAA", "GGATCCTTCAGGTTAGCCATAAGTCTTGACCGATTGCATG"
    g = ARM[:21]
    c = "".join({"A": "T", "C": "G", "G": "C", "T": "A"}[x] for x in reversed(g))
    planted = {
        "both": (left + g + "CTCGAG" + c + right, "counted"), "no loop": (left + g + "CTCGGG" + c + right, "counted"), "short lower arm": (left + g + "CTCGAG" + c[:20] + right, "counted"),
        "heads of As": (left + g + "CTCGAG" + c + "TT" + right, "counted"), "dimer": (left + right, "flanks meet"), "short": (left + g[:10] + right, "insert too short"),
        "no arm": (left + g + "CTCGAG" + "T" * 21 + right, "poor stem"), "left": (left + g + "CTCGAG" + c, "counted"), "left alone": (left + g + "CTC", "counted"), "left short": (left + g[:20], "insert too short"),
        "right": (g + "CTCGAG" + c + right, "counted"), "right short": (c + right, "insert too short"), "junk": ("ACGT" * 20, "no flank"),
    }
    rows = [(k, v[0]) for k, v in planted.items()] + [("null", None), ("empty", ""), ("flank", left)]
    reads = spark.createDataFrame(rows, "read_id string, seq string")
    lib = spark.createDataFrame([(g, "one")], "sequence string, library_id string")
    report = clusters.library_report(reads, lib, left, right)
    calls = {r["read_id"]: r for r in report["calls"].collect()}
    assert {k: r["decision"] for k, r in calls.items()} == {k: v[1] for k, v in planted.items()}
    assert {r["c1"] for r in calls.values() if r["decision"] == "counted"} == {ARM} and not [r for r in calls.values() if r["c2"]]
    n = sum(v[1] == "counted" for v in planted.values())
    assert [tuple(r) for r in report["corrected"].collect()] == [(g, True, n)]
    assert [tuple(r) for r in clusters.count_library(reads, lib, left, right).collect()] == [(g, True, n)]
    assert report["double_hits"].count() == 0 and report["summary"].first()["hits"] == n
    empty = clusters.library_report(reads.limit(0), lib, left, right)
    assert empty["decisions"].count() == 0 and empty["summary"].first()["not_hit"] == 1


def test_stems_of_inserts(spark):
    arm = "GATTACAGATTACAGGCATCCATG"
    d = spark.createDataFrame([("x", arm + "CTCGAG" + "".join({"A": "T", "C": "G", "G": "C", "T": "A"}[c] for c in reversed(arm)))], "read_id string, insert string")
    r = gaps.stems(clusters.split_stem(d)).first()
    assert (r["first"], r["second"], r["stem_length"], r["stem_identity"]) == (arm, None, 24, 1.0)


def test_merge_decisions(spark):
    import random

    rng = random.Random(3)
    make = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    ref, extra = make(900), make(700)
    worse = list(ref[450:])
    for k in range(0, 450, 12):
        worse[k] = {"A": "C", "C": "G", "G": "T", "T": "A"}[worse[k]]
    reads = spark.createDataFrame([("same", ref), ("long", extra + ref), ("chimera", ref[:450] + "".join(worse)), ("other", make(900))], "read_id string, seq string")
    refs = spark.createDataFrame([("c", ref)], "ref_id string, seq string")
    a = align.align_join(reads, refs, both_strands=False, scores=align.SCORES["consensus"], top=True)
    got = sorted((r["read_id"], r["kind"], len(r["seq"])) for r in gaps.merge_decision(a, reads, identity=0.98, length=200).collect())
    assert ("same", "merged", 900) in got and ("long", "merged", 1600) in got and ("long", "scrap", 700) in got
    assert not [g for g in got if g[0] == "other"]
    loose = {(r["read_id"], r["kind"]) for r in gaps.merge_decision(a.filter("read_id = 'chimera'").withColumn("cov_ref", F.lit(0.75)).withColumn("cov_read", F.lit(0.75)), reads, identity=0.9, length=200).collect()}
    assert loose == {("chimera", "merged"), ("chimera", "scrap")}


def test_clean_est(spark):
    body = "ACGATCGTACTGACTGCATGCATCGATGCTAGCTAGCATCGATCAGCTACG"
    rows = [("tail", body + "A" * 40), ("head", "T" * 40 + body), ("lower", body.lower()), ("short", body[:20]), ("simple", "A" * 60), ("null", None), ("empty", ""), ("plain", body), ("plain", body)]
    report = trims.clean_est_report(spark.createDataFrame(rows, "seq_id string, seq string"), longest=50)
    got = sorted((r["seq_id"], r["seq"]) for r in report["clean"].collect())
    assert [g[0] for g in got] == ["head", "lower", "plain", "plain", "tail"]
    assert all(g[1] == body for g in got if g[0] in ("lower", "plain")) and all(len(g[1]) < 62 for g in got)
    assert {r["length"]: r["n"] for r in report["raw_lengths"].collect()} == {91: 2, 51: 3, 20: 1, 60: 1, 0: 1, None: 1}
    assert report["long"].count() == report["long_lengths"].agg({"n": "sum"}).first()[0] >= 3
    assert trims.clean_est(spark.createDataFrame([], "seq_id string, seq string")).count() == 0


def test_text_trims():
    assert trims.trim_simple_text("CT" + "T" * 12 + "GACC") == "GACC"
    assert trims.trim_simple_text("GACCATGXXGA") == "GACCATG"
    assert trims.trim_simple_text("G" * 3 + "CATGCAGCATCC" + "XX" + "CATG" + "X" + "CATGC") == "GGGCATGCAGCATCC"
    body = "ACGATCGTACTGACTGCATGCATCGATGCTAGCTAGCATCGATCAGCTACG"
    assert trims.complexity_trim_text(body, 20) == (body, 0)
    cut, code = trims.complexity_trim_text(body + "A" * 40, 20)
    assert code == 2 and cut.startswith(body[:40]) and len(cut) < 60
    cut, code = trims.complexity_trim_text("T" * 40 + body, 20)
    assert code == 3 and body.endswith(cut[-30:]) and len(cut) < 60
    assert trims.complexity_trim_text("A" * 60, 20)[1] == 1 and trims.complexity_trim_text("ACG", 20) == ("ACG", -1)
    assert trims.short_read_poly_a_text(body + "A" * 12 + "CG") == body
    after = "CGTCCGTCTGCTCGTGCTCTGCTG"
    assert trims.short_read_poly_a_text(body + "A" * 20 + after + "A" * 30 + "C" * 30) == body
    assert trims.short_read_poly_a_text(body + "A" * 20 + after + "A" * 30 + "CG") == body
    early = body[:20] + "G" + "A" * 20 + after * 6
    assert trims.short_read_poly_a_text(early) == early and trims.short_read_peaks(early)[0][4] == 21
    # the last peak goes, the one before it can't: more stands after it than before
    assert trims.short_read_poly_a_text(early + "A" * 20) == early
    assert trims.short_read_peaks("A" * 30) == [] == trims.short_read_peaks("") and trims.short_read_poly_a_text("") == ""
    assert trims.short_read_peaks("N" * 3 + "C" * 20 + "AAAAAAA" + "C" * 20) == []
    assert trims.cut_tail_after_peak_text(body + "A" * 30 + "CGTCA") == body + "A" * 30


def test_n_rules(spark):
    body = "ACGATCGTACTGACTGCATGCATCGATGCTAGC"
    texts = ["NN" + body + "N", "ACGN" + body, body + "NNACG", body + "N" + body, "ACG", "N" * 40, "CATNN" + body + "NACGT"]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, seq string")
    halves = [r["v"] for r in d.select("k", S.trim_n_halves("seq").alias("v")).orderBy("k").collect()]
    assert halves == [body, body, body, body, None, None, body]
    near = [r["v"] for r in d.select("k", S.trim_n_by_distance("seq").alias("v")).orderBy("k").collect()]
    assert near[1] == body and near[0] == body and near[2] == body and near[4] == "ACG" and near[5] == ""
    tail = "ACGT" * 120 + "A" * 20 + "N" + "A" * 20 + "CGTACGTC" * 60
    assert spark.createDataFrame([(tail,)], "seq string").select(S.expose_poly_tail("seq")).first()[0] == tail[: 480 + 41]


def loop_trim_n(s):
    """Rule after rule on the text, until none applies."""
    while any((t := re.sub(rule, "", s, count=1)) != s and [s := t] for rule in ("^[ACGT]{0,10}N", "^[ACGT]{0,30}NN", "^[ACGT]{0,90}NNN")):
        pass
    while any((t := re.sub(rule, "", s, count=1)) != s and [s := t] for rule in ("N[ACGTN]{0,10}$", "NN[ACGTN]{0,30}$", "NNN[ACGTN]{0,90}$", "NNNN[ACGTN]{0,270}$", "NNNNN[ACGTN]*$")):
        pass
    return s


def test_n_by_distance_goes_on_to_the_end(spark):
    rng = random.Random(3)
    body = "".join(rng.choices("ACGT", k=120))
    texts = [body + "".join("N" + "".join(rng.choices("ACGT", k=10)) for _ in range(20)), body, "N" * 50, "", "NNNNN" + body]
    for _ in range(150):
        texts.append("".join("N" * rng.choice([1, 1, 1, 2, 3, 4, 6]) + "".join(rng.choices("ACGT", k=rng.choice([0, 3, 9, 11, 12, 29, 33, 80, 95, 260, 290]))) for _ in range(rng.randrange(1, 9))))
        texts.append("".join(rng.choices("ACGT", k=rng.choice([5, 15, 40, 100]))) + texts[-1])
    got = [r["v"] for r in spark.createDataFrame(list(enumerate(texts)), "k int, seq string").select("k", S.trim_n_by_distance("seq").alias("v")).orderBy("k").collect()]
    assert got == [loop_trim_n(t) for t in texts] and got[0] == body


def test_what_is_left_of_a_gap_is_looked_at_anew():
    # four letters are missing before TTT, beside an insertion: one repeat letter is filled at most, a codon's gap stays
    top, bottom = "ACGGA-CATCGACGTTTGCATG", "ACGGAGCATC----TTTGCATG"
    fixed = gaps.correct_gaps(top, bottom)[1]
    assert fixed[5] == "G" and fixed[11:14] == "---"
    # of an insertion of two only the letter that repeats its neighbour is spurious
    assert gaps.correct_gaps("ACGT--AACGT", "ACGTGAAACGT")[1] == "ACGTGXAACGT"
    assert gaps.correct_gaps("ACGT----CGT", "ACGTGACTCGT")[1] == "ACGTGACTCGT"
