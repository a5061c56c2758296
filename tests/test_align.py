"""The batch aligner against a slow one, and pileups of hand-worked alignments."""

import hashlib
import random

import pytest

from seqframe.operators import align, pileup


def slow_score(a, b, mode, scores):
    match, mismatch, go, ge = scores
    low = -(10**9)
    local = mode == "local"
    h = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    e = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    f = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    h[0][0] = 0
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i:
                e[i][j] = max(h[i - 1][j] + go, e[i - 1][j] + ge)
            if j:
                f[i][j] = max(h[i][j - 1] + go, f[i][j - 1] + ge)
            if i and j:
                h[i][j] = max(h[i - 1][j - 1] + (match if a[i - 1] == b[j - 1] else mismatch), e[i][j], f[i][j])
            elif i or j:
                h[i][j] = 0 if local else max(e[i][j], f[i][j])
            if local:
                h[i][j] = max(h[i][j], 0)
    return max(max(r) for r in h) if local else h[len(a)][len(b)]


@pytest.mark.parametrize("mode", ["local", "global"])
@pytest.mark.parametrize("name", ["reads", "stem", "global"])
def test_scores_equal_slow_aligner(mode, name):
    rng = random.Random(7)
    scores = align.SCORES[name]
    pairs = []
    for _ in range(60):
        a = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 20)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            if b and rng.random() < 0.5:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randint(0, len(b)), rng.choice("ACGT"))
        pairs.append((a, "".join(b)))
    made = align.align_batch([a for a, _ in pairs], [b for _, b in pairs], mode, scores)
    for (a, b), got in zip(pairs, made, strict=True):
        assert got["score"] == slow_score(a, b, mode, scores), (a, b)
        assert got["top"].replace("-", "") == a[got["ref_begin"] : got["ref_end"] + 1]
        assert got["bottom"].replace("-", "") == b[got["read_begin"] : got["read_end"] + 1]
        again = 0
        for side in ("top", "bottom"):
            again += sum(scores[2] + scores[3] * (len(g) - 1) for g in __import__("re").findall("-+", got[side]))
        again += sum(0 if "-" in (x, y) else scores[0] if x == y else scores[1] for x, y in zip(got["top"], got["bottom"], strict=True))
        assert again == got["score"]


def test_seeded_top_hits_equal_all_pairs(spark):
    rng = random.Random(1)
    refs = [(f"p{k}", "".join(rng.choice("ACGT") for _ in range(64))) for k in range(6)]
    reads = [(f"r{k}", refs[k % 6][1][k % 10 : 40 + k % 10]) for k in range(24)]
    r, f = spark.createDataFrame(reads, "read_id string, seq string"), spark.createDataFrame(refs, "ref_id string, seq string")
    want = {x["read_id"]: (x["ref_id"], x["strand"], x["score"]) for x in align.align_join(r, f, seed=False, top=True).collect()}
    got = {x["read_id"]: (x["ref_id"], x["strand"], x["score"]) for x in align.align_join(r, f, top=True).collect()}
    assert got == want and all(want[f"r{k}"][0] == f"p{k % 6}" for k in range(24))


def test_short_reads_with_errors_lose_no_pair(spark):
    rng = random.Random(5)
    refs = [(f"p{k}", "".join(rng.choice("ACGT") for _ in range(64))) for k in range(6)]
    reads = []
    for k in range(120):
        at, n = rng.randrange(25), rng.choice([15, 18, 24, 24, 39])
        x = list(refs[k % 6][1][at : at + n])
        for i in {n // 2, n // 5} if k % 3 else {11}:
            x[i] = {"A": "C", "C": "a", "G": "T", "T": "N"}[x[i]] if k % 4 else rng.choice(["", x[i] + "G"])
        reads.append((f"r{k}", "".join(x)))
    r, f = spark.createDataFrame(reads, "read_id string, seq string"), spark.createDataFrame(refs, "ref_id string, seq string")
    for identity, length in [(0.85, 15), (0.95, 20)]:
        for top in (False, True):
            found = [{(x["read_id"], x["score"], *(() if top else (x["ref_id"], x["strand"]))) for x in align.align_join(r, f, identity=identity, length=length, top=top, seed=seed).collect()} for seed in (False, True)]
            assert found[0] == found[1] and len(found[0]) > 20
    assert align.lossless_seed(0.85, 15) == 5 and align.lossless_seed(0.95, 20) == 10 and align.lossless_seed(1.0, 20) == 20 and align.lossless_seed(0.0, 0) == 0


def test_pileup_and_consensus(spark):
    rows = [("a", "x", 0, "ACG-T", "ACGGT"), ("b", "x", 0, "ACGT", "AC-T"), ("c", "x", 1, "CGT", "CTT"), ("d", "x", 0, "ACG-T", "ACGGT")]
    aln = spark.createDataFrame(rows, "read_id string, ref_id string, ref_begin int, top string, bottom string")
    columns = pileup.alignment_columns(aln)
    counts = {(r["pos"], r["base"]): r["n"] for r in pileup.pileup(columns).collect()}
    assert counts == {(1, "A"): 3, (2, "C"): 4, (3, "G"): 2, (3, "-"): 1, (3, "T"): 1, (4, "T"): 4}
    assert [(r["pos"], r["ins"], r["n"]) for r in pileup.inserts(columns).collect()] == [(3, "G", 2)]
    lengths = spark.createDataFrame([("x", 5)], "ref_id string, length int")
    assert pileup.consensus_simple(pileup.pileup(columns), lengths).first()["consensus"] == "ACGT-"
    assert pileup.consensus_weighted(columns, insert_share=0.4).first()["consensus"] == "ACGGT"
    genotypes = {r["genotype"]: (r["n"], r["aa"]) for r in pileup.linked_genotype(columns, [0]).collect()}
    assert genotypes == {"ACG": (2, "T"), "AC-": (1, "X")}


def test_fish_and_flanks(spark):
    bait = "ACGTTGCAACGGTTAACCGG"
    reads = spark.createDataFrame([("f", "TTTT" + bait + "GGGG"), ("b", "CCGGTTAACCGTTGCAACGT"), ("d", "TT" + bait[:9] + "T" + bait[10:] + "CC"), ("n", "ATATATATATATATATATATATAT")], "read_id string, seq string")
    got = {r["read_id"]: (r["direction"], r["kind"]) for r in align.fish(reads, bait).collect()}
    assert got == {"f": ("forward", "perfect"), "b": ("backward", "perfect"), "d": ("forward", "defect"), "n": ("none", "none")}
    flanks = align.locate_flanks(reads.filter("read_id = 'f'"), "ACGTTGCAAC", "GGTTAACCGG").first()
    assert flanks["left_ok"] and flanks["right_ok"] and flanks["insert_len"] == 0


def pairs_of(seed, n, size):
    rng = random.Random(seed)
    made = lambda: "".join(rng.choices("ACGTNacg", k=rng.randrange(size)))
    tops = [made() for _ in range(n)]
    return tops, [rng.choice([t[4:], t[:6] + t[9:], t + t[:3], made()]) for t in tops]


@pytest.mark.parametrize("mode", ["local", "global"])
def test_long_pairs_align_like_short_ones(monkeypatch, mode):
    tops, bottoms = pairs_of(3, 60, 90)
    for scores in align.SCORES.values():
        whole = align.align_batch(tops, bottoms, mode, scores)
        monkeypatch.setattr(align, "CELLS", 0)  # rows at intervals, moves made again
        assert [align.align_batch([t], [b], mode, scores)[0] for t, b in zip(tops, bottoms, strict=True)] == whole
        monkeypatch.setattr(align, "CELLS", 24_000_000)


def test_long_pairs_take_little_memory(monkeypatch):
    import tracemalloc

    rng = random.Random(4)
    a = "".join(rng.choices("ACGT", k=6000))
    b = a[:1500] + a[1540:4000] + "GATTACA" + a[4000:]
    monkeypatch.setattr(align, "CELLS", 1_000_000)
    tracemalloc.start()
    got = align.align_batch([a], [b], "global")[0]
    assert tracemalloc.get_traced_memory()[1] < 30_000_000  # all moves would be 36 MB, of 100,000 letters 10 GB
    tracemalloc.stop()
    assert (got["gaplen_read"], got["gaplen_ref"], got["identical"]) == (40, 7, 5960)


def slow_matrix_score(a, b, score, go, ge):
    h = {(0, 0): 0}
    e, f, low = {}, {}, -(10**9)
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            e[i, j] = max(h[i - 1, j] + go, e[i - 1, j] + ge) if i else low
            f[i, j] = max(h[i, j - 1] + go, f[i, j - 1] + ge) if j else low
            if i or j:
                h[i, j] = max(e[i, j], f[i, j], h[i - 1, j - 1] + score(a[i - 1], b[j - 1]) if i and j else low)
    return h[len(a), len(b)]


TEXT = """# letters and their scores
   A  R  W  *
A  4 -1 -3 -4
R -1  5 -3 -4
W -3 -3 11 -4
* -4 -4 -4  1
"""


def test_protein_matrix():
    rng = random.Random(5)
    read = align.read_matrix(TEXT, -6, -2)
    known = {("A", "A"): 4, ("A", "R"): -1, ("A", "W"): -3, ("R", "R"): 5, ("R", "W"): -3, ("W", "W"): 11}
    score = lambda x, y: known.get((x, y), known.get((y, x), -4))
    tops = ["".join(rng.choices("ARWK", k=rng.randrange(1, 14))) for _ in range(60)]
    bottoms = ["".join(rng.choices("ARW", k=rng.randrange(1, 14))) for _ in tops]
    for a, b, got in zip(tops, bottoms, align.align_batch(tops, bottoms, "global", read), strict=True):
        assert got["score"] == slow_matrix_score(a, b, score, -6, -2)
    groups = align.group_matrix()
    assert [groups.table[ord(x), ord(y)] for x, y in ("II", "IV", "IW", "XA", "AX")] == [5, 1, -3, 0, 0]
    for bad in ("", "A R\nA 1", "# only"):
        with pytest.raises(ValueError):
            align.read_matrix(bad)
    with pytest.raises(ValueError):
        align.align_batch(["A"], ["A"], "local", (5, -4, -1, -3))


def test_sites_are_mapped_with_a_matrix(spark):
    # like residues hold the alignment together where plain matches would not
    sites = spark.createDataFrame([("p", "r", "S", 6)], "protein_id string, refs string, residue string, position int")
    proteins = spark.createDataFrame([("p", "MKLIVSTGDE")], "protein_id string, seq string")
    references = spark.createDataFrame([("r", "MRIVLSAGEE")], "ref_id string, seq string")
    row = align.map_site(sites, proteins, references, align.group_matrix()).first()
    assert (row["found"], row["valid"]) == ("S", True)


def test_no_alignment_has_fewer_common_kmers():
    rng = random.Random(11)
    for identity, length in ((0.95, 60), (0.9, 40), (0.8, 25)):
        k = align.lossless_seed(identity, length)
        least = align.shared_kmers(identity, length, k)
        for _ in range(300):
            n = rng.randrange(length, length + 30)
            a = "".join(rng.choices("AC" if rng.random() < 0.5 else "ACGT", k=n))
            b, wrong = list(a), next(e for e in range(n, -1, -1) if (n - e) / n >= identity)
            for at in rng.sample(range(n), wrong):  # spread evenly or not
                b[at] = rng.choice(["N", ""])
            b = "".join(b)
            grams = {a[i : i + k] for i in range(n - k + 1)}
            assert sum(b[i : i + k] in grams for i in range(len(b) - k + 1)) >= least


def test_columns_of_alignments_by_hand(spark):
    rows = [("r1", "a", 2, 1, "--AC-GT--A", "GGAcTG-XTA", [1, 2, 3, 4, 5, 6, 7, 8, 9]), ("r2", "a", 0, 0, "ACG", "A-G", [30, 40]), ("r3", "b", 0, 0, "", "", []), ("r4", "b", 0, 0, "A", "T", None)]
    aln = spark.createDataFrame(rows, "read_id string, ref_id string, ref_begin int, read_begin int, top string, bottom string, qual array<int>")
    got = [tuple(r) for r in pileup.alignment_columns(aln, quality="qual").orderBy("read_id", "pos").select("read_id", "ref_id", "pos", "base", "ins", "q").collect()]
    assert got == [
        ("r1", "a", 3, "A", "", 4), ("r1", "a", 4, "c", "T", 5), ("r1", "a", 5, "G", "", 6), ("r1", "a", 6, "-", "T", 5), ("r1", "a", 7, "A", "", 9),
        ("r2", "a", 1, "A", "", 30), ("r2", "a", 2, "-", "", 32), ("r2", "a", 3, "G", "", 40), ("r4", "b", 1, "T", "", None),
    ]


def test_segments_join_to_the_whole(spark):
    rng = random.Random(9)
    refs = {"a": 1, "b": 10, "c": 37}
    cells = [(ref, p, rng.choice("ACGT-"), rng.randrange(1, 9)) for ref, n in refs.items() for p in range(1, n + 1) if rng.random() < 0.8 for _ in range(2)]
    counts = spark.createDataFrame(cells, "ref_id string, pos int, base string, n long").groupBy("ref_id", "pos", "base").sum("n").withColumnRenamed("sum(n)", "n")
    lengths = spark.createDataFrame(list(refs.items()), "ref_id string, length int")
    whole = {r["ref_id"]: r["consensus"] for r in pileup.consensus_simple(counts, lengths).collect()}
    parts = pileup.consensus_simple_segments(counts, lengths, size=5).collect()
    assert {len(r["text"]) for r in parts} <= {1, 2, 5} and all(len(whole[k]) == n for k, n in refs.items())
    assert {k: "".join(r["text"] for r in sorted(parts, key=lambda r: r["segment"]) if r["ref_id"] == k) for k in refs} == whole


def test_strands_collapse_as_in_a_loop(spark):
    from seqframe.operators import dedupe

    rng = random.Random(10)
    turn = str.maketrans("ACGT", "TGCA")
    kinds = ["".join(rng.choices("ACGT", k=rng.randrange(20, 30))) for _ in range(12)] + ["ACGT" * 5]
    rows = []
    for k in range(400):
        s = kinds[min(rng.randrange(30), 12)]
        s = s if rng.random() < 0.5 else s.translate(turn)[::-1]
        rows.append((s, [rng.randrange(41) for _ in s], k))
    rows += [("ACG", [1, 2, 3], 500)]
    want = {}
    for s, q, k in rows:
        if len(s) >= 20:
            key = min(s, s.translate(turn)[::-1])
            w = want.setdefault(key, [s, 0, [0] * len(s)])
            w[1] += 1
            w[2] = [a + b for a, b in zip(w[2], q if s == key else q[::-1], strict=True)]
    want = {w[0]: (w[1], [-(-x // w[1]) for x in (w[2] if w[0] == key else w[2][::-1])]) for key, w in want.items()}
    df = spark.createDataFrame(rows, "seq string, qual array<int>, ord int").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # keys go over the borders of batches
    try:
        got = {r["seq"]: (r["n"], r["qual"]) for r in dedupe.collapse_strands(df).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got == want
    assert dedupe.collapse_strands(df.limit(0)).collect() == []


def test_disjoint_ranges_equal_a_loop():
    from seqframe.operators.hits import Disjoint

    rng = random.Random(12)
    for _ in range(200):
        index, kept = Disjoint(), []
        for _ in range(40):
            a = rng.randrange(60)
            b = a + rng.randrange(-2, 9)
            want = any(min(b, y) >= max(a, x) for x, y in kept if x <= y and a <= b)
            assert index.meets(a, b) == want
            if not want:
                index.add(a, b)
                kept.append((a, b))


@pytest.mark.parametrize("mode", ["local", "global"])
def test_pairs_at_once_align_like_one_by_one(monkeypatch, mode):
    tops, bottoms = pairs_of(8, 200, 50)
    tops, bottoms = [*tops, "", "ACGT", "AC-GT"], [*bottoms, "ACGT", "", "ACGGT"]
    for scores in [*align.SCORES.values(), align.group_matrix()]:
        rows = align._program(tops, bottoms, mode, scores)  # every path is walked alone
        assert align.align_batch(tops, bottoms, mode, scores) == rows


def test_pairs_without_gaps_need_no_full_program(monkeypatch):
    rng = random.Random(6)
    refs = ["".join(rng.choices("ACGT", k=64)) for _ in range(300)]
    reads = [r[k % 9 : k % 9 + 30] for k, r in enumerate(refs)]
    reads = [r[: k % 30] + "N" + r[k % 30 + 1 :] for k, r in enumerate(reads)]
    want = align._program(refs, reads, "local", align.SCORES["reads"])
    monkeypatch.setattr(align, "_program", None)
    assert align.align_batch(refs, reads) == want


def test_blocks_lose_no_read_and_meet_few_others(spark, monkeypatch):
    rng = random.Random(13)
    letters = lambda n: "".join(rng.choices("ACGT", k=n))
    refs = [(f"p{k}", letters(64)) for k in range(40)]
    reads = []
    for k in range(160):
        n, x = rng.choice([20, 24, 25, 32, 60]), refs[k % 40][1]
        at = rng.randrange(64 - n)
        x = list(x[at : at + n])
        for i in rng.sample(range(n), k % 4):
            x[i] = rng.choice(["N", "", x[i] + "A", "u", "A"])
        reads.append((f"r{k}", "".join(x) if k % 3 else "".join(x).translate(str.maketrans("ACGT", "TGCA"))[::-1]))
    r, f = spark.createDataFrame(reads, "read_id string, seq string"), spark.createDataFrame(refs, "ref_id string, seq string")
    whole, quick = [{x["read_id"]: x["score"] for x in align.align_join(r, f, identity=0.85, length=15, top=True, seed=s).collect()} for s in (False, True)]
    assert quick == whole and len(whole) > 120
    # reads as planted, with one misread letter: a thousand references give hardly a pair too many, and no shorter seed is tried
    refs = [(f"p{k}", letters(64)) for k in range(1000)]
    reads = [(f"r{k}", s[: k % 24] + "N" + s[k % 24 + 1 : 24 + k % 41]) for k, (_, s) in enumerate(refs)]
    r, f = spark.createDataFrame(reads, "read_id string, seq string"), spark.createDataFrame(refs, "ref_id string, seq string")
    assert align.block_pairs(r, f).count() < 1010
    monkeypatch.setattr(align, "seed_pairs", None)
    assert {(x["read_id"][1:], x["ref_id"][1:]) for x in align.align_join(r, f, identity=0.85, length=15, top=True).select("read_id", "ref_id").collect()} == {(str(k), str(k)) for k in range(1000)}


def test_a_turned_assembly_keeps_its_strand(spark):
    from seqframe.operators import assembly

    # part 102364 of 6 times sf0.1: once turned, its reference is like its own reverse complement by 0.82
    digits = "".join(hashlib.md5(t.encode()).hexdigest() for t in ("102364", "x102364"))
    ref = digits.translate(str.maketrans("0123456789abcdef", "ACGTACGTACGTACGT"))
    turned = ref[20:] + ref[:20]
    ring = turned[::-1].translate(str.maketrans("ACGT", "TGCA"))
    results = spark.createDataFrame([("a", ring, False)], "input string, seq string, cut boolean")
    got = assembly.assembly_qc(results, spark.createDataFrame([("a", ref)], "input string, ref_seq string")).first()
    assert (got["strand"], got["identity"], got["rotated"]) == ("-", 1.0, 20)


def test_better_strand_equals_both_strands(spark, monkeypatch):
    from pyspark.sql import functions as F

    from seqframe.functions import sequence as S

    rng = random.Random(8)
    letters = lambda n, of="ACGT": "".join(rng.choice(of) for _ in range(n))
    rows = [("", ""), ("ACGT", ""), ("ACGT", "ACGT"), ("ACGU", "acgu"), ("AAé", "éT")]
    for k in range(120):
        top = letters(rng.randint(8, 60), "ACGTN" if k % 7 == 0 else "ACGT")
        read = top[: rng.randint(4, 60)]
        read = read[: len(read) // 2] + letters(rng.randint(0, 2)) + read[len(read) // 2 + k % 2 :]
        rows.append((top, read if k % 3 else read[::-1].translate(str.maketrans("ACGT", "TGCA"))))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, ref_seq string, read_seq string")
    both = df.withColumn("strand", F.explode(F.array(F.lit("+"), F.lit("-")))).withColumn("read_seq", F.when(F.col("strand") == "-", S.revcomp("read_seq")).otherwise(F.col("read_seq")))
    scores = align.SCORES["consensus"]
    best = {}
    for r in align.align_pairs(both, "local", scores).collect():
        if r["i"] not in best or (r["score"], r["strand"] == "+") > (best[r["i"]]["score"], best[r["i"]]["strand"] == "+"):
            best[r["i"]] = r
    made = {r["i"]: r for r in align.align_pairs(df, "local", scores, better_strand=True).collect()}
    names = [c for c in both.columns + align.RESULT.replace(",", "").split()[::2] if c != "read_seq"]
    assert {i: [r[c] for c in names] for i, r in made.items()} == {i: [r[c] for c in names] for i, r in best.items()}
    # reads that differ in two places need no gap, and no strand of them needs the full program
    seen = []
    program = align._program
    monkeypatch.setattr(align, "_program", lambda t, *a: seen.append(len(t)) or program(t, *a))
    top = letters(50)
    read = top[:10] + ("A" if top[10] != "A" else "C") + top[11:30] + ("A" if top[30] != "A" else "C") + top[31:]
    turned, made = align.align_strands([top, top], [read, read[::-1].translate(str.maketrans("ACGT", "TGCA"))], scores)
    assert turned.tolist() == [False, True] and list(made["bottom"]) == [read, read] and not seen


@pytest.mark.parametrize("name", ["reads", "consensus", "sites", "bait", "stem", "subsequence"])
def test_scores_without_moves_equal_the_full_program(name):
    rng = random.Random(9)
    tops = ["".join(rng.choice("ACGTacN") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    bottoms = [t[3:12] + t[14:] if k % 2 else "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 60))) for k, t in enumerate(tops)]
    scores = align.SCORES[name]
    full = align._program(tops, bottoms, "local", scores)
    got = align._reached(align._bytes(tops), align._bytes(bottoms), scores)
    assert got[0].tolist() == [r["score"] for r in full]
    assert [(i - 1, j - 1) for i, j in zip(got[1].tolist(), got[2].tolist())] == [(r["ref_end"], r["read_end"]) for r in full]
    made = align.align_table(tops, bottoms, "local", scores)
    assert all(list(made[c]) == [r[c] for r in full] for c in made)


def test_a_consensus_walks_its_alignments_once(spark):
    df = spark.createDataFrame([(f"r{k % 3}", f"s{k}", 0, "ACGT--ACGT", "ACGTGGACGT") for k in range(40)], "ref_id string, read_id string, ref_begin int, top string, bottom string")
    made = pileup.consensus_weighted(pileup.alignment_columns(df))
    assert {(r["ref_id"], r["consensus"]) for r in made.collect()} == {(f"r{k}", "ACGTGGACGT") for k in range(3)}
    plan = made._jdf.queryExecution().executedPlan().toString()
    final = plan.partition("== Initial Plan ==")[0]
    assert final.count("MapInArrow") == 1


def test_pairs_that_cannot_pass_are_left_out_by_their_scores(monkeypatch):
    rng = random.Random(10)
    site = "ACGTTGCAACGGCTAGCTCG"
    reads = ["".join(rng.choice("ACGT") for _ in range(70)) for _ in range(300)]
    for k in range(0, 300, 3):
        s = list(site)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(s))
            s[at : at + 1] = rng.choice(["", "A", "CG", "T"])
        reads[k] = reads[k][:20] + "".join(s) + reads[k][40:]
    scores = align.SCORES["sites"]
    for identity, length in ((0.84, 17), (0.9, 12), (0.95, 20), (1.0, 8)):
        least = align._passing_score(identity, length, scores)
        assert least > 0
        kept = set(align._enough([site] * 300, reads, scores, least).tolist())
        made = align.align_batch([site] * 300, reads, "local", scores)
        good = {k for k, r in enumerate(made) if r["identity"] >= identity and r["alnlen"] >= length}
        assert good <= kept and len(kept) < 200
    assert align._passing_score(0.3, 20, scores) == 0


def test_a_window_has_one_key_for_both_strands(spark):
    rng = random.Random(29)
    letters = lambda n: "".join(rng.choices("ACGT", k=n))
    back = lambda s: s.translate(str.maketrans("ACGTacgtRYuU", "TGCAtgcaYRAA"))[::-1]
    refs = [(f"p{k}", letters(40 + k)) for k in range(20)] + [("pal", letters(12) + "ACGTACGGCCGTACGT" + letters(12)), ("long", letters(300)), ("odd", "é" + letters(30) + "ß" + letters(30)), ("none", None)]
    reads = []
    for k in range(200):
        name, seq = refs[k % 23]
        n = rng.choice([23, 24, 31, 32, 36])
        at = rng.randrange(len(seq) - n + 1)
        x = list(seq[at : at + n])
        if k % 3:
            x[rng.randrange(n)] = "N"
        x = "".join(x)
        reads.append((f"r{k}/{name}", [x, back(x), x.lower(), x.replace("T", "U")][k % 4 if x.isascii() else 0]))
    reads += [("e", ""), ("n", None)]
    r, f = spark.createDataFrame(reads, "read_id string, seq string"), spark.createDataFrame(refs, "ref_id string, seq string")
    keys = {x["read_id"]: x["count"] for x in align._block_keys(r, "read_id", False).groupBy("read_id").count().collect()}
    assert keys == {i: 2 if len(s) >= 32 else 3 for i, s in reads if s and len(s) >= 24}
    found = {(x["read_id"], x["ref_id"], x["strand"]) for x in align.block_pairs(r, f).collect()}
    for i, s in reads:
        if i in keys:
            k = int(i[1:].split("/")[0])
            assert (i, i.split("/")[1], "-" if k % 4 == 1 and s.isascii() else "+") in found
    forward = {(x["read_id"], x["ref_id"], x["strand"]) for x in align.block_pairs(r, f, both_strands=False).collect()}
    assert forward == {x for x in found if x[2] == "+"}
    # long texts are cut into pieces
    every = lambda: {(x["ref_id"], x["key"], x["turned"]) for x in align._block_keys(f, "ref_id", True).collect()}
    whole, size = every(), align._block_keys(f, "ref_id", True).count()
    assert size == len(whole)
    plain, align.LETTERS = align.LETTERS, 50
    try:
        assert every() == whole
    finally:
        align.LETTERS = plain


def test_the_best_of_a_read_is_found_over_batches(spark):
    rng = random.Random(31)
    letters = lambda n: "".join(rng.choices("ACGT", k=n))
    core = letters(40)
    refs = [(f"p{k}", letters(10) + core[: 30 + k % 11] + letters(20)) for k in range(30)] + [("twin1", letters(70)), ("other", letters(60))]
    refs.append(("twin0", refs[-2][1]))
    reads = [("r", core), ("t", refs[-3][1][5:45]), ("x", letters(50)), ("two", core), ("two", letters(45)), (None, core), ("none", None)]
    r, f = spark.createDataFrame(reads, "read_id string, seq string"), spark.createDataFrame(refs, "ref_id string, seq string")
    asked = lambda: sorted((x["read_id"], x["ref_id"], x["score"], x["strand"]) for x in align.align_join(r, f, identity=0.85, length=20, top=True).filter("read_id is not null").collect())
    want = asked()
    assert want == [("r", "p10", 400, "+"), ("t", "twin0", 400, "+"), ("two", "p10", 400, "+")]
    for rows, sent in ((1, 0), (2, align.SENT_LETTERS), (3, 0)):
        plain, align.SENT_LETTERS = align.SENT_LETTERS, sent
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        try:
            assert asked() == want
        finally:
            align.SENT_LETTERS = plain
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_the_best_of_a_read_is_picked_without_a_shuffle_of_alignments(spark):
    d = spark.createDataFrame([("r", "ACGTTGCA" * 5)], "read_id string, seq string")
    plan = align.align_join(d, d.withColumnRenamed("read_id", "ref_id"), identity=0.85, length=15, top=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_placed_rows_count_like_columns_without_a_shuffle(spark):
    rng = random.Random(37)
    rows = []
    for k in range(120):
        top, bottom = [], []
        for _ in range(rng.randint(0, 25)):
            x = rng.choice("ACGT-") if k % 3 else rng.choice("ACGT")
            top.append(x)
            bottom.append(rng.choice("ACGTNXa") if x == "-" else rng.choice("ACGTNa-"))
        rows.append((f"r{k}", f"p{k % 4}", rng.randint(0, 9), "".join(top), "".join(bottom), rng.randint(1, 5)))
    rows += [("e", "p0", 0, "", "", 1), ("n", "p1", 0, None, None, 1)]
    aln = spark.createDataFrame(rows, "read_id string, ref_id string, ref_begin int, top string, bottom string, n int")
    plain, placed = pileup.alignment_columns(aln, weight="n"), pileup.placed(aln, weight="n")
    names = ["ref_id", "pos", "w", "base", "ins"]
    order = lambda df: sorted(map(tuple, df.collect()))
    spread = placed.repartition(4, "ref_id")
    columns = pileup.placed_columns(spread)
    assert order(columns.select(names)) == order(plain.select(names))
    for frame in (0, 1, 2):
        assert order(pileup.placed_codon_counts(placed, frame)) == order(pileup.codon_counts(plain, frame))
        assert order(pileup.placed_genotype(placed, [1, 3], frame)) == order(pileup.linked_genotype(plain, [1, 3], frame))
    for made in (pileup.pileup(columns), pileup.coverage_summary(pileup.coverage(columns)), pileup.consensus_weighted(columns), pileup.placed_codon_counts(spread)):
        assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
