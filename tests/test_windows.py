"""Windows and positions along a sequence against plain loops; each is made once a row, not once an element."""

from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.operators import stats, trims, windows

SEQS = ["", "A", "TAGA", "TAGATGACCTAAN", "TGATGATAATAGTAG", "ACGTACGTNNACGTTTTTAAGAC", "tagtga", None]


def rows(spark):
    return spark.createDataFrame([(f"s{k}", s, k) for k, s in enumerate(SEQS)], "seq_id string, seq string, ord int")


def test_codon_spacing(spark):
    want: dict[int, int] = {}
    for s in SEQS:
        at = [k for k in range(len(s or "")) if s[k : k + 3].upper() in ("TAG", "TGA", "TAA", "AAN")]
        for a, b in zip(at, at[1:], strict=False):
            want[b - a] = want.get(b - a, 0) + 1
    assert {r["distance"]: r["n"] for r in stats.codon_spacing(rows(spark), ("TAG", "TGA", "TAA", "AAN")).collect()} == want


def test_sums_of_windows(spark):
    changes = lambda s: [int(a != b and "N" not in (a, b)) for a, b in zip(s.upper(), s[1:].upper(), strict=False)]
    want = sorted((f"s{k}", p + 1, 9 * sum(changes(s)[p : p + 4]) // 5) for k, s in enumerate(SEQS) if s for p in range(len(s) - 4))
    assert sorted(map(tuple, windows.sliding_complexity(rows(spark), 5).collect())) == want
    got = {r["seq_id"]: r["v"] for r in rows(spark).filter("seq is not null").select("seq_id", S.change_windows("seq", 5).alias("v")).collect()}
    assert got == {f"s{k}": [v for i, _, v in want if i == f"s{k}"] for k, s in enumerate(SEQS) if s is not None}
    marks = spark.createDataFrame([("||: :|",), ("|",), ("",)], "t string").select(S.sliding_identity("t", 3).alias("v"))
    assert [round(r["v"], 6) for r in marks.collect()] == [round(2.5 / 3, 6), 0.0, 0.0]


def test_qualities_are_decoded_once_a_row(spark):
    d = spark.createDataFrame([("a", "ACGT" * 6, "I" * 20 + "++++"), ("b", "ACGT" * 6, "I" * 18 + "+" * 6), ("c", "ACGT", "IIII")], "read_id string, seq string, qual33 string")
    q = d.withColumn("qual", S.decode_quality("qual33"))
    cut = trims.trim_low_quality(q, longer_than=2).select("read_id", "seq")
    want = {}
    for r in d.collect():
        values = [ord(c) - 33 for c in r["qual33"]]
        low = [k for k in range(len(values) - 5) if sum(values[k : k + 6]) < 120]
        want[r["read_id"]] = r["seq"][: low[0]] if low else r["seq"]
    assert {r["read_id"]: r["seq"] for r in cut.collect()} == want
    least = stats.minimum_quality(q, 4)
    assert {r["read_id"]: (r["min_q"], r["positions"]) for r in least.collect()} == {"a": (40, list(range(5, 21))), "b": (10, [19, 20])}
    # the text is split for the filter and for the result, not for each window or letter
    for df in (cut, least):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("split(qual33") <= 3
