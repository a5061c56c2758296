"""Findings on cost: each job does its work once a row and gives the results of the plain way."""

import itertools
import pathlib
import random

import pyarrow as pa
from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.operators import library, trims, windows
from seqframe.plans import q_more
from seqframe.sources import fastq, typed_tables


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_peaks_are_made_within_the_row(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("AACGTNa", k=rng.randint(0, 60))) for _ in range(120)] + ["A" * 10, "A" * 9, "é" + "A" * 12 + "é", "A" * 70, None]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq_id int, seq string").repartition(3)
    for base in (-3, 0, 1.5):
        plain = windows.find_peaks(windows.pair_score(d, "A", 10), base)
        made = windows.pair_peaks(d, "A", 10, base)
        assert "Window" not in _plan(made) and "Generate" not in _plan(made)
        order = lambda t: sorted(map(tuple, t.select("seq_id", "begin", "end", "area", "height", "top").collect()))
        assert order(made) == order(plain)
        assert order(windows.pair_peaks(d, "A", 10, base, largest=True)) == order(windows.max_peak(plain))


def test_one_mismatch_by_four_keys_a_sequence(spark):
    rng = random.Random(7)
    entries = ["".join(rng.choices("AC", k=rng.choice([1, 3, 7, 21]))) for _ in range(40)]
    near = [s[:k] + rng.choice("ACGTN") + s[k + 1 :] for s in entries for k in range(len(s))]
    rows = {s: (s, True, 2) for s in entries}
    for s in near + ["", "ACGTACGTACGTACGTACGTA"]:
        rows.setdefault(s, (s, False, 3))
    counts = spark.createDataFrame(list(rows.values()), "sequence string, in_library boolean, n long")
    assert counts.select(F.max(F.size(library.gapped_keys("sequence")))).first()[0] == 4
    want = {}
    for s, known, n in rows.values():
        partners = [] if known else [e for e in set(entries) if len(e) == len(s) and sum(a != b for a, b in zip(e, s, strict=True)) == 1]
        key = (partners[0], True) if len(partners) == 1 else (s, known)
        want[key] = want.get(key, 0) + n
    assert {(r["sequence"], r["in_library"]): r["n"] for r in library.correct_one_mismatch(counts).collect()} == want


def test_short_reads_are_trimmed_once_a_row(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ACGTN", (8, 8, 8, 8, 1), k=rng.randint(20, 70))) for _ in range(80)] + ["A" * 40, "A" * 30 + "C" * 3, "NN" + "ACGT" * 8 + "N" + "ACGT" * 8, "A" * 31 + "ACGT" * 9, "a" * 31 + "CGTA" * 9, None, ""]
    d = spark.createDataFrame([(t,) for t in texts + texts[:9]], "seq string")
    got = trims.clean_short_reads(d)
    assert _plan(got).count("split(") <= 2

    def expected(text):
        parts = [p for p in (text or "").strip("N").split("N") if p]
        best = max(parts, key=len, default="")
        runs = max((len(w) for b in "ACGT" for w in "".join(x if x in (b, "N") else " " for x in best).split()), default=0)
        simple = best and max(best.upper().count(b) for b in "ACGTN") / len(best) > 0.9
        return best if len(best) >= 26 and not simple and not runs / len(best) > 0.89 and not any(b * 31 in best for b in "ACGT") else None

    want = {}
    for t in texts + texts[:9]:
        if best := expected(t):
            want[best] = want.get(best, 0) + 1
    assert {r["seq"]: r["n"] for r in got.collect()} == want


def test_codons_are_looked_up_once(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choices("ACGTacgtuUNR", k=rng.randint(0, 40))) for _ in range(60)] + ["".join(c) for c in itertools.product("TCAG", repeat=3)] + [None]
    d = spark.createDataFrame([(t,) for t in texts], "seq string")
    for frame, reverse in ((1, False), (2, False), (3, False), (2, True)):
        got = d.select("seq", S.translate("seq", frame, reverse).alias("p"), S.revcomp("seq").alias("rc"))
        assert _plan(got).count("locate(") + _plan(got).count("position(") <= 1
        for r in got.collect():
            s = (r["rc"] if reverse else r["seq"] or "").upper().replace("U", "T")[frame - 1 :] if r["seq"] is not None else None
            codons = [s[k : k + 3] for k in range(0, len(s) - 2, 3)] if s is not None else []
            known = lambda c: S.GENETIC_CODE[sum("TCAG".index(b) * 4 ** (2 - k) for k, b in enumerate(c))] if set(c) <= set("TCAG") else "X"
            assert r["p"] == (None if s is None else "".join(map(known, codons)))


def test_whole_records_go_without_a_loop(spark, tmp_path):
    rng = random.Random(13)
    want, text = {}, ""
    for i in range(400):
        seq = "".join(rng.choices("ACGT", k=rng.randint(1, 30)))
        qual = "".join(rng.choices("@I5+", k=len(seq)))
        want[f"r{i}"] = (seq, [ord(c) - 33 for c in qual])
        text += f"@r{i} t {i}\n{seq}\n+\n{qual}\n"
    path = tmp_path / "a.fq"
    path.write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = fastq.read_fastq(spark, str(path)).orderBy("ord").collect()
    finally:
        for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch"):
            spark.conf.unset(key)
    assert [r["read_id"] for r in rows] == list(want)
    assert {r["read_id"]: (r["seq"], r["qual"]) for r in rows} == want
    # of the ranges' whole records none is sent a second time for the pieces
    n = 5
    batch = pa.RecordBatch.from_pydict({"value": ["a\nAC\n+\nII"] * n, "src": ["f"] * n, "start": pa.array([0] * n, pa.int64()), "length": pa.array([99] * n, pa.int64())})
    assert [b.num_rows for b in fastq._pieces(False)(iter([batch]))] == [n] and not list(fastq._pieces(True)(iter([batch])))


def test_reports_are_written_compressed(spark):
    d = spark.range(1000).select(F.lit(7).alias("l_orderkey"), F.col("id").alias("l_linenumber"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(20.0).alias("l_quantity"))
    path = q_more.lines(d, "report", "Query= q", F.col("l_partkey").cast("string"), " (120 letters)\n" * 20, per_file=100)
    files = list(pathlib.Path(path.removeprefix("file:")).glob("*.txt.gz"))
    assert len(files) >= 10 and sum(f.stat().st_size for f in files) < 1000 * 300 / 4
    assert spark.read.option("lineSep", "\nQuery=").text(path).filter("value like '%letters%'").count() == 1000


def test_tables_are_read_once_before_their_rules(spark):
    d = spark.createDataFrame([("x", 1, None, None, None, "o")] * 2, "genomicid string, strand int, start_pos int, end_pos int, chromosome string, organism string").withColumn("mol_type", F.lit("m"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    found = typed_tables.problems({"source": d.mapInPandas(count, d.schema)})
    assert sorted((r["column_name"], r["problem"], r["n"]) for r in found.collect()) == [("genomicid", "repeated key", 2)]
    assert seen.value == 2
