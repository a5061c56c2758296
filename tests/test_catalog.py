"""Registered queries against their SQL on the smallest tables, and operators by hand."""

import math
import os

import pytest

from seqframe.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
#: A few of each module; the whole list is compared by the driver.
SAMPLE = ["minimum_slice", "c06_translate_frame1", "c16_trim_low_quality", "f22_relative_hit_filter", "j05_pick_new_versions", "a08_collapse_strands", "w09_find_peaks", "j20_three_prime_region", "j14_correct_one_mismatch", "w01_select_hits"]


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 5)
    return x


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SF}/{f}')")
    found = con.execute(SQL[name])
    names = [c[0] for c in found.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in found.fetchall()), key=repr)
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
    assert got == want


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_same_result_for_one_and_many_partitions(spark):
    from pyspark.sql import functions as F

    from seqframe.operators import dedupe, select

    rows = [(f"i{k % 7}", "ACGT"[k % 4] * 5 + "ACGT"[k % 3], f"f{k % 2}", k) for k in range(60)]
    df = spark.createDataFrame(rows, "seq_id string, seq string, src string, ord long")
    for op in (dedupe.unique_by_id, lambda d: dedupe.unique_by_sequence(d), lambda d: select.renumber(d.withColumn("title", F.lit("t")), "x"), lambda d: select.sample_exact(d, 5, 1)):
        one, many = op(df.coalesce(1)).collect(), op(df.repartition(7)).collect()
        assert sorted(map(repr, one)) == sorted(map(repr, many))


def test_split_outputs_add_up(spark):
    from seqframe.operators import select

    df = spark.createDataFrame([(f"i{k}", "ACGT") for k in range(20)], "seq_id string, seq string")
    ids = spark.createDataFrame([(f"i{k}",) for k in range(5, 30)], "seq_id string")
    split = select.split_by_id(df, ids).groupBy("class").count().collect()
    assert {r["class"]: r["count"] for r in split} == {"removed": 15, "saved": 5}
    assert select.pick_by_id(df, ids).count() + select.discard_by_id(df, ids).count() == 20


def test_composite_trims_run(spark):
    from pyspark.sql import functions as F

    from seqframe.operators import trims

    body = "ACGTCAGTCATGCATGCTAGCTAGCATCGATCGATCAGCTACGATCAGCATCAGCATCGACTACG" * 2
    df = spark.createDataFrame([("a", body + "A" * 30), ("b", "N" * 40), ("c", body)], "seq_id string, seq string")
    kept = {r["seq_id"]: r["seq"] for r in trims.clean_est(df).collect()}
    assert set(kept) == {"a", "c"} and not kept["a"].endswith("A" * 10)
    cut = trims.complexity_trim(spark.createDataFrame([("x", "A" * 60 + body)], "seq_id string, seq string")).first()
    assert cut["code"] in (1, 3) and len(cut["seq"]) < 60 + len(body)
    peaks = trims.poly_peaks("C" * 20 + "A" * 30 + "G" * 20, "A")
    assert len(peaks) == 1 and peaks[0][3] == 4.5
    assert trims.clean_vector_est(df.withColumn("seq", F.concat(F.lit("XX"), "seq"))).count() == 2


def test_entry_works_without_the_corpus_operators(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "seqframe", tmp_path / "seqframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'minimum_slice' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr[-500:]


def test_consolidated_hits_equal_a_plain_loop(spark):
    import random

    from seqframe.operators import hits

    rng = random.Random(6)
    rows = []
    for k in range(300):
        a, b, n = rng.randint(1, 80), rng.randint(1, 80), rng.randint(5, 30)
        rows.append((f"q{k % 5}", f"t{k % 3}", rng.random(), n, a, a + n, b, b + n, rng.choice([1e-5, 1e-3, 1e-180]), rng.randint(10, 90), k))
    df = spark.createDataFrame(rows, "query string, target string, identity double, length int, qstart int, qend int, tstart int, tend int, evalue double, score int, ord int")
    got = {(r["query"], r["target"]): r for r in hits.consolidate_hits(df).collect()}
    for pair in {(r[0], r[1]) for r in rows}:
        own, kept = [r for r in rows if (r[0], r[1]) == pair], []
        for r in own:
            if all(min(r[5], x[5]) - max(r[4], x[4]) + 1 <= 1 and min(r[7], x[7]) - max(r[6], x[6]) + 1 <= 1 for x in kept):
                kept.append(r)
        g = got[pair]
        assert g["length"] == sum(r[3] for r in kept) and g["score"] == sum(r[9] for r in kept)
        assert abs(g["identity"] - sum(r[2] * r[3] for r in kept) / g["length"]) < 1e-9 and abs(g["kept_ratio"] - len(kept) / len(own)) < 1e-9
        assert (g["evalue_product"] == 0) == any(r[8] < 1e-170 for r in kept)


def test_lean_reads_equal_their_view(spark):
    from seqframe.plans import fixtures

    made, view = fixtures.reads(spark, SF), fixtures.view(spark, SF, "fx_reads")
    assert made.schema == view.schema  # the SQL view
    assert made.exceptAll(view).count() == view.exceptAll(made).count() == 0 < view.count()
    exchanged = [line for line in made._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in line]
    assert exchanged and not any("qual" in line or "seq" in line for line in exchanged)
