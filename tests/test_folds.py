"""Folds along sorted rows against plain loops, with groups that go over the ends of Arrow batches."""

import random

import pytest

from seqframe.operators import hits, intervals, select


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_disjoint_hits(spark, small_batches):
    rng = random.Random(3)
    rows = []
    for k in range(150):
        q, t = rng.randint(1, 300), rng.randint(1, 300)
        rows.append((f"q{k % 5 if k < 90 else k}", "t1", q, q + rng.randint(0, 40), t + rng.randint(0, 30), t, k))
    want, seen = {}, {}
    meet = lambda a, b: min(max(a), max(b)) - max(min(a), min(b)) + 1 > 1
    for q, t, a, b, c, d, k in rows:
        kept = seen.setdefault((q, t), [])
        want[k] = not any(meet((a, b), x) or meet((c, d), y) for x, y in kept)
        if want[k]:
            kept.append(((a, b), (c, d)))
    df = spark.createDataFrame(rows, "query string, target string, qstart int, qend int, tstart int, tend int, ord int")
    flagged = hits.keep_disjoint(df.repartition(5))
    assert {r["ord"]: r["kept"] for r in flagged.collect()} == want
    # one pass over sorted rows: no Python call a group
    assert "FlatMapGroups" not in flagged._jdf.queryExecution().executedPlan().toString()


def test_regions(spark, small_batches):
    rng = random.Random(4)
    rows = []
    for k in range(200):
        lo = rng.randint(1, 400)
        rows.append((f"s{k % 3}", "+-"[k % 2], lo, lo + rng.randint(0, 25), float(rng.randint(20, 90)), rng.choice([1e-9, 0.1]), k))
    want = []
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3], r[6])):
        seq, strand, lo, hi, score, evalue, _ = r
        last = want[-1] if want and want[-1][:2] == [seq, strand] else None
        good = score > 50 or evalue < 1e-5
        if last and lo <= last[3] and last[4] < 10 and good and (last[5] - score < 6 or score > 50):
            last[3], last[4], last[5] = max(last[3], hi), last[4] + 1, max(last[5], score)
        elif good:
            want.append([seq, strand, lo, hi, 1, score])
    made = intervals.merge_regions(spark.createDataFrame(rows, "seq_id string, strand string, lo int, hi int, score double, evalue double, ord int"))
    assert sorted(map(list, made.collect())) == sorted(want)
    assert "FlatMapGroups" not in made._jdf.queryExecution().executedPlan().toString()


def test_head_fraction_by_ranges(spark):
    rng = random.Random(6)
    rows = [(f"r{k}", None if k % 4 == 3 else f"f{k % 4}", k, "A" * rng.randint(1, 9)) for k in range(400)]
    want = set()
    for src in {r[1] for r in rows}:
        own, run = [r for r in rows if r[1] == src], 0
        for r in own:
            run += len(r[3])
            if run <= 0.3 * sum(len(x[3]) for x in own):
                want.add(r)
    made = select.head_fraction(spark.createDataFrame(rows, "read_id string, src string, ord int, seq string").repartition(5), 0.3)
    assert {tuple(r) for r in made.collect()} == want and made.columns == ["read_id", "src", "ord", "seq"]
    # running sums are of a range of a file, never of a whole file
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(__part" in plan and "windowspecdefinition(src" not in plan
