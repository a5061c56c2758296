"""The threshold algorithm against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqframe.llm import hard_negatives as H

SCHEMA = "vec_id long, vector array<long>, label int, shard string, v int"


def brute(rows, anchor, positives=5, negatives=5, low=80, high=100):
    live = [(i, v, lab) for i, v, lab, *_ in rows if lab is not None and v is not None and None not in v]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    out = []
    for p, (i, a, own) in enumerate(live):
        if i is None or not anchor(i):
            continue
        scored = [(score(a, v), j, q, lab) for q, (j, v, lab) in enumerate(live) if q != p]
        for s, j, _, _ in sorted((x for x in scored if x[3] == own), key=order)[:positives]:
            fits = [x for x in scored if x[3] != own and low * s <= 100 * x[0] <= high * s]
            out += [(i, j, r + 1, x[1], s, x[0]) for r, x in enumerate(sorted(fits, key=order)[:negatives])]
    return sorted(map(str, out))


def rows_of(seed, n, width, span):
    rng = np.random.default_rng(seed)
    label = np.where(rng.random(n) < 0.4, 0, rng.integers(0, 5, n))
    return [(k, rng.integers(-span, span + 1, width).tolist(), int(label[k]), "x", 1) for k in range(n)]


def mined(spark, rows, **more):
    df = H.mine(spark.createDataFrame(rows, SCHEMA).coalesce(1), F.col("vec_id") % 10 == 0, **more)
    assert dict(df.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    return sorted(str(tuple(r)) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("span", [1, 40])  # 1: most scores tie
@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40, "group_rows": 7}])
def test_equals_all_scores(spark, span, sizes):
    rows = rows_of(span, 300, 6, span)
    odd = [(300, None, 1, "x", 1), (301, [1, None, 2, 0, 0, 0], 1, "x", 1), (302, rows[5][1], None, "x", 1), (310, [0] * 6, 2, "x", 1), (None, rows[3][1], 0, "x", 1), (None, rows[3][1], 1, "x", 1), (20, rows[20][1], rows[20][2], "x", 1), (320, [9, 9], 3, "x", 1), (330, [], 3, "x", 1), (340, [1] * 6, 99, "x", 1)]
    assert mined(spark, rows + odd, **sizes) == brute(rows + odd, lambda i: i % 10 == 0)


def test_other_windows(spark):
    rows = rows_of(7, 150, 4, 9)
    assert mined(spark, rows, positives=2, negatives=3, low=-50, high=60) == brute(rows, lambda i: i % 10 == 0, 2, 3, -50, 60)


def test_large_components_stay_exact(spark):
    rows = [(k, [(1 << 29) + k, 3 - k], k % 2, "x", 1) for k in range(40)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="63 bits"):
        mined(spark, [(k, [1 << 40], k % 2, "x", 1) for k in range(12)])


def test_sorted_access_stops_early():
    rng = np.random.default_rng(1)
    vectors = np.rint(rng.standard_normal((5000, 4)) ** 3 * 100)  # few rows lead each list
    lists, order = H.Lists(vectors), np.arange(5000)
    anchor = np.array([3.0, -2.0, 0.0, 1.0])
    rows, scores = lists.best(anchor, 5, order, skip=7)
    every = vectors @ anchor
    every[7] = -np.inf
    assert list(rows) == list(np.lexsort((order, -every))[:5]) and lists.met < 1000
    lists.met = 0
    allowed = order % 3 > 0
    (found, _), = lists.within(anchor, [(int(scores[1] * 0.5), int(scores[1]))], 5, order, allowed)
    fits = np.flatnonzero(allowed & (every >= int(scores[1] * 0.5)) & (every <= scores[1]))
    assert list(found) == list(fits[np.lexsort((fits, -every[fits]))][:5]) and lists.met < 2500


def test_quantised_and_empty(spark):
    rows = [(1, [0.5, -0.001]), (2, [1.0, None]), (3, None), (4, [float("nan")]), (5, [float("-inf")]), (6, [])]
    got = {r["k"]: r["q"] for r in spark.createDataFrame(rows, "k int, e array<float>").select("k", H.quantised("e").alias("q")).collect()}
    assert got == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1], 1, "x", 1)]) == []
