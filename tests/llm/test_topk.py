"""Exact top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import topk

SCHEMA = "vec_id bigint, vector array<bigint>, rank string"


def brute(rows, k, asks):
    """query_id, rank, vec_id, score of every query row."""
    rows = [r for r in rows if r[1] is not None and None not in r[1]]
    out = []
    for i, (own, q, *_) in enumerate(rows):
        if own is None or not asks(own):
            continue
        found = [(-sum(a * b for a, b in zip(q, v)), key is None, key or 0, key) for j, (key, v, *_) in enumerate(rows) if j != i]
        out += [(own, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def searched(spark, rows, k=5, asks=3, **blocks):
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], SCHEMA)
    got = topk.top_k(df, F.col("vec_id") % asks == 0, k, **blocks)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 50, "block_queries": 16}])
def test_like_brute_force(spark, blocks):
    rng = np.random.default_rng(1)
    rows = [(i, [int(x) for x in rng.normal(0, 9, 24)]) for i in range(300)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]  # copies: ties
    assert searched(spark, rows, 20, **blocks) == brute(rows, 20, lambda i: i % 3 == 0)


def test_odd_rows(spark):
    rows = [(0, [1, -2, 3]), (0, [1, -2, 3]), (0, [5, 0, 0]), (3, []), (4, None), (5, [1, None, 2]), (None, [2, 2, 2]),
            (None, [2, 2, 2]), (6, [0, 0, 0]), (7, [9]), (9, [-4, 4]), (12, [1 << 40, -1, 0]), (13, [-3, 0, 1])]
    assert searched(spark, rows, 4) == brute(rows, 4, lambda i: i % 3 == 0)
    assert searched(spark, rows, 100) == brute(rows, 100, lambda i: i % 3 == 0)
    assert searched(spark, rows[:1]) == [] and searched(spark, []) == []


def test_a_row_that_stands_for_a_third_of_all(spark):
    rows = [(3, [1, 2])] * 100 + [(i, [i % 11, -i % 5]) for i in range(200, 400)]
    assert searched(spark, rows, 7, block_rows=64) == brute(rows, 7, lambda i: i % 3 == 0)


def test_waves_prove_most_rows_out():
    """Of a block with some near rows few are scored, and none of the best is lost."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 8, (4000, 64)).round().astype(np.int64)
    q = (x[:30].mean(axis=0) * 3).round().astype(np.int64)
    x[:30] = q + rng.integers(-1, 2, (30, 64))
    index = topk.ImpactIndex(x)
    scores = x @ q
    for k in (1, 20):
        left = index.possible(q, k)
        assert left.size <= max(4 * k, topk.FEW * len(x))
        assert set(np.flatnonzero(scores >= np.sort(scores)[-k])) <= set(left.tolist())


@pytest.mark.parametrize("scale", [1, 5000, 1 << 24])
def test_quantised_magnitudes_keep_all_possible_rows(scale):
    """Also where a segment spans many magnitudes and the limits are rounded."""
    rng = np.random.default_rng(scale)
    x = rng.integers(-3, 4, (500, 8)) * scale + rng.integers(-scale, scale + 1, (500, 8))
    for q in x[:40] - x[40:80]:
        scores = x @ q
        left = topk.ImpactIndex(x).possible(q, 10)
        assert set(np.flatnonzero(scores >= np.sort(scores)[-10])) <= set(left.tolist())


def test_components(spark):
    rows = [([0.5, -0.26],), ([float("nan"), 1.0],), ([float("inf")],), ([None, 1.0],), (None,), ([],)]
    df = spark.createDataFrame(rows, "e array<float>")
    got = [r[0] for r in df.select(topk.whole_components(F.col("e"), 64)).collect()]
    assert got == [[32, -17], None, None, None, None, []]
