import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescope.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, score long, id string, rank int"


def brute(rows, every, k=10, scale=1024):
    """{(query, rank, id, score)}; equal rows count once."""
    kept = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i, tuple(math.floor(scale * x) for x in v)] = True
    out = []
    for i, q in kept:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), j) for j, c in kept if j != i)
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, every, k=10):
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in K.top_k(frame, F.col("id") % every == 0, k=k).collect())


def f32(v):
    return [None if x is None else float(np.float32(x)) for x in v]


@pytest.mark.parametrize(("queries", "candidates"), [(512, 4096), (3, 16)])
def test_matches_brute_force(spark, monkeypatch, queries, candidates):
    monkeypatch.setattr(K, "QUERIES", queries)
    monkeypatch.setattr(K, "CANDIDATES", candidates)
    rnd = random.Random(3)
    rows = [(i, f32([rnd.choice([0, rnd.uniform(-1, 1)]) for _ in range(12)])) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # a frequent vector: ties
    assert found(spark, rows, 10) == brute(rows, 10)


def test_edge_cases(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]),
            (6, [1.0]), (7, [0.5, 0.25, 9.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (10, [-0.0001, 0.0]),
            (10, [3.0, 1.0])]
    assert found(spark, rows, 1) == brute(rows, 1)
    assert found(spark, rows, 5, k=2) == brute(rows, 5, k=2)


def test_large_components(spark):
    """Scores of every finite vector are those of Python's integers."""
    big = [(0, [-1e20, 1.0]), (1, [1.0, 1.0]), (2, [-2.0, 1.0]), (3, [1e20, 5.0]), (4, [-(2.0**21), 0.0]), (5, [2.0**21, 1.0]),
           (6, [-(2.0**53) / 1024, 3.0]), (7, [2.0**53, -(2.0**53)]), (8, [1e18, 1e18]), (9, [0.0, 0.0]), (10, [-1e18, 1e18]),
           (11, [3e38, 3e38]), (12, [-3e38, 3e38]), (13, [2.0**52, 1.0]), (14, [-(2.0**53), 0.0])]
    big += [(100 + i, f32([random.Random(i).uniform(-1, 1) for _ in range(2)])) for i in range(60)]
    rows = [(i, f32(v)) for i, v in big]
    cut = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    want = [(q, n, i, cut(s)) for q, n, i, s in brute(rows, 1, k=20)]
    assert found(spark, rows, 1, k=20) == want
    assert any(abs(s) >= (1 << 63) - 1 for *_, s in want) and any(0 < abs(s) < 1 << 62 for *_, s in want)


def test_block_types_hold_their_values():
    for low, high, kind in ((-(2.0**31), 2.0**31 - 1, "<i4"), (-(2.0**31) - 1, 0, "<i8"), (0, 2.0**31, "<i8"),
                            (-(2.0**63), 0, "<i8"), (0, 2.0**63, "<f8"), (-1e20, 1, "<f8")):
        dense = np.array([[low, high]])
        assert K._kind(dense) == kind and (dense.astype(kind).astype(float) == dense).all()


def test_few_rows(spark):
    assert found(spark, [], 1) == []
    assert found(spark, [(0, [1.0])], 1) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])], 50) == []


def test_a_score_beyond_64_bits_is_cut_to_them(spark):
    """It is ranked by its exact value all the same."""
    rows = [(0, [1e30]), (1, [1e28]), (2, [1e29]), (3, [-1e30]), (4, [1.0])]
    most = (1 << 63) - 1
    got = [r[2:] for r in found(spark, [(i, f32(v)) for i, v in rows], 10)]
    assert got == [(2, most), (1, most), (4, most), (3, -most - 1)]



def test_scatter_equals_product():
    rnd = np.random.default_rng(1)
    q, c = rnd.integers(-5, 6, (7, 9)), rnd.integers(-5, 6, (20, 9))
    q[rnd.random(q.shape) < 0.5] = 0
    c[rnd.random(c.shape) < 0.5] = 0
    assert (K.accumulate(q, c) == q @ c.T).all()
    assert (K.accumulate(np.abs(q) + 1, c) == (np.abs(q) + 1) @ c.T).all()
