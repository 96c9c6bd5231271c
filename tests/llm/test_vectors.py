"""Nearest vectors against all pairs, computed in whole numbers of any size."""

import math
import random

import numpy as np
import pytest

from wardline.llm import pivot_join

SCHEMA = "vec_id long, embedding array<float>, row string, cell string, x string"


def brute(rows, every=100, k=10, scale=1024):
    kept = [
        (v, [math.floor(scale * float(np.float32(c))) for c in x])
        for v, x in rows
        if x is not None and all(c is not None and math.isfinite(c) for c in x)
    ]
    out = []
    for i, (q, a) in enumerate(kept):
        if q is None or q % every:
            continue
        scores = [(-sum(c * d for c, d in zip(a, b)), s is None, s or 0, s) for j, (s, b) in enumerate(kept) if i != j]
        out += [(q, r, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(v, x, "a", "b", "c") for v, x in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, pivot_join.nearest(df, **more).collect()), key=str)


def cloud(seed, n, dim, groups):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(groups, dim)) * 3
    return [(i, [float(np.float32(c)) for c in middle[r.integers(groups)] + r.normal(size=dim) * 0.3]) for i in range(n)]


@pytest.mark.parametrize("blocks", [{}, {"block": 3, "chunk": 100, "pivots": 7}, {"pivots": 1}, {"block": 1, "pivots": 50}])
def test_equals_all_pairs(spark, blocks):
    rows = cloud(4, 1500, 8, 12)
    assert run(spark, rows, every=50, **blocks) == brute(rows, every=50)


def test_vectors_of_all_kinds(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (100, [1.0, 2.0]), (100, [1.0, 2.0]), (200, [-3.0, 0.5, 7.0]), (300, []), (None, [1.0, 2.0]), (None, [5.0, 5.0]),
        (400, None), (500, [1.0, None]), (600, [nan, 1.0]), (700, [inf, 1.0]), (7, [1.0, 2.0]), (9, [0.0, -0.0001]), (800, [0.0]),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(0, [1.0])]) == [] and run(spark, [(1, [1.0]), (2, [1.0])]) == [] and run(spark, []) == []
    assert run(spark, [(0, None)]) == []


def test_numbers_beyond_doubles(spark):
    rows = [(i, [3e11 * (i % 7) + i, -2e10 * i, float(i)]) for i in range(250)]
    got, want = run(spark, rows), brute(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(g[3] == max(-(2**63), min(2**63 - 1, w[3])) for g, w in zip(got, want))


def test_a_third_in_one_place(spark):
    r = random.Random(2)
    rows = [(i, [0.5, 0.25, -0.125] if i % 3 else [r.gauss(0, 1) for _ in range(3)]) for i in range(1200)]
    assert run(spark, rows, every=10, block=16, chunk=64) == brute(rows, every=10)


def test_far_cells_stay_at_home():
    r = np.random.default_rng(1)
    pivots = pivot_join.lifted(np.eye(6) * 100, 101.0)
    near = [(j, 1000, 1.5, [0.1] * 11) for j in range(6)]
    asked = [(j, 100, math.sqrt(101**2 - 100**2) + 1.0, 16.0) for j in range(6)]
    wanted, cells = pivot_join.plan_of(pivots, asked, near, 10, 100, 500, 101.0)
    groups = {i: g for i, g, _, _ in cells}
    for j, ranges in wanted:
        assert [g for low, high, g in ranges if low <= 1.0 <= high] == [groups[j]]
    assert {c[3] for c in cells} == {2} and r is not None
