import math
import random

import numpy as np
import pytest

from tagloom.llm import vector_search as vs


def naive(rows, ids, k=5, scale=256):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(scale * x) for x in v):
            kept[(i, tuple(math.floor(scale * x) for x in v))] = 1
    out = []
    for q, x in kept:
        if q in ids:
            found = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), c) for c, y in kept if c != q)[:k]
            out += [(q, n + 1, c, max(-(2**63), min(2**63 - 1, -s))) for n, (s, c) in enumerate(found)]
    return sorted(out)


def searched(spark, rows, ids, **more):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(3)
    return sorted(tuple(r) for r in vs.top_inner_products(df, df.filter(df["vec_id"].isin(list(ids))), **more).collect())


def clustered(rng, n, width=6, clusters=5):
    centres = rng.normal(size=(clusters, width)) * 3
    return [(i, (centres[rng.integers(clusters)] + rng.normal(size=width) * 0.2).tolist()) for i in range(n)]


@pytest.mark.parametrize("more", [{}, {"n_pivots": 1}, {"n_pivots": 7, "annulus": 16, "k": 3}, {"n_pivots": 40, "annulus": 1}])
def test_search_is_the_brute_force(spark, more):
    rows = clustered(np.random.default_rng(1), 300)
    ids = set(range(0, 300, 17))
    assert searched(spark, rows, ids, **more) == naive(rows, ids, more.get("k", 5))


def test_ties_copies_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25]) for _ in range(3)]) for i in range(80)]
    rows += [(100 + i, [0.5, 0.5, 0.5]) for i in range(60)]  # a vector that many rows share
    rows += [(200, None), (201, [0.1, None, 0.2]), (202, [float("nan"), 1.0, 1.0]), (203, [float("inf"), 0.0, 0.0]), (None, [9.0, 9.0, 9.0]), (204, []), (205, [1.0]), (206, [0.0, 0.0, 0.0, 2.0]), (3, rows[3][1]), (207, [1e308, 0.0, 0.0])]
    ids = {0, 3, 100, 130, 200, 202, 204, 205, 206}
    want = naive(rows, ids)
    for more in ({}, {"n_pivots": 3, "annulus": 8}):
        assert searched(spark, rows, ids, **more) == want


def test_large_components_stay_exact(spark):
    rows = [(i, [x * 1.0e9, 3.0, float(i)]) for i, x in enumerate([1, -1, 2, 3, 1, 1, 5e4, -5e4, 7e7, -7e7])]
    ids = {0, 6, 8}
    assert searched(spark, rows, ids) == naive(rows, ids)


def test_few_rows(spark):
    rows = [(0, [0.5, 0.5]), (50, [0.25, 0.0])]
    assert searched(spark, rows, {0, 50}) == [(0, 1, 50, 8192), (50, 1, 0, 8192)]
    assert searched(spark, rows, set()) == [] and searched(spark, rows[:1], {0}) == []
    assert searched(spark, [], {0}) == []


def test_annuli_out_of_reach_are_passed_over(spark):
    """In clusters far apart the search visits few of the pairs of queries and annuli."""
    rows = clustered(np.random.default_rng(5), 2000, width=4, clusters=20)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = vs.prepared(df, "vec_id", "embedding", 256.0)
    pivots = vs.fit(vectors, 20)
    indexed = vs.index(vectors, pivots, 5, 64)
    visited = []
    real = vs.visit
    try:
        vs.visit = lambda pairs, *x: visited.append(pairs.count()) or real(pairs, *x)
        queries = vectors.filter("vec_id % 50 = 0")
        found = sorted(tuple(r) for r in vs.search(indexed, pivots, queries, 5).collect())
    finally:
        vs.visit = real
    assert found == naive(rows, set(range(0, 2000, 50)))
    assert sum(visited) < 0.5 * queries.count() * vs.directory(indexed).count()
