import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import knn

SCHEMA = "vec_id bigint, embedding array<float>, place int, v string"


def brute(rows, k):
    whole = [
        (i, np.floor(1024 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for query, q in whole:
        if query % 100 == 0:
            scored = sorted((-int(q @ v), i) for i, v in whole if i != query)[:k]
            out += [(query, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=10):
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    found = knn.voronoi_top_k(knn.integer_vectors(frame), F.col("vec_id") % 100 == 0, k)
    return sorted(map(tuple, found.collect()))


def test_equals_brute_force_with_ties_and_bad_vectors(spark):
    shaker = np.random.default_rng(3)
    rows = [(i, shaker.normal(size=6).tolist()) for i in range(900)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]  # one vector many times
    rows += [(3000, None), (None, [1.0] * 6), (3001, [None] + [1.0] * 5), (3100, [float("nan")] * 6)]
    rows += [(3200, [float("inf")] + [0.0] * 5), (3300, [0.0] * 6)]
    assert run(spark, rows) == brute(rows, 10)


def test_cells_of_bounded_size_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(knn, "_QUERY_ROWS", 2)
    monkeypatch.setattr(knn, "_DATA_ROWS", 40)
    shaker = np.random.default_rng(4)
    rows = [(i * 20, shaker.normal(size=4).tolist()) for i in range(300)]
    assert run(spark, rows, 5) == brute(rows, 5)


def test_small_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0, 0.0]), (7, [0.5, 0.5])]) == [(0, 1, 7, 1024 * 512)]


def test_repeated_ids_are_answered_once(spark):
    rows = [(0, [1.0]), (0, [1.0]), (5, [2.0]), (5, [2.0])]
    assert run(spark, rows, 2) == [(0, 1, 5, 2 * 1024**2), (0, 2, 5, 2 * 1024**2)]


def exact(rows, k, scale=1024):
    """All pairs with Python's integers; scores beyond a bigint are its ends."""
    whole = [(i, [max(-(2**63), min(2**63 - 1, math.floor(float(np.float32(x)) * scale))) for x in v]) for i, v in rows]
    out = []
    for i, q in {i: q for i, q in reversed(whole) if i % 100 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i)[:k]
        out += [(i, n + 1, j, max(-(2**63), min(2**63 - 1, -s))) for n, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("huge", [1e6, 3e10, 1e14, 1e30])
def test_one_huge_vector_costs_no_row_and_no_digit(spark, huge):
    shaker = np.random.default_rng(6)
    rows = [(i * 10, shaker.normal(size=5).tolist()) for i in range(300)]
    rows += [(5, [huge, 0.3, -0.7, 0.0, 0.1]), (100 * 77, [-huge, huge / 3, 0.1, 0.2, 0.3]), (15, [huge, 0.3, -0.7, 0.0, 0.11])]
    rows = list({i: (i, v) for i, v in rows}.values())
    got = run(spark, rows, 6)
    assert sorted(got) == exact(rows, 6)


@pytest.mark.parametrize("seed", range(3))
def test_an_id_in_many_cells_does_not_tighten_bounds(spark, seed):
    shaker = np.random.default_rng(seed)
    rows = [(i * 50, shaker.normal(size=3).tolist()) for i in range(400)]
    rows += [(7, (shaker.normal(size=3) * 3).tolist()) for _ in range(60)]
    got, want = run(spark, rows, 5), exact(rows, 5)
    assert [(q, n, s) for q, n, _, s in sorted(got)] == [(q, n, s) for q, n, _, s in want]
