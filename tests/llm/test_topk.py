import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradevault.llm import topk as K

VECTORS = "vec_id long, embedding array<double>"


def brute(rows, k=5):
    kept = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, a in kept:
        if q % 50 == 0:
            scored = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in kept if i != q and len(a) == len(b)))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


def top(spark, rows, **more):
    return {tuple(r) for r in K.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, **more).collect()}


@pytest.mark.parametrize("block,query_block", [(16_384, 4096), (64, 3)])
def test_equals_brute_force(spark, block, query_block):
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.normal(0, 0.2, 8).tolist()) for i in range(400)] + [(1000 + i, [0.25] * 8) for i in range(30)]
    assert top(spark, rows, block=block, query_block=query_block) == brute(rows)


def test_stops_before_the_end_of_the_lists():
    """One vector far ahead in the only dimension that counts: the lists are left after the first stride."""
    x = np.zeros((5000, 3), np.int64)
    x[:, 0] = np.arange(5000)
    lists, best = K.Lists(np.arange(5000), x, 10), K.Best(2)
    seen = []
    original = K.products
    K.products = lambda a, q, e: seen.append(len(a)) or original(a, q, e)
    try:
        lists.search(-1, np.array([5, 0, 0]), best)
    finally:
        K.products = original
    assert best.ids.tolist() == [4999, 4998] and sum(seen) < 100


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, -1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (None, [1.0, 1.0]), (7, [0.5, 0.5]), (50, []), (8, []), (100, [0.0, 0.0])]
    assert top(spark, rows) == brute(rows)
    assert top(spark, rows[:0]) == set()


def test_large_components_stay_exact(spark):
    rows = [(i, [float(3**12 + i), 1.0, -float(2**20)]) for i in range(60)]
    assert top(spark, rows) == brute(rows)
