"""Hard negatives by the threshold algorithm (11)."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score double, block int, rank string"


def brute(rows, divisor):
    """Contract by all pairs: rows (id, vector, label) with equal lengths."""
    rows = sorted({(i, tuple(v), l) for i, v, l in rows})
    ints = {(i, l): [math.floor(256 * x) for x in v] for i, v, l in rows}
    out = []
    for (a, lab), v in ints.items():
        if a % divisor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, l) for (i, l), w in ints.items() if i != a)
        others = [(i, -s) for s, i, l in scored if l != lab]
        for s, p, _ in [x for x in scored if x[2] == lab][:5]:
            s = -s
            inside = [(i, n) for i, n in others if 50 * s <= 100 * n <= 95 * s]
            out += [(a, p, k + 1, i, s, n) for k, (i, n) in enumerate(inside[:3])]
    return sorted(out)


def mined(spark, rows, **more):
    table = spark.createDataFrame([(i, v, l, 0.5, 1, "x") for i, v, l in rows], SCHEMA)
    got = negatives.mine(table, F.col("vec_id") % 5 == 0, F.col("label"), **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def test_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 8))
    rows = [(k, np.float32(centres[k % 4] + rng.normal(size=8) * 0.7).tolist(), int(rng.integers(0, 4))) for k in range(400)]
    rows += [(1000 + k, rows[3][1], k % 3) for k in range(150)]  # a large group of copies, in several labels: ties
    want = brute(rows, 5)
    assert len(want) > 500
    assert mined(spark, rows) == want
    assert mined(spark, rows, block_values=8 * 64) == want  # many blocks of rows and of anchors


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.8, 0.1], 2), (3, [0.0, 0.0], 2), (5, [0.0, 0.0], 2), (7, [-1.0, -0.1], 1), (8, [0.9, 0.0], 3), (8, [0.9, 0.0], 3)]
    odd = [(None, [1.0, 1.0], 1), (10, None, 1), (15, [1.0, 1.0], None), (20, [1.0, nan], 1), (25, [inf, 0.0], 1), (30, [None, 1.0], 1), (35, [], 1), (40, [1.0, 1.0, 1.0], 1)]
    assert mined(spark, good + odd) == brute(good, 5)
    assert mined(spark, []) == []
    assert mined(spark, [(5, [1.0], 1)]) == []
    huge = [(0, [3e38, 1.0], 1), (1, [3e38, 1.0], 1), (2, [1.0, 2.0], 2), (3, [1e30, 0.0], 2)]
    assert all(r[4] == r[5] or r[5] < r[4] for r in mined(spark, huge))  # saturated, not crashed


def test_large_integers_are_exact(spark):
    rng = random.Random(4)
    rows = [(k, [float(rng.randint(-2**22, 2**22)) for _ in range(3)], k % 2) for k in range(60)]
    assert mined(spark, rows) == brute(rows, 5)


def test_lists_are_left_early():
    """Where one component tells the near rows, the threshold falls before the lists end; the rows are right."""
    rng = np.random.default_rng(5)
    rows = np.floor(rng.normal(size=(4000, 6)) * [300, 8, 8, 8, 8, 8])
    block = negatives.Block(np.arange(4000), np.zeros(4000, int), rows)
    for anchor in np.floor(rng.normal(size=(10, 6)) * [300, 8, 8, 8, 8, 8]):
        (best,), score, depth = block.search(anchor, np.ones(4000, bool), [(-np.inf, np.inf)], 5)
        every = rows @ anchor
        assert depth < 4000 and best.tolist() == np.argsort(-every, kind="stable")[:5].tolist()
    zero = block.search(np.zeros(6), np.ones(4000, bool), [(-np.inf, np.inf)], 5)
    assert zero[0][0].tolist() == [0, 1, 2, 3, 4]
