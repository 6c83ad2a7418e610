"""Hard negatives against brute force, on many shards and odd rows."""

import math
import random

import numpy as np
import pytest
from agrolume.llm import hard_negatives, topk, vectors
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, place int"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def clean(rows):
    good = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if i is not None and y is not None and v and None not in v and all(map(math.isfinite, v))]
    return [(i, [min(max(x, -(2**63)), 2**63 - 1) for x in v], y) for i, v, y in good]


def brute(rows, positives=5, negatives=10):
    rows = clean(rows)
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in sorted({r[0] for r in rows if r[0] % 100 == 0}):
        _, v, y = min((r for r in rows if r[0] == a), key=lambda r: (r[2], r[1]))
        scored = sorted((-product(v, w), i, z) for i, w, z in rows if i != a and len(w) == len(v))
        for s, p, _ in [r for r in scored if r[2] == y][:positives]:
            inside = [(-n, i) for n, i, z in scored if z != y and 30 * -s <= 100 * -n <= 90 * -s][:negatives]
            out += [(a, p, rank, i, -s, n) for rank, (n, i) in enumerate(inside, 1)]
    return sorted(out)


def mined(df):
    rows = hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in rows)


def test_shards_ties_and_windows(spark, monkeypatch):
    for name, value in (("SHARD_BYTES", 4 * 8 * 40), ("WAVE", 3)):
        monkeypatch.setattr(vectors, name, value)
    monkeypatch.setattr(hard_negatives, "PAGE", 4)
    dice = random.Random(3)
    rows = [(i, [float(dice.randint(-2, 3)) for _ in range(4)], dice.choice([0, 0, 0, 1, 2, 7])) for i in range(900)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 1.0], i % 2) for i in range(300)]  # one vector very often
    assert mined(make(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, [1.0, 1.0], 1), (100, None, 1), (200, [], 1), (300, [1.0, None], 1), (400, [float("nan"), 1.0], 1), (500, [float("inf"), 1.0], 1), (600, [1.0, 1.0], None),
        (700, [1.0, 1.0], 1), (1, [2.0, 2.0], 1), (2, [1.0, 1.0], 2), (3, [1.0, 1.0], 3), (4, [0.0, 0.0], 2), (5, [-1.0, 0.0], 1), (5, [-1.0, 0.0], 1),
        (800, [0.0, 0.0], 1), (900, [1.0, 2.0, 3.0], 1), (6, [1.0, 2.0, 3.0], 1), (7, [0.5, 1.0, 1.5], 2), (0, [3.0, 0.0], 9), (1000, [1.0, 0.0], 4), (1000, [1.0, 1.0], 3),
    ]
    assert mined(make(spark, rows)) == brute(rows) != []
    assert mined(make(spark, rows).limit(0)) == []


def test_large_components_are_exact(spark):
    dice = random.Random(4)
    rows = [(i * 50, [float(dice.randint(2 * 10**6, 5 * 10**6)) + dice.randint(0, 255) / 256 for _ in range(3)], i % 3) for i in range(60)]
    assert max(abs(s) for *_, s, _ in brute(rows)) > 2**53
    assert mined(make(spark, rows)) == brute(rows)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(make(spark, rows), F.col("vec_id") % 50 == 0, 5).collect()}
    whole = clean(rows)
    for q, v, _ in whole:
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w, _ in whole if i != q)[:5]
        assert [got[q, n + 1] for n in range(5)] == [(i, -s) for s, i in best]


def test_beyond_64_bits(spark):
    rows = [(100, [1e12, 1.0], 1), (1, [1e12, 2.0], 1), (2, [7e11, 0.0], 2), (3, [1e300, 0.0], 3), (4, [1e13, 0.0], 1)]
    top = 2**63 - 1
    got = topk.top_k(make(spark, rows), F.col("vec_id") % 50 == 0, 5).orderBy("rank").collect()
    assert {r.score for r in got} == {top} and {r.vec_id for r in got} == {1, 2, 3, 4}
    assert mined(make(spark, rows)) == []  # the window of a score of 2**63 - 1 holds none of these


def test_boxes_hold_their_rows():
    dice = np.random.default_rng(5)
    points, labels = dice.integers(-9, 9, (500, 6)), dice.integers(0, 40, 500)
    tree = hard_negatives.RTree(points, np.arange(500), labels, page=8, fanout=3)
    assert sorted(tree.ids) == list(range(500))
    for query in dice.integers(-9, 9, (5, 6)):
        low, high = tree.intervals(query.astype(float), 1.0)
        for node, (a, b) in enumerate(tree.ranges):
            scores = tree.points[a:b] @ query
            assert low[node] <= scores.min() and scores.max() <= high[node]
            assert set(range(a, b)) == set().union(*(range(*tree.ranges[c]) for c in tree.children[node])) or not tree.children[node]


@pytest.mark.parametrize("rows", [[], [(100, [1.0], 1)], [(100, [1.0], 1), (1, [1.0], 2)]])
def test_small(spark, rows):
    assert mined(make(spark, rows)) == []
