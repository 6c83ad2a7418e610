"""Searches against brute force."""

import numpy as np
import pytest
from agrolume.llm import ann, topk, vectors
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, score int"


def make(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA)


def test_ann_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in ann.Index(df, 20).search(F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = (r.rank, r.score)
    rows = df.collect()
    ids, m = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        s = m @ m[ids == q][0]
        s[ids == q] = -np.inf
        true = ids[np.lexsort((ids, -s))[:20]]
        assert len(got[q]) == 20
        assert sorted(r for r, _ in got[q].values()) == list(range(1, 21))
        assert all(abs(s[ids == i][0] - x) < 1e-12 for i, (_, x) in got[q].items())
        hits += len(set(true) & set(got[q]))
        total += 20
    assert hits / total >= 0.9


def test_hot_vector_and_odd_rows(spark):
    random = np.random.default_rng(1)
    hot = [1.0, 2.0, 3.0]
    rows = [(i, hot if i % 3 == 0 else random.normal(size=3).tolist()) for i in range(300)]
    rows += [(400, None), (420, [float("nan"), 1.0, 1.0]), (440, [None, 1.0, 1.0]), (460, [0.0, 0.0, 0.0]), (480, [float("inf"), 0.0, 0.0]), (500, []), (None, hot)]
    df = make(spark, rows)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.Index(df, 20).search(F.col("vec_id") % 20 == 0).collect()}
    exact = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()}
    assert {q for q, _ in got} == set(range(0, 300, 20))
    assert [got[0, i][0] for i in range(1, 21)] == [3 * i for i in range(1, 21)]  # ties to the smaller id
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in good if i != q)[:5]
            assert [exact[q, n + 1] for n in range(5)] == [(i, -s) for s, i in best]
    assert {q for q, _ in exact} == {q for q, _ in good if q % 50 == 0}


def test_many_shards(spark, monkeypatch):
    for name, value in (("SHARD_BYTES", 64 * 4 * 8), ("WAVE", 8)):
        monkeypatch.setattr(vectors, name, value)
    monkeypatch.setattr(topk, "LEAF", 4)
    monkeypatch.setattr(ann, "ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(ann, "QUERIES_PER_BLOCK", 4)
    random = np.random.default_rng(2)
    rows = [(i, random.integers(-2, 3, size=4).astype(float).tolist()) for i in range(1000)]
    df = make(spark, rows)
    exact = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()}
    m = np.array([v for _, v in rows])
    for q in range(0, 1000, 50):
        s = 65536 * (m @ m[q])
        best = sorted((-int(s[i]), i) for i in range(1000) if i != q)[:5]
        assert [exact[q, n + 1] for n in range(5)] == [(i, -x) for x, i in best]
    assert ann.Index(df, 20).search(F.col("vec_id") % 20 == 0).count() >= 980


@pytest.mark.parametrize("rows", [[], [(20, [1.0])], [(100, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None)]])
def test_small_tables(spark, rows):
    df = make(spark, rows)
    expected = [(100, 1, 1, 2.0)] if len(rows) == 3 else []
    assert [tuple(r) for r in ann.Index(df, 20).search(F.col("vec_id") % 20 == 0).collect()] == expected
    assert [(r.query_id, r.rank, r.vec_id) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()] == [e[:3] for e in expected]


def test_every_length_is_searched(spark):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=4).tolist()) for i in range(1, 200)] + [(200 + 20 * i, [float(i), 1.0]) for i in range(3)] + [(400 + i, random.normal(size=64).tolist()) for i in range(100)]
    got = {}
    for r in ann.Index(make(spark, rows), 20).search(F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert {q: len(v) for q, v in got.items()} == {i: min(20, sum(len(w) == len(v) for _, w in rows) - 1) for i, v in rows if i % 20 == 0}
    assert sorted(got[240]) == [(1, 220), (2, 200)]


def test_small_leaves_are_filled_up(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 2)
    rows = [(i, [float(np.cos(i)), float(np.sin(i))]) for i in range(400)]
    got = ann.Index(make(spark, rows), 20).search(F.col("vec_id") % 20 == 0, visits=1).groupBy("query_id").count().collect()
    assert len(got) == 20 and {r["count"] for r in got} == {20}


def test_tree_grows_with_the_table(spark):
    random = np.random.default_rng(5)
    middles = random.normal(size=(60, 8))
    points = middles[random.integers(0, 60, 6000)] + 0.4 * random.normal(size=(6000, 8))
    points[random.permutation(6000)[:1500]] = points[1]  # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(points)] + [(10_000 + i, random.normal(size=3).tolist()) for i in range(500)]
    df = make(spark, rows)
    plain, grown = ann.Index(df, 20, sample_size=400), ann.Index(df, 20, sample_size=400, rows_per_leaf=32)
    assert grown.trees[8].leaves > 3 * plain.trees[8].leaves and grown.trees[3].leaves > 1
    for dim, tree in grown.trees.items():
        assert sorted(leaf for leaf in tree.leaf if leaf >= 0) == list(range(tree.leaves))
        assert sorted(tree.visits(np.ones(dim), tree.leaves)) == list(range(tree.leaves))
        assert len(tree.centres) == len(tree.children) == len(tree.leaf)
        assert sorted(c for children in tree.children for c in children) == list(range(1, len(tree.leaf)))
    assert sum(grown.sizes.values()) == 6500 and sorted(grown.sizes.values())[-2] < sorted(plain.sizes.values())[-2]
    m = np.array([v for _, v in rows[:6000]], np.float32).astype(float)
    truth = {}
    for q in range(0, 6000, 20):
        s = ann.exact_scores(m, m[q])
        s[q] = -np.inf
        truth[q] = np.lexsort((np.arange(6000), -s))[:20].tolist()
    for visits, least in ((grown.trees[8].leaves, 1.0), (None, 0.9)):
        got = {}
        for r in grown.search(F.col("vec_id") % 20 == 0, visits=visits).where("query_id < 6000").orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert sum(len(set(truth[q]) & set(got[q])) for q in truth) >= least * 20 * len(truth)
        if least == 1.0:
            assert got == truth
