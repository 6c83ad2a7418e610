"""Ranked search against a plain count of everything."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from agrolume.llm import lexical

DOCS = "doc_id long, text string, score long, item string, n int"
ITEMS = "item_id long, text string, rank int, terms string"
WORD = re.compile(lexical.TERM)


def terms(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    total, words = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * total // words
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, "x", 2) for r in docs], DOCS)
    q = spark.createDataFrame([(*r, 1, "x") for r in items], ITEMS)
    return sorted((tuple(r) for r in lexical.search(d, q).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(dice, n):
    words = [f"w{i}" for i in range(60)] + ["É", "ÀB", "x9", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(dice.choices(words, weights, k=dice.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("postings,short", [(1_000_000, 256), (300, 3), (4_000, 1)])
def test_against_brute_force(spark, monkeypatch, postings, short):
    monkeypatch.setattr(lexical, "POSTINGS", postings)
    monkeypatch.setattr(lexical, "SHORT", short)
    dice = random.Random(8)
    docs = corpus(dice, 700) + [(1000 + i, "w0 W1 hot, hot! copy") for i in range(400)]
    items = [(i, t) for i, (_, t) in enumerate(corpus(dice, 30))] + [(100, "hot COPY w3"), (101, "nowhere"), (102, None), (103, " .,"), (104, "w0")]
    assert found(spark, docs, items) == brute(docs, items)


def test_blocks_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical, "LISTED", 50)
    dice = random.Random(9)
    docs = corpus(dice, 200)
    items = [(i, t) for i, (_, t) in enumerate(corpus(dice, 30))]
    assert found(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    docs = [(None, "a b"), (1, None), (2, ""), (3, "--- \u00a0"), (4, "A\x00b"), (5, "a b"), (5, "a b"), (6, "É é " + "z " * 300_000), (7, "c")]
    items = [(1, "a B"), (1, "c"), (None, "é"), (2, "É z"), (3, "\u00a0")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, [(1, "q")], [(1, "r")]) == []


def test_highest():
    dice = np.random.default_rng(10)
    sizes = dice.integers(1, 9, 50)
    doc_terms = np.concatenate([dice.choice(12, n, replace=False) for n in sizes])
    part = lexical.Part(sizes, doc_terms, dice.integers(1, 9, len(doc_terms)), dice.integers(10, 200, 50))
    starts = np.searchsorted(part.keys // part.docs, np.arange(len(part.terms)))
    for t, (a, b) in enumerate(zip(starts, [*starts[1:], len(part.keys)])):
        for low in range(a, b):
            for high in range(low, b + 1):
                top, place = part.highest(np.array([low]), np.array([high]))
                assert top[0] == max(part.impact[low:high], default=0)
                assert high == low or (low <= place[0] < high and part.impact[place[0]] == top[0])
