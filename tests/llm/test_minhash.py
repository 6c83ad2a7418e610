"""Near-duplicates against all pairs in plain Python."""

import re

import pytest
from agrolume.llm.minhash import near_duplicates

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = {}
    for i, s in sets.items():
        for x in s:
            lists.setdefault(x, []).append(i)
    pairs = {(a, b) for v in lists.values() for a in v for b in v if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def test_matches_all_pairs_on_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted(tuple(r) for r in near_duplicates(docs).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_chains_and_small_sets(spark):
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 200])) for i in range(12)]
    rows += [(100, "a b c"), (101, "A  B\tC"), (102, "a b"), (103, ""), (104, " \n"), (105, None), (106, None)]
    rows += [(200 + i, " ".join(words[:60] + [f"x{i}"])) for i in range(90)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")]])
def test_edges(spark, rows):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=str)
    assert got == ([(3, 2, 3, True), (3, 2, 3, True), (None, 2, None, True), (None, 2, None, True)] if rows else [])


def test_exact_lists_all_shingles(spark):
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 200])) for i in range(12)] + [(50 + i, " ".join(words[i : i + 6])) for i in range(4)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    assert sorted(tuple(r) for r in near_duplicates(docs, exact=True).collect()) == brute(rows)
