"""Queries beside their SQL, and the two text models on held-out rows."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from agrolume.llm import langid, line_dedup, mixing, toxicity
from agrolume.llm.queries import ORACLE, QUERIES
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, size string, drops int"


def same(df, table):
    columns = sorted(df.columns)
    got = sorted(tuple(repr(r[c]) for c in columns) for r in df.collect())
    names = [d[0] for d in table.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    assert got == sorted(tuple(repr(r[i]) for i in place) for r in table.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    same(QUERIES[name](spark, FOLDER), con.execute(ORACLE[name]))


def test_names():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 14)]


def make(spark, rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)


# ---- mixing


def test_mixing_edges(spark):
    rows = [(i, "w " * (i % 7 + 1), None, "hot") for i in range(3000)]
    rows += [(5000 + i, "w " * 3, None, s) for i, s in enumerate([None, "", "a", "é", "Z"] * 40)]
    rows += [(1, "same row", None, "a"), (1, "same row", None, "a"), (7000, None, None, "nulls"), (None, "x y", None, "a"), (7001, "", None, "nulls")]
    docs = make(spark, rows)
    planned = mixing.plan(docs).collect()
    assert len(planned) == len(rows)
    assert sorted(map(tuple, planned), key=str) == sorted(map(tuple, mixing.plan(docs.repartition(7)).collect()), key=str)
    sizes, targets, taken, largest = Counter(), {}, Counter(), Counter()
    for r in planned:
        sizes[r.source] += r.size
        targets[r.source] = r.target
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.taken <= 3 * r.size
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1e-6
    for s, t in targets.items():
        assert t <= 3 * sizes[s] + 1e-9 and abs(taken[s] - t) <= 3 * largest[s]
    mixed = Counter((r.doc_id, r.text) for r in mixing.mix(docs).collect())
    copies = Counter()
    for r in planned:
        copies[r.doc_id] += r.copies
    assert sum(mixed.values()) == sum(copies.values())
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.plan(docs.limit(0)).count() == mixing.mix(docs.limit(0)).count() == 0


# ---- line dedup


def plain_dedup(rows, chars=20, least=3):
    clean = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(clean(line)) >= chars:
                held.setdefault(clean(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(clean(x), ())) < least or max(held[clean(x)], key=lambda d: (d is not None, d)) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup_edges(spark):
    long = "This line is held by very many documents"
    rows = [(i, f"{long}\nown line number {i} of some length\n\t {long.upper()} \nshort") for i in range(400)]
    rows += [(1000 + i, "Ärger mit Zeilen, die sich wiederholen\r\nx") for i in range(3)] + [(2000 + i, "only two documents hold this line") for i in range(2)]
    rows += [(3000, None), (3001, ""), (3002, "\n\n"), (None, long), (5, "repeated id, other text, same line\n" + long), (6, rows[6][1]), (4000, (long + "\n") * 5000)]
    docs = make(spark, [(i, t, None, None) for i, t in rows])
    got = sorted(((r.doc.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(docs).collect()), key=str)
    assert got == plain_dedup(rows)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_runs_are_compacted(spark):
    rows = [(i, f"line {i % 10} that ten documents hold at least") for i in range(100)]
    docs = make(spark, [(i, t, None, None) for i, t in rows])
    got = sorted(((r.doc.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(docs, batches=9, fanout=2).collect()), key=str)
    assert got == plain_dedup(rows)


# ---- toxicity


def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_toxicity_edges(spark):
    rows = [(i, "you stupid loser, truly " + "word " * (i % 9) if i % 2 else f"nice day {i} " * 5, None, None) for i in range(400)]
    rows += [(1000, None, None, None), (1001, "", None, None), (1002, " ", None, None), (None, "you l0ser", None, None), (1003, "word " * 200_000, None, None), (1, rows[1][1], None, None)]
    docs = make(spark, rows).drop("size").withColumn("x", F.lit(1)).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(1, None), (None, 1), (1, 1)], "doc_id long, toxic int")
    got = toxicity.Toxicity(docs, labels).score(docs).select("doc.doc_id", "score").collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r.score for r in got}
    assert all(0 <= s <= 1 for s in score.values())
    assert min(score[i] for i in range(1, 400, 2)) > 0.5 > max(score[i] for i in range(0, 400, 2))
    few = toxicity.Toxicity(docs, labels.limit(0)).score(docs)
    assert {r.score for r in few.select("score").collect()} == {0.0}
    assert toxicity.Toxicity(docs.limit(0), labels).score(docs.limit(0)).count() == 0


def test_toxicity_scores_mean_the_same_for_a_small_sample(spark):
    kinds = [("you vile rotten scum idiot", 1, 250), ("maybe so!!!! really!!!!", 1, 50), ("maybe so!!!! really!!!!", 0, 200), ("a calm and friendly remark", 0, 2800)]
    rows = [(text, toxic) for text, toxic, n in kinds for _ in range(n)]
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, toxic) for i, (_, toxic) in enumerate(rows)], "doc_id long, toxic int")
    unclear = spark.createDataFrame([(0, kinds[1][0])], "doc_id long, text string")
    for sample in (10_000, 400):
        assert abs(toxicity.Toxicity(docs, labels, sample).score(unclear).first().score - 50 / 250) < 0.1, sample
    absent = spark.createDataFrame([(-i, 1) for i in range(1, 5000)], labels.schema)
    sample = toxicity.sample_of(docs, labels.union(absent), 100).groupBy("toxic").agg(F.sum("weight").alias("n")).collect()
    assert {r.toxic: round(r.n) for r in sample} == {0: 3000, 1: 300}


# ---- language


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op4_langid"](spark, FOLDER).where("held_out").join(docs, "doc_id").where("lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def test_language_edges(spark):
    rows = [(i, "the house and the garden" if i % 2 else "das haus und der garten", "en" if i % 2 else "de", None) for i in range(60)]
    odd = [(100, None, None, None), (101, "", None, None), (102, "12 34 !?", None, None), (103, "The GARDENS", None, None), (104, "gärten häuser", None, None), (None, "und", None, None), (105, "the " * 200_000, None, None), (1, rows[1][1], "en", None)]
    docs = make(spark, rows + odd)
    tables = langid.learn(docs)
    got = {r.doc_id: r for r in langid.identify(docs, tables).select("doc.doc_id", "lang_pred", "score").collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert (got[103].lang_pred, got[104].lang_pred, got[None].lang_pred, got[105].lang_pred) == ("en", "de", "de", "en")
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.learn(docs.where("lang is null"))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), tables).count() == 0
