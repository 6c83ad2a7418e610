"""Every stage on its own input against SQL, all pairs or tiktoken."""

import hashlib

import corpus_pipeline as pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken
from agrolume.llm import bpe
from agrolume.llm.queries import ORACLE, RANKS
from test_minhash import brute

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of each stage, as files."""
    base = tmp_path_factory.mktemp("stages")
    paths = [f"{FOLDER}/documents.parquet"]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        paths.append(str(base / f"{i}.parquet"))
        stage(spark, spark.read.parquet(paths[-2]), FOLDER).write.parquet(paths[-1])
    return [spark.read.parquet(p) for p in paths], paths


def sql(name, path):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    return con.execute(ORACLE[name]).df()


def test_columns_stay(steps):
    frames, _ = steps
    for df in frames[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    frames, _ = steps
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = ({r.doc_id for r in df.select("doc_id").collect()} for df in frames[:2])
    clean = [i for i in before if labels.get(i) == 0]
    toxic = [i for i in before if labels.get(i) == 1]
    assert sum(i in after for i in clean) >= 0.95 * len(clean)
    assert sum(i in after for i in toxic) <= 0.5 * len(toxic)


def test_lines(steps):
    frames, paths = steps
    kept = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in frames[2].collect()}
    want = sql("op9_line_dedup", paths[1])
    assert kept == dict(zip(want["doc_id"], want["kept_sha256"]))


def test_near_copies(steps):
    frames, _ = steps
    rows = [(r.doc_id, r.text) for r in frames[2].select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in frames[3].collect()) == [i for i, _, _, kept in brute(rows) if kept]


def test_mixing(steps):
    frames, paths = steps
    want = sql("op6_mixing", paths[3])
    copies = {r.doc_id: r["count"] for r in frames[4].groupBy("doc_id").count().collect()}
    for r in want.itertuples():
        assert r.size == 0 or copies.get(r.doc_id, 0) * r.size == r.taken


def test_tokens(steps):
    frames, _ = steps
    path = public_tokenizers.path(RANKS)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = {r.doc_id: r.text for r in frames[4].collect()}
    rows = frames[5].collect()
    assert len(rows) == frames[4].count()
    for r in rows:
        assert r.ids == known.encode_ordinary(texts[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string"
    rows = [(1, None, None, None, None, "x"), (None, "a b", "en", "s", 3, None), (2, "", "en", "s", 0, None), (3, "a b c d e f", None, "s", 11, "y"), (3, "a b c d e f", None, "s", 11, "y")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "size"], name
        got = pipeline.tokens(spark, docs, FOLDER)
        assert sum(r.doc_id == 3 for r in got.collect()) in ((1, 2, 3) if data else (0,))


def test_encoding_and_decoding_do_not_share_a_stage(spark):
    docs = spark.createDataFrame([(1, "some text", "en", "a", 9), (2, None, None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.tokens(spark, docs, "")
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: (r.n_tokens > 0) for r in got.collect()} == {1: True, 2: False}
