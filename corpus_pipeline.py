"""Documents through five stages: toxicity, line dedup, near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.  All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm import bpe, line_dedup, minhash, mixing
from agrolume.llm.common import stored, table
from agrolume.llm.queries import RANKS, toxic_scores

#: Documents with this score or more are rejected.
TOXIC = 0.3


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go; the model learns from the labels beside the documents."""
    model = toxic_scores(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    scored = model.score(docs.select("doc_id", "text", key.alias("key")))
    toxic = scored.where(F.col("score") >= TOXIC).select(F.col("doc.doc_id").alias("id"), "doc.key").distinct()
    toxic = stored(toxic, "toxic")  # the texts themselves need not pass through Python and back
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce("doc.text", F.lit(""))) == F.col("key"))
    return rows.join(toxic, same, "left_anti").select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in one of them only."""
    cleaned = line_dedup.dedup_lines(docs)
    columns = [
        F.col("kept").alias("text") if c == "text" else F.char_length("kept").cast("long").alias(c) if c == "n_chars" else F.col(f"doc.`{c}`").alias(c)
        for c in docs.columns
    ]
    return cleaned.select(*columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; rows that repeat one entirely go too."""
    gone = stored(minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct(), "gone")
    repeated = stored(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    once = left.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    again = left.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return once.union(again)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the weight of its source takes it."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and the digest of the bytes that the ids decode to."""
    import public_tokenizers

    path = public_tokenizers.path(RANKS)
    # Stored in between, so that an executor has the workers of one of the two at a time.
    encoded = stored(bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN), "ids")
    both = bpe.decode(encoded, path)
    return both.select("doc.*", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", civil), ("line dedup", lines), ("near-dedup", distinct), ("mixing", mixed), ("tokens", tokens)]
#: The first stage is a learned model and the last one follows a rank file: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
