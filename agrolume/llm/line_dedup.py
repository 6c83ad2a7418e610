"""Line dedup over levelled sorted runs of line hashes.  DataFrame functions only.

A line's key is the line without white space at its ends, A-Z in lower case.  A key of
``least_chars`` code points or more that ``least_docs`` documents hold stays only in
the largest doc_id holding it.

The documents come in batches, largest doc_ids first.  A batch becomes a run sorted by
hash: one row per key with the number of documents and the largest doc_id.  Before it
is added, a merge anti-join with the runs drops the keys that are settled there (held
by enough documents; as later batches hold smaller ids only, nothing about them can
change).  ``fanout`` runs of one level are compacted into one of the next.  At the end
the lines meet the settled keys in one merge join.

A key is known by 128 bits of hash.  Rows with the same doc_id are one document when
documents are counted, and each row loses its own lines.  A null text is one empty
line; a null doc_id counts as smaller than any other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.llm.common import ascii_lower, stored
from agrolume.session import scratch_dir

LEAST_CHARS, LEAST_DOCS = 20, 3
BATCHES, FANOUT = 6, 3
#: White space that is stripped: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


def line_array(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class Runs:
    """Sorted runs on levels; ``fanout`` runs of a level become one of the next."""

    def __init__(self, spark, folder: str, least_docs: int, fanout: int, id_type: str):
        self.spark, self.folder, self.least, self.fanout = spark, folder, least_docs, fanout
        self.schema = f"h1 long, h2 long, docs long, top {id_type}"
        self.levels: list[list[str]] = []
        self.made = 0

    def read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths)

    def all(self) -> DataFrame | None:
        paths = [p for level in self.levels for p in level]
        return self.read(paths) if paths else None

    def add(self, run: DataFrame, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.made += 1
        path = f"{self.folder}/run-{self.made}-level-{level}"
        run.select("h1", "h2", "docs", "top").sortWithinPartitions(*KEY).write.parquet(path)
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self.add(summed(self.read(merged)), level + 1)

    def settled(self) -> DataFrame | None:
        """Keys that enough documents hold, as far as single runs tell."""
        runs = self.all()
        return None if runs is None else runs.where(F.col("docs") >= self.least).select(*KEY)

    def add_batch(self, lines: DataFrame) -> None:
        """lines: h1, h2, doc of documents that are all smaller than those before."""
        own = lines.groupBy(*KEY, "doc").agg(F.lit(1).alias("one"))
        own = own.groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("doc").alias("top"))
        settled = self.settled()
        if settled is not None:
            own = own.join(settled.hint("merge"), KEY, "left_anti")
        self.add(own)


def summed(runs: DataFrame) -> DataFrame:
    return runs.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))


def dropped_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """doc, row (hash of the text), drops (positions from 0) of rows that lose lines."""
    spark = docs.sparkSession
    cuts = docs.select(F.percentile_approx("doc_id", [1 - i / batches for i in range(1, batches)], 10_000).alias("cuts")).first()[0]
    batch = F.lit(0)
    for cut in cuts or []:  # one number per batch
        batch = batch + F.coalesce(F.col("doc_id") <= cut, F.lit(True)).cast("int")
    lines = docs.select(
        F.col("doc_id").alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), batch.alias("batch"), F.posexplode(line_array(F.col("text"))).alias("at", "line")
    )
    key = F.trim(F.col("line"), F.lit(SPACE))
    keyed = (
        lines.withColumn("key", key)
        .where(F.char_length("key") >= least_chars)
        .withColumn("key", ascii_lower(F.col("key")))
        .select("doc", "row", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "batch")
    )
    folder = scratch_dir(spark, "lines")
    keyed.write.partitionBy("batch").parquet(f"{folder}/lines")
    kept = spark.read.schema(keyed.schema).parquet(f"{folder}/lines")
    runs = Runs(spark, folder, least_docs, fanout, dict(docs.dtypes)["doc_id"])
    for number in range(len(cuts or []) + 1):
        runs.add_batch(kept.where(F.col("batch") == number))
    # Stored first, so that both sides of the join are plain and a hot key can be split.
    settled = stored(summed(runs.all()).where(F.col("docs") >= least_docs), "settled")
    hit = kept.join(settled.hint("merge"), KEY).where(~F.col("doc").eqNullSafe(F.col("top")))
    return hit.groupBy("doc", "row").agg(F.collect_set("at").alias("drops"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """Struct ``doc`` (the row of ``docs``) with n_lines, n_dropped and kept (the text left)."""
    dropped = dropped_lines(docs, **options)
    nested = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc_row"))
    keyed = nested.select(
        "doc_row", F.col("doc_row.doc_id").alias("id"), F.xxhash64(F.coalesce("doc_row.text", F.lit(""))).alias("text_row")
    )
    joined = keyed.join(dropped, F.col("id").eqNullSafe(F.col("doc")) & (F.col("text_row") == F.col("row")), "left")
    lines = line_array(F.col("doc_row.text"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    kept = F.when(F.col("drops").isNull(), F.coalesce("doc_row.text", F.lit(""))).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    )
    return joined.withColumn("lines", lines).select(
        F.col("doc_row").alias("doc"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
