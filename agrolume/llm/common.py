"""What the operators share: tables, stored intermediate results, running sums."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrolume.session import scratch_dir

#: A word: a run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    This cuts the lineage at files that outlive a lost executor.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a task holds what it makes of few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` itself does that for pure ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def bucket_of(key: Column, buckets: int) -> Column:
    """crc32 of the key as text, modulo ``buckets``; a null key counts as ''."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], by: Column | None = None) -> DataFrame:
    """``df`` with inclusive running sums in ``order``, within the groups of ``by``.

    The rows are dealt by range of (``by``, ``order``), so a group with most of the
    rows spreads over many tasks; what one task has to know of the others is one row
    per range and group.  The dealt rows are stored first, so that ranges stay as they
    are when a task runs again.  ``sums`` names must be new columns.
    """
    lead = [by.asc_nulls_last()] if by is not None else []
    group = by if by is not None else F.lit(0)
    dealt = stored(
        df.withColumns(sums).repartitionByRange(*lead, *order).withColumn("_range", F.spark_partition_id()),
        "running",
    )
    within = Window.partitionBy("_range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_range", group.alias("_group"))
        .agg(*(F.sum(name).alias(f"_{name}") for name in sums))
        .select("_range", "_group", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums))
        .withColumnRenamed("_range", "_at")
    )
    local = dealt.withColumns({name: F.sum(name).over(within) for name in sums})
    joined = local.join(offsets, (F.col("_range") == F.col("_at")) & group.eqNullSafe(F.col("_group")))
    return joined.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop(
        "_range", "_at", "_group", *(f"_{n}" for n in sums)
    )
