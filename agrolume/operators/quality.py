"""Constraint checks, data-quality counts, freshness of input files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from agrolume.schema import TABLES, Table

# Days after which an input file is stale.
FRESH_DAYS = 30
FRESH_DAYS_WEEKLY_PRICES = 7
FRESH_DAYS_SEEDS = 15


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def missing_references(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-null key is not in the dimension."""
    return fact.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def column_violations(df: DataFrame, table: Table) -> DataFrame:
    """(check, column, n): nulls in required columns, texts over their length."""
    checks = [("not_null", c, F.count_if(F.col(c).isNull())) for c in table.required]
    checks += [("max_length", c, F.count_if(F.length(c) > n)) for c, n in table.max_length.items()]
    return _as_rows(df, [(F.lit(k), F.lit(c), n) for k, c, n in checks], ("check", "column", "n"))


#: Why a row is turned away, as ``check:column``; empty for a row that fits.
REASONS = "reasons"


def violations(df: DataFrame, table: Table, references: Mapping[str, DataFrame]) -> DataFrame:
    """``df`` with ``reasons``: nulls in required columns, texts over their length, and
    keys that are not in the given dimensions.  Rows stay as many as they are."""
    wrong = [F.when(F.col(c).isNull(), f"not_null:{c}") for c in table.required]
    wrong += [F.when(F.length(c) > n, f"max_length:{c}") for c, n in table.max_length.items()]
    marks = []
    for name in table.references:
        if name not in references:
            continue
        key = TABLES[name].pk
        mark, known = f"_in_{name}", F.col(f"_{name}")
        dim = references[name].select(F.col(key).alias(f"_{name}")).distinct().withColumn(mark, F.lit(True))
        df = df.join(dim, F.col(key) == known, "left").drop(f"_{name}")
        wrong.append(F.when(F.col(key).isNotNull() & F.col(mark).isNull(), f"reference:{key}"))
        marks.append(mark)
    reasons = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    return df.withColumn(REASONS, reasons).drop(*marks)


class Observed:
    """Counts that come with a write: ``watch`` a DataFrame, run its action, read ``rows``.

    The aggregates are taken as the rows go by (``DataFrame.observe``), so nothing is
    read again.  Distinct counts can't be taken so.
    """

    def __init__(self, spark: SparkSession, source: str):
        self.spark, self.source = spark, source
        self._watched: list[Observation] = []

    def watch(self, df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        seen = Observation()
        self._watched.append(seen)
        return df.observe(seen, *[expr.cast("bigint").alias(name) for name, expr in metrics.items()])

    def values(self) -> dict[str, int]:
        """Metric to value; waits for the action."""
        return {name: value for seen in self._watched for name, value in seen.get.items()}

    def rows(self) -> DataFrame:
        """(source, metric, value) as ``dq_metrics`` gives them."""
        found = [(self.source, name, value) for name, value in self.values().items()]
        return self.spark.createDataFrame(found, "source string, metric string, value bigint")


def dq_metrics(df: DataFrame, source: str, metrics: dict[str, Column]) -> DataFrame:
    """(source, metric, value) rows from aggregate expressions, in a single pass."""
    rows = [(F.lit(source), F.lit(name), expr) for name, expr in metrics.items()]
    return _as_rows(df, rows, ("source", "metric", "value"))


def _as_rows(df: DataFrame, rows, names) -> DataFrame:
    if not rows:
        return df.sparkSession.createDataFrame([], f"{names[0]} string, {names[1]} string, {names[2]} bigint")
    one = df.agg(*[expr.cast("bigint").alias(f"m{i}") for i, (_, _, expr) in enumerate(rows)])
    items = [
        F.struct(a.alias(names[0]), b.alias(names[1]), F.col(f"m{i}").alias(names[2]))
        for i, (a, b, _) in enumerate(rows)
    ]
    return one.select(F.inline(F.array(*items)))


def null_count(c: str) -> Column:
    return F.count_if(F.col(f"`{c}`").isNull())


def newly_null(before: str, after: str) -> Column:
    """Values that parsing turned into null."""
    return F.count_if(F.col(f"`{before}`").isNotNull() & F.col(f"`{after}`").isNull())


def load_totals(loads: dict[str, DataFrame]) -> DataFrame:
    """Rows per dataset and, as ``total``, their sum."""
    counts = None
    for name, df in loads.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts.rollup("dataset").agg(F.sum("rows").alias("rows")).fillna({"dataset": "total"})


def fresh_files(spark: SparkSession, path: str | list[str], days: int = FRESH_DAYS, now: datetime | None = None) -> DataFrame:
    """(path, modified, fresh) per file; reads the listing only, never contents.

    A path that is not there is no stale file: it comes with a null ``modified`` and
    counts as fresh.
    """
    paths = [path] if isinstance(path, str) else path
    jpaths = {p: spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths}
    absent = [p for p, j in jpaths.items() if not j.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(j)]
    out = spark.createDataFrame([(p, None, True) for p in absent], "path string, modified timestamp, fresh boolean")
    there = [p for p in paths if p not in absent]
    if there:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there)
        clock = F.lit(now).cast("timestamp") if now else F.current_timestamp()
        age = clock - F.expr(f"interval {days} days")
        found = files.select("path", F.col("modificationTime").alias("modified"), (F.col("modificationTime") >= age).alias("fresh"))
        out = found.union(out) if absent else found
    return out
