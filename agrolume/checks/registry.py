"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None, name: str | None = None):
    """Register a query, with its SQL if there is one."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn

    return add


class Tables:
    """The Parquet tables of one folder, opened on demand and once per session."""

    _opened: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        opened = self._opened.setdefault(self.spark, {})
        path = f"{self.folder}/{name}.parquet"
        if path not in opened:
            opened[path] = self.spark.read.parquet(path)
        return opened[path]
