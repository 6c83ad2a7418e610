"""What the questions share.

Joins here carry no hints.  A stored dimension is a plain Parquet scan whose size
Spark knows: it is broadcast below ``spark.sql.autoBroadcastJoinThreshold``, and
facts then only shuffle as partial sums; a larger one is sort-merged, with
adaptive splitting of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

Star = Mapping[str, DataFrame]


class StoredStar(Mapping):
    """The state of stored tables at one moment; a table is listed when it is asked for."""

    def __init__(self, tables: Mapping, parts: Mapping[str, list] | None = None):
        self._tables = dict(tables)
        self._commits = {name: table.commit() for name, table in self._tables.items()}
        self._parts = dict(parts or {})
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self._tables[name].as_of(self._commits[name], self._parts.get(name))
        return self._read[name]

    def within(self, name: str, values: list) -> DataFrame:
        """A table, of which only the storage partitions of ``values`` are listed."""
        given = self._parts.get(name)
        return self._tables[name].as_of(self._commits[name], values if given is None else [v for v in values if v in given])

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def star(tables: Mapping, parts: Mapping[str, list] | None = None) -> StoredStar:
    """The latest state of every stored table.

    Questions about one year or crop list the storage partitions they need and no
    others.  ``parts`` narrows the rest by hand: with ``{"fato_meteorologia": [2024]}``
    no other year is even listed.
    """
    return StoredStar(tables, parts)


def within(t: Star, name: str, values: list) -> DataFrame:
    """Table ``name`` of which rows of some partition values are asked; the caller still
    filters.  Of plain DataFrames nothing can be left out beforehand."""
    return t.within(name, values) if isinstance(t, StoredStar) else t[name]


def years(start: date, end: date) -> list[int]:
    """The years of the days from ``start`` to ``end``, both included."""
    return list(range(start.year, end.year + 1))


def one(df: DataFrame, what: str) -> Row:
    """The single row of a point lookup, as constants for the fact filters, which
    then reach the Parquet scan.  Raises LookupError when there is none."""
    rows = df.limit(1).collect()
    if not rows:
        raise LookupError(f"{what} não encontrado(a).")
    return rows[0]


def find_cultura(t: Star, nome: str) -> Row:
    return one(t["dim_cultura"].where(F.col("nome_padronizado") == nome.lower()), f"Cultura '{nome}'")


def find_municipio(t: Star, codigo_ibge: str) -> Row:
    return one(t["dim_municipio"].where(F.col("codigo_ibge") == codigo_ibge), f"Município {codigo_ibge}")


def crops(t: Star) -> DataFrame:
    return t["dim_cultura"].select("id_cultura", F.col("nome_padronizado").alias("cultura"))


def places(t: Star) -> DataFrame:
    return t["dim_municipio"].select("id_municipio", F.col("nome").alias("municipio"), "uf")
