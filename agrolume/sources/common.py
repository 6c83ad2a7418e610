"""Steps shared by the source jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.operators.table import StoredTable
from agrolume.schema import TABLES


def open_tables(spark: SparkSession, root: str) -> dict[str, StoredTable]:
    """All stored tables below one folder."""
    return {name: StoredTable(spark, f"{root.rstrip('/')}/{name}", t) for name, t in TABLES.items()}


def rename_existing(df: DataFrame, renames: dict[str, str], only: bool = False) -> DataFrame:
    """Rename the columns that are there.  Two spellings of one target are
    coalesced.  With ``only`` columns outside the map (but ``_seq``) are dropped."""
    sources: dict[str, list[str]] = {}
    for old, new in renames.items():
        if old in df.columns:
            sources.setdefault(new, []).append(old)
    used = {o for olds in sources.values() for o in olds}
    others = [c for c in df.columns if c not in used and c not in sources and (not only or c == "_seq")]
    return df.select(
        *[F.coalesce(*[F.col(f"`{o}`") for o in olds]).alias(new) for new, olds in sources.items()],
        *[F.col(f"`{c}`") for c in others],
    )


def select_existing(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[n for n in [*names, "_seq"] if n in df.columns])


def replace_columns(df: DataFrame, **changes) -> DataFrame:
    """``withColumns`` for those columns that are there."""
    return df.withColumns({n: c for n, c in changes.items() if n in df.columns})


def write_bronze(raw: DataFrame, path: str) -> None:
    """Keep raw rows, with their place in the files, as Parquet: later runs then read
    only the columns they use and never parse the text again."""
    raw.write.parquet(path)
