"""Keep one row per key.

Written as an aggregate, so every map task first reduces a key to one row: a key
that holds a third of the table costs one row per task in the shuffle.
Null keys count as equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEQ = "_seq"


def file_order() -> Column:
    """Position of a row in its files.  Use right after reading: the row number
    alone does not follow the file when splits are packed together."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _order(order: Sequence[str | Column] | None) -> Column:
    if order is None:
        order = [SEQ]
    return F.struct(*[F.col(f"`{o}`") if isinstance(o, str) else o for o in order])


def _keep(df: DataFrame, keys: Sequence[str], order, pick, least) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if order is None and SEQ not in df.columns:
        # By all columns; those besides the keys are compared and kept as one struct.
        kept = least(F.struct(*[F.col(f"`{c}`") for c in sorted(rest)]))
    else:
        kept = pick(F.struct(*[F.col(f"`{c}`") for c in rest]), _order(order))
    grouped = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(kept.alias("_kept"))
    return grouped.select(
        *[F.col(f"`{c}`") if c in keys else F.col("_kept").getField(c).alias(c) for c in df.columns]
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """First row per key in file order (``_seq``), or in the given order."""
    return _keep(df, keys, order, F.min_by, F.min)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """Last row per key in file order (``_seq``), or in the given order."""
    return _keep(df, keys, order, F.max_by, F.max)
