"""Numbers out of text.  ANSI mode stays on: every cast is a ``try_cast``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume.functions.text import as_col, strip

# What counts as a number; Spark alone would also take ``1d`` or ``1f``.
NUMBER = r"^\s*[+-]?(?:\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|(?i:inf(?:inity)?))\s*$"


def parse_number(c: str | Column) -> Column:
    """Double, or null for anything that is not a plain number."""
    text = as_col(c).cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_number(c: str | Column, decimal_comma: bool = False) -> Column:
    """Null on failure (also ``...`` and ``-``)."""
    c = as_col(c)
    return parse_number(F.translate(c, ",", ".") if decimal_comma else c)


def to_number_or_zero(c: str | Column, decimal_comma: bool = False) -> Column:
    """Zero on failure and for null."""
    return F.coalesce(to_number(c, decimal_comma), F.lit(0.0))


def to_int_or_zero(c: str | Column) -> Column:
    return F.coalesce(parse_number(c).try_cast("bigint"), F.lit(0)).try_cast("int")


def int_coerce(c: str | Column, kind: str = "bigint") -> Column:
    """Text or number to integer, truncating toward zero; failure and infinity give null."""
    return parse_number(c).try_cast(kind)


def crop_year_start(c: str | Column) -> Column:
    """``2023/24`` gives 2023; null when there is no leading year."""
    return strip(F.get(F.split(as_col(c), "/"), F.lit(0))).try_cast("int")


def nonzero(c: str | Column) -> Column:
    """Zero counts as missing."""
    return F.nullif(as_col(c), F.lit(0.0))
