"""Dates.  Stored values have no zone, so nothing passes through one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume.functions.text import as_col, strip

DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
ISO = r"^\d{4}-\d{1,2}-\d{1,2}"


def parse_date(c: str | Column) -> Column:
    """Day-first or ISO text to timestamp_ntz; impossible dates give null."""
    text = strip(c)
    iso = F.regexp_replace(text, DAY_FIRST, "$3-$2-$1")
    return F.when(iso.rlike(ISO), iso.try_cast("timestamp_ntz"))


def year_of(c: str | Column) -> Column:
    return F.year(as_col(c))


def day(c: str | Column) -> Column:
    return as_col(c).cast("date")


def month_label(ano: str | Column, mes: str | Column) -> Column:
    """``YYYY-MM``."""
    return F.concat(as_col(ano).cast("string"), F.lit("-"), F.lpad(as_col(mes).cast("string"), 2, "0"))
