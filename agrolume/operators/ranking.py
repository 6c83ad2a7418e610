"""Mode, top-k per group, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_mode(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Most frequent non-empty value per group; the lowest one on a tie.

    Counts come first, so a hot group reaches the second step as one row per
    distinct value.
    """
    counts = df.where(F.col(value) != "").groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(alias))


def _first_k(df: DataFrame, keys: Sequence[str], order, k: int) -> DataFrame:
    # Spark cuts each task's groups to k rows before the shuffle (WindowGroupLimit).
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)


def _listed(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    ranked = F.array_sort(F.collect_list(F.struct("_rank", value)))
    return df.groupBy(*keys).agg(F.transform(ranked, lambda x: x[value]).alias(alias))


def top_k_counts(df: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    """The k most frequent non-null values per group: (keys, value, n, _rank)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    return _first_k(counts, keys, [F.desc("n"), F.asc(value)], k)


def top_k_list(df: DataFrame, keys: Sequence[str], value: str, k: int, alias: str) -> DataFrame:
    return _listed(top_k_counts(df, keys, value, k), keys, value, alias)


def distinct_k_list(df: DataFrame, keys: Sequence[str], value: str, k: int, alias: str) -> DataFrame:
    """Up to k distinct values per group in value order, without null and empty ones."""
    firsts = _first_k(df.where(F.col(value) != "").select(*keys, value).distinct(), keys, [F.asc(value)], k)
    return _listed(firsts, keys, value, alias)


def paginate(df: DataFrame, order: Sequence[str], page: int = 1, page_size: int = 20, deep: int = 100_000) -> DataFrame:
    """One page in the order of a unique key; null comes first.

    Sorting for a page keeps all rows before it in each task.  A page that ends beyond
    ``deep`` rows is therefore first narrowed down to the range of keys that holds it,
    which takes two passes over the key columns when it is asked for, seldom four.
    """
    skip = (page - 1) * page_size
    if skip + page_size > deep:
        df, skip = _range_of(df, order, skip, page_size, deep)
    return df.orderBy(*order).offset(skip).limit(page_size)


def _key(df: DataFrame, order: Sequence[str], values: Sequence) -> Column:
    """A key as a constant struct."""
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, values, strict=True)])


def _from_key(df: DataFrame, order: Sequence[str], values: Sequence, beyond: bool = False) -> DataFrame:
    """Rows at or beyond a key.  Its first column by itself can reach the scan."""
    first = F.col(order[0]) >= F.lit(values[0]).cast(df.schema[order[0]].dataType)
    at, key = F.struct(*order), _key(df, order, values)
    rows = df if values[0] is None else df.where(first)
    return rows.where(at > key if beyond else at >= key)


def _before_key(df: DataFrame, order: Sequence[str], values: Sequence) -> DataFrame:
    first = F.col(order[0])
    same = first <= F.lit(values[0]).cast(df.schema[order[0]].dataType)
    low = first.isNull() if values[0] is None else first.isNull() | same
    return df.where(low).where(F.struct(*order) < _key(df, order, values))


def _nth_range(df: DataFrame, order: Sequence[str], bounds: list, start: int = 0) -> Column:
    """Number of bounds at or below a row's key, by halving."""
    if not bounds:
        return F.lit(start)
    mid = len(bounds) // 2
    below = _nth_range(df, order, bounds[:mid], start)
    above = _nth_range(df, order, bounds[mid + 1 :], start + mid + 1)
    return F.when(F.struct(*order) < _key(df, order, bounds[mid]), below).otherwise(above)


def _range_of(df: DataFrame, order: Sequence[str], skip: int, size: int, most: int, ranges: int = 64) -> tuple[DataFrame, int]:
    """The rows of the key ranges that hold the rows ``skip`` to ``skip + size``, and how many of them come before.

    Bounds are keys drawn at random, a bounded number of them; the rows of each range
    are counted exactly, so the draw decides the cost only.  Ranges that hold more than
    ``most`` rows besides the page are narrowed down again.
    """
    while True:
        keys = df.select(*order)
        drawn = keys.withColumn("_draw", F.rand(7)).orderBy("_draw").limit(ranges * 16).drop("_draw")
        drawn = drawn.distinct().orderBy(*order).collect()
        bounds = sorted({round(i * len(drawn) / ranges) for i in range(1, ranges)} - {0, len(drawn)})
        bounds = [tuple(drawn[i]) for i in bounds]
        if not bounds:
            return df, skip
        counted = keys.groupBy(_nth_range(df, order, bounds).alias("_nth")).count().collect()
        counts = dict.fromkeys(range(len(bounds) + 1), 0) | {r["_nth"]: r["count"] for r in counted}
        total, ends = 0, []
        for nth in sorted(counts):
            total += counts[nth]
            ends.append(total)
        if skip >= total:
            return df.limit(0), 0
        first = next(i for i, end in enumerate(ends) if end > skip)
        last = next((i for i, end in enumerate(ends) if end >= skip + size), len(bounds))
        before, held = ends[first] - counts[first], ends[last] - ends[first] + counts[first]
        if first > 0:
            df = _from_key(df, order, bounds[first - 1])
        if last < len(bounds):
            df = _before_key(df, order, bounds[last])
        skip -= before
        if held <= most + size or held == total:
            return df, skip


def page_after(df: DataFrame, order: Sequence[str], after: Sequence | None = None, page_size: int = 20) -> DataFrame:
    """The page that follows a row, given by its values of the unique key ``order``.

    Unlike a page far down by number, no task keeps the pages before it, and the
    condition on the first column reaches the scan.  None starts at the top; null comes first.
    """
    if after is not None:
        df = _from_key(df, order, after, beyond=True)
    return df.orderBy(*order).limit(page_size)


def page_envelope(df: DataFrame, page: int = 1, page_size: int = 20) -> DataFrame:
    """Total rows and pages beside a page."""
    pages = F.ceil(F.col("total") / page_size) if page_size > 0 else F.lit(0)
    return df.agg(F.count("*").alias("total")).select(
        "total",
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        pages.cast("bigint").alias("total_pages"),
    )
