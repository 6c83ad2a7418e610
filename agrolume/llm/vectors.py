"""What the vector searches share: clean vectors, exact scores, trees kept per shard, merging of partial answers."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrolume.llm.common import sliced, stored

#: Components of a shard take about so many bytes; so many queries meet one copy of its tree.
SHARD_BYTES, WAVE = 8 << 20, 65_536
#: One shard in so many goes first.
FIRST = 8
LEAST = -(2**63)


def usable(vector: Column) -> Column:
    """Not null, not empty, no null, NaN or infinite component."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~wrong


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= floor)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def nearest(partial: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of the partial answers of each query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def quantised(vector: Column, steps: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(steps * x.cast("double")))


def integers(column: pa.Array) -> np.ndarray:
    """A list column of whole numbers, all of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def largest(points: np.ndarray) -> np.ndarray:
    """The largest absolute value of each coordinate; as floats, which hold 2**63 too."""
    return np.abs(points.astype(np.float64)).max(axis=0)


def exact_products(points: np.ndarray, query: np.ndarray, reach: float) -> np.ndarray:
    """Inner products of whole numbers without rounding; no sum of absolute terms exceeds ``reach``.

    Within 64 bits the result is an array of integers, beyond it one of Python's.
    """
    if reach < 2**52:
        return (points.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if reach < 2**62:
        return (points * query).sum(axis=1)
    return points.astype(object) @ query.astype(object)


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; beyond their range stands the nearest one."""
    return np.array([min(max(int(s), LEAST), 2**63 - 1) for s in scores], np.int64) if scores.dtype == object else scores


class Shards:
    """The rows of a table (v array<long>, and others) dealt to shards, with one kept tree for each.

    ``build`` makes a tree from the rows of one shard and one length of vectors.  A row
    is dealt by a number of its own, so rows that repeat spread too.
    """

    def __init__(self, rows: DataFrame, build: Callable[[pa.Table], object], purpose: str):
        self.rows = stored(rows.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id())), purpose)
        size = self.rows.agg(F.coalesce(F.sum(F.size("v")), F.lit(0))).first()[0]
        self.count = max(1, -(-size * 8 // SHARD_BYTES))
        self.first = -(-self.count // FIRST)

        def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            tree = pickle.dumps(build(table.combine_chunks()), protocol=5)
            return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()), "tree": pa.array([tree], pa.binary())})

        dealt = self.rows.withColumns({"dim": F.size("v"), "shard": F.pmod("_deal", F.lit(self.count)).cast("int")}).drop("_deal")
        self.trees = stored(dealt.groupBy("dim", "shard").applyInArrow(one, "dim int, shard int, tree binary"), f"{purpose}-trees")

    def ask(self, queries: DataFrame, number: int, shards: range, search: Callable[[object, pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
        """What ``search`` finds for ``number`` queries (q array<long>, and others) in each of the ``shards``.

        A tree streams into a task before the queries that it answers, so a task holds one
        tree and one batch of queries at a time.
        """
        waves = max(1, -(-number // WAVE))
        every = lambda low, high: F.explode(F.sequence(F.lit(low), F.lit(high - 1)))
        wave = F.pmod(F.xxhash64("q", F.monotonically_increasing_id()), F.lit(waves)).cast("int")
        asked = stored(queries.withColumns({"dim": F.size("q"), "wave": wave}), "asked")
        sent = asked.withColumn("shard", every(shards.start, shards.stop))
        trees = self.trees.where(F.col("shard").between(shards.start, shards.stop - 1)).withColumn("wave", every(0, waves))
        both = trees.withColumn("turn", F.lit(0)).unionByName(sent.withColumn("turn", F.lit(1)), allowMissingColumns=True)
        keys = ["dim", "shard", "wave"]
        names = queries.columns

        def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, started = None, False
            for batch in batches:
                if not started and batch.num_rows:
                    started, kept = True, batch.column("tree")[0]
                    if kept.is_valid:  # else this shard holds no row of this length
                        tree, batch = pickle.loads(kept.as_py()), batch.slice(1)
                for part in sliced(iter([batch])):
                    if tree is not None:
                        yield search(tree, part.select(names))

        return both.repartition(*keys).sortWithinPartitions(*keys, "turn").groupBy(*keys).applyInArrow(run, schema)
