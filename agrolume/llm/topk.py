"""Exact top-k by inner product: a ball tree with branch and bound in every shard.

Rows are dealt to shards of about ``vectors.SHARD_BYTES``.  A ball tree is built once
over each shard and kept; queries are sent to it.  Each query visits the nodes in order
of their upper bound, q . centre + |q| * radius, until no bound reaches its k-th score.
The k-th score travels: a few shards go first, and what they find bounds the search in
the others.

Scores are whole numbers and exact at any size; a score beyond 64 bits is returned as
the nearest one within.  A node is left out only if its bound, with room for rounding,
lies below the k-th score, and ties at the k-th place go to the smaller id.

Edges: vectors that are null or empty or hold a null or non-finite component take no
part; vectors meet those of their own length; null ids take no part; rows that repeat
an id are rows of their own, but never answer a query of the same id.  Several queries
of one id answer together: the best k of what they find, a row once for each.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.llm.common import stored
from agrolume.llm.vectors import LEAST, Shards, as_longs, best, exact_products, integers, largest, nearest, quantised, usable

LEAF = 128
SCHEMA = "query_id long, vec_id long, score long"


class BallTree:
    """Nodes hold a range of ``order``, a centre and a radius; leaves have no children."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids, self.largest = points, ids, largest(points)
        at = points.astype(np.float64)
        self.order = np.arange(len(points))
        self.centres, self.radii, self.ranges, self.children = [], [], [], []
        todo = [(0, len(points), None)]
        while todo:
            low, high, parent = todo.pop()
            part = at[self.order[low:high]]
            centre = part.mean(axis=0)
            node = len(self.radii)
            self.centres.append(centre)
            self.radii.append(float(np.sqrt(((part - centre) ** 2).sum(axis=1).max())))
            self.ranges.append((low, high))
            self.children.append([])
            if parent is not None:
                self.children[parent].append(node)
            if high - low > leaf and self.radii[-1] > 0:
                far = part[((part - centre) ** 2).sum(axis=1).argmax()]
                other = part[((part - far) ** 2).sum(axis=1).argmax()]
                along = part @ (other - far)
                middle = (high - low) // 2
                self.order[low:high] = self.order[low:high][np.argpartition(along, middle)]
                todo += [(low, low + middle, node), (low + middle, high, node)]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def search(self, query: np.ndarray, own: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k best with a score of ``floor`` or more, other than ``own``."""
        q = query.astype(np.float64)
        reach = float(np.abs(q) @ self.largest)
        bounds = self.centres @ q + np.sqrt(q @ q) * self.radii
        bounds += 0.25 + 1e-9 * (reach + np.abs(bounds))  # room for rounding
        heap = [(-bounds[0], 0)]
        kept, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while heap and -heap[0][0] >= floor:
            _, node = heappop(heap)
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= floor:
                        heappush(heap, (-bounds[child], child))
                continue
            low, high = self.ranges[node]
            places = self.order[low:high]
            found = exact_products(self.points[places], query, reach)
            near = (found >= floor) & (self.ids[places] != own)
            kept, scores = np.concatenate([kept, self.ids[places[near]]]), np.concatenate([scores, found[near]])
            top = best(scores, kept, k)
            kept, scores = kept[top], scores[top]
            if len(kept) == k:
                floor = max(floor, int(scores[-1]))
        return kept, scores


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score (long) for each row of ``vectors`` (vec_id, embedding) that is a query."""
    clean = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    ints = clean.select("vec_id", quantised(F.col("embedding")).alias("v"), is_query.alias("asked"))
    shards = Shards(ints, lambda rows: BallTree(integers(rows.column("v").combine_chunks()), rows.column("vec_id").to_numpy()), "ints")
    queries = shards.rows.where("asked").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    number = queries.count()

    def search(tree: BallTree, asked: pa.RecordBatch) -> pa.RecordBatch:
        parts = [(np.zeros(0, np.int64),) * 3]
        floors = asked.column("floor").to_numpy(zero_copy_only=False)
        for own, query, floor in zip(asked.column("query_id").to_numpy(), integers(asked.column("q")), floors):
            kept, scores = tree.search(query, own, k, int(floor))
            parts.append((np.full(len(kept), own), kept, as_longs(scores)))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)], names=["query_id", "vec_id", "score"])

    found = stored(shards.ask(queries.withColumn("floor", F.lit(LEAST)), number, range(0, shards.first), search, SCHEMA), "first")
    if shards.count > shards.first:
        lowest = nearest(found, k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
        bounded = queries.join(lowest.where(F.col("n") >= k).drop("n"), "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(LEAST)))
        found = found.union(shards.ask(bounded, number, range(shards.first, shards.count), search, SCHEMA))
    return nearest(found, k)
