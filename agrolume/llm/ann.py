"""Approximate nearest neighbours: a tree of k-means, searched best bin first.

The tree is fitted on a bounded sample (about ``SAMPLE`` vectors by hash of the id):
every node splits its part into ``BRANCHES`` clusters until ``LEAF`` sample vectors are
left.  Every row goes down the tree to one leaf.  The tree grows with the table: leaves
that hold far more than ``ROWS_PER_LEAF`` rows are split by trees of their own, fitted
side by side in tasks on a bounded sample of each, until ``CENTRES`` components of centres
bound the size of the whole tree.  A query keeps the open nodes in a
priority queue by inner product with their centres and takes the best first; how many
leaves it visits is widened until ``TARGET`` of the true neighbours of ``PROBES`` probe
queries, found by brute force over all rows, lie in the visited leaves.

Queries and rows meet by leaf, the first visits before the others: the k-th score they
find is a floor below which no later leaf answers.  A leaf with many rows or queries is split into blocks,
so a vector that is very common costs many tasks, not one long one.  Scores are
inner products of the original vectors in double precision.

Edges: vectors that are null, empty, zero or hold a null or non-finite component take no
part; null ids neither; each length of vectors has a tree of its own, and vectors meet
those of their length; a query goes on until the leaves it has visited hold k other rows,
so with fewer candidates than k it gets all of them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.llm.common import stored
from agrolume.llm.vectors import best, matrix, nearest, usable

SAMPLE, BRANCHES, LEAF = 20_000, 8, 64
ROUNDS = 12
#: Rows that a leaf is meant to hold; all centres together have about so many components (64 MB) at most.
ROWS_PER_LEAF, CENTRES = 4_096, 8_000_000
#: A leaf is split at most so many times; each turn splits it into up to SAMPLE / LEAF parts.
TURNS = 6
PROBES, TARGET = 64, 0.95
#: One visit in so many goes first; the k-th score it finds is the floor of the others.
FIRST = 8
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 4_096, 1_024
SCHEMA = "query_id long, vec_id long, score double"


class Tree:
    """Centres of all nodes; leaves are numbered from 0."""

    def __init__(self, points: np.ndarray, seed: int = 11):
        self.children: list[list[int]] = [[]]
        self.centres = [points.mean(axis=0) if len(points) else np.zeros(points.shape[1])]
        self.leaf = [-1]
        self.leaves = 0
        random = np.random.default_rng(seed)
        todo = [(0, points)]
        while todo:
            node, part = todo.pop()
            labels = self._split(part, random) if len(part) > LEAF else None
            if labels is None:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            for label in np.unique(labels):
                inside = part[labels == label]
                child = len(self.centres)
                self.centres.append(inside.mean(axis=0))
                self.children.append([])
                self.leaf.append(-1)
                self.children[node].append(child)
                todo.append((child, inside))
        self.centres = np.array(self.centres)

    @staticmethod
    def _split(part: np.ndarray, random: np.random.Generator) -> np.ndarray | None:
        """Labels of k-means, or None if the points can't be told apart."""
        centres = part[random.choice(len(part), min(BRANCHES, len(part)), replace=False)]
        labels = None
        for _ in range(ROUNDS):
            near = (part @ centres.T) - 0.5 * (centres**2).sum(axis=1)
            labels = near.argmax(axis=1)
            centres = np.array([part[labels == i].mean(axis=0) if (labels == i).any() else centres[i] for i in range(len(centres))])
        return None if len(np.unique(labels)) < 2 else labels

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: the nearest centre on every level."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            children = np.array(self.children[node])
            centres = self.centres[children]
            near = (points[rows] @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
            todo += [(int(c), rows[near == i]) for i, c in enumerate(children) if (near == i).any()]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        heap, out = [(0.0, 0)], []
        while heap and len(out) < most:
            _, node = heappop(heap)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
                continue
            children = self.children[node]
            for child, score in zip(children, (self.centres[children] @ query).tolist()):
                heappush(heap, (-score, child))
        return out

    def graft(self, parts: dict[int, "Tree"]) -> None:
        """Leaves that become trees; one leaf of each keeps the number, the others get new ones."""
        node_of = {leaf: node for node, leaf in enumerate(self.leaf) if leaf in parts}
        centres = [self.centres]
        for leaf, part in sorted(parts.items()):
            node, offset = node_of[leaf], len(self.leaf) - 1  # the root of the part is the leaf's node
            self.children[node] = [child + offset for child in part.children[0]]
            self.leaf[node] = -1
            self.children += [[child + offset for child in children] for children in part.children[1:]]
            self.leaf += [number if number < 0 else leaf if number == 0 else self.leaves + number - 1 for number in part.leaf[1:]]
            self.leaves += part.leaves - 1
            centres.append(part.centres[1:])
        self.centres = np.concatenate(centres)


def exact_scores(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed alike for equal vectors wherever they stand."""
    return (points * query).sum(axis=1)


def answers(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries, places of points and scores: the k best of ``points`` for each
    query, other than the row of its ``own`` id and not below its floor."""
    rough = queries @ points.T
    rough[own[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        floors = np.maximum(floors, np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k])
    low = np.where(np.isfinite(floors), floors - 1e-9 * (1 + np.abs(floors)), floors)
    near = (rough >= low[:, None]) & np.isfinite(rough)
    counts = near.sum(axis=1)
    found = []
    few = np.flatnonzero((counts > 0) & (counts <= 4 * k))
    at, place = np.nonzero(near[few])
    scores = exact_scores(points[place], queries[few[at]])
    order = np.lexsort((ids[place], -scores, at))
    turn = np.arange(len(order)) - np.searchsorted(at[order], at[order])
    order = order[turn < k]
    found.append((few[at[order]], place[order], scores[order]))
    for i in np.flatnonzero(counts > 4 * k):  # very many equal vectors
        place = np.flatnonzero(near[i])
        scores = exact_scores(points[place], queries[i])
        top = best(scores, ids[place], k)
        found.append((np.full(len(top), i), place[top], scores[top]))
    return tuple(map(np.concatenate, zip(*found)))


class Index:
    """Every row of ``vectors`` (vec_id, embedding) in a leaf of the tree of its length."""

    def __init__(self, vectors: DataFrame, k: int, sample_size: int = SAMPLE, rows_per_leaf: int = ROWS_PER_LEAF):
        clean = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        clean = clean.where(F.exists("embedding", lambda x: x != 0)).select("vec_id", F.col("embedding").cast("array<double>").alias("v"), F.size("embedding").alias("dim"))
        self.rows, self.k = clean.count(), k
        drawn = F.pmod(F.xxhash64("vec_id", F.lit("tree")), F.lit(1_000_003)) < 1_000_003.0 * sample_size / max(self.rows, 1)
        sample: dict[int, list] = {}
        for r in clean.where(drawn).orderBy("vec_id", "v").limit(2 * sample_size).collect():
            sample.setdefault(r["dim"], []).append(r["v"])
        #: A length that the sample does not hold has one leaf.
        self.trees = {dim: Tree(np.array(points, np.float64)) for dim, points in sample.items()}
        self.indexed = self._placed(clean)
        self.sizes = self._sizes()
        settled: set[tuple[int, int]] = set()
        for _ in range(TURNS):
            parts = self._split(sample_size, rows_per_leaf, settled)
            if not parts:
                break
            for dim, of_dim in parts.items():
                self.trees[dim].graft(of_dim)
            self.indexed = self._placed(self.indexed.drop("leaf"))
            self.sizes = self._sizes()

    def _placed(self, rows: DataFrame) -> DataFrame:
        """The rows (vec_id, v, dim) with their leaves, stored."""
        shared = rows.sparkSession.sparkContext.broadcast(self.trees)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims, leaves = batch.column("dim").to_numpy(), np.zeros(batch.num_rows, np.int32)
                for dim in np.unique(dims):
                    if dim in shared.value:
                        at = np.flatnonzero(dims == dim)
                        points = np.array(batch.column("v").take(pa.array(at)).to_pylist(), np.float64)
                        leaves[at] = shared.value[dim].place(points)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.int32())], names=["vec_id", "v", "dim", "leaf"])

        out = stored(rows.mapInArrow(placed, "vec_id long, v array<double>, dim int, leaf int"), "index")
        shared.unpersist()
        return out

    def _sizes(self) -> dict[tuple[int, int], int]:
        """Rows of each leaf: as many entries as there are leaves and lengths."""
        return {(r["dim"], r["leaf"]): r["count"] for r in self.indexed.groupBy("dim", "leaf").count().collect()}

    def _split(self, sample_size: int, rows_per_leaf: int, settled: set[tuple[int, int]]) -> dict[int, dict[int, Tree]]:
        """Trees for the leaves that hold more than twice the rows a leaf is meant to hold.

        About half of LEAF sample vectors, as the parts of a tree hold on average, stand
        for those rows.  A leaf whose sample can't be told apart, as of one very common
        vector, is settled.
        """
        components = sum(dim * size for (dim, _), size in self.sizes.items())
        meant = max(rows_per_leaf, -(-components // CENTRES))
        large = {at: size for at, size in self.sizes.items() if size > 2 * meant and at not in settled and at[0] in self.trees}
        if not large:
            return {}
        spark = self.indexed.sparkSession
        shares = [(dim, leaf, min(LEAF / 2 / meant, sample_size / size)) for (dim, leaf), size in large.items()]
        rates = F.broadcast(spark.createDataFrame(shares, "dim int, leaf int, share double"))
        drawn = self.indexed.join(rates, ["dim", "leaf"]).where(
            F.pmod(F.xxhash64("vec_id", F.lit("leaf")), F.lit(1_000_003)) < 1_000_003.0 * F.col("share")
        )

        def fitted(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            points = matrix(part.sort_values("vec_id", kind="stable")["v"])
            return pd.DataFrame({"dim": [key[0]], "leaf": [key[1]], "tree": [pickle.dumps(Tree(points))]})

        fits = drawn.select("dim", "leaf", "vec_id", "v").groupBy("dim", "leaf").applyInPandas(fitted, "dim int, leaf int, tree binary")
        parts: dict[int, dict[int, Tree]] = {}
        for r in fits.collect():  # centres: bounded by CENTRES
            tree = pickle.loads(r["tree"])
            if tree.leaves > 1:
                parts.setdefault(r["dim"], {})[r["leaf"]] = tree
        settled.update(at for at in large if at[1] not in parts.get(at[0], {}))
        return parts

    def most_leaves(self) -> int:
        return max((tree.leaves for tree in self.trees.values()), default=1)

    def calibrated(self, queries: DataFrame, probes: int = PROBES, target: float = TARGET) -> int:
        """Leaves to visit so that ``target`` of the probes' true neighbours are found."""
        drawn = queries.orderBy(F.xxhash64("vec_id", F.lit("probe")), "vec_id").limit(probes).collect() if self.rows else []
        if not drawn:
            return 1
        own, k = np.array([r["vec_id"] for r in drawn]), self.k
        asked = {dim: np.flatnonzero([len(r["v"]) == dim for r in drawn]) for dim in {len(r["v"]) for r in drawn}}
        probe = {dim: np.array([drawn[i]["v"] for i in at], np.float64) for dim, at in asked.items()}
        shared = self.indexed.sparkSession.sparkContext.broadcast((own, asked, probe))

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, asked, probe = shared.value
            for batch in batches:
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims):
                    if dim not in asked:
                        continue
                    inside = batch.take(pa.array(np.flatnonzero(dims == dim)))
                    ids, leaves = inside.column("vec_id").to_numpy(), inside.column("leaf").to_numpy()
                    points = np.array(inside.column("v").to_pylist(), np.float64)
                    ask = own[asked[dim]]
                    at, place, scores = answers(points, ids, probe[dim], ask, np.full(len(ask), -np.inf), k)
                    columns = [pa.array(ask[at], pa.int64()), pa.array(ids[place], pa.int64()), pa.array(scores, pa.float64()), pa.array(leaves[place], pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score", "leaf"])

        found = self.indexed.mapInArrow(part, f"{SCHEMA}, leaf int")
        leaves = {(r["query_id"], r["vec_id"]): r["leaf"] for r in nearest_with_leaf(found, k).collect()}  # probes * k rows
        order = {}
        for r in drawn:
            if tree := self.trees.get(len(r["v"])):
                order[r["vec_id"]] = {leaf: i for i, leaf in enumerate(tree.visits(np.array(r["v"]), tree.leaves))}
        turns = [order[query].get(leaf, 0) + 1 for (query, _), leaf in leaves.items() if query in order]
        if not turns or self.rows <= 4 * self.k:
            return self.most_leaves()
        return int(np.quantile(turns, target, method="higher"))

    def search(self, is_query: Column, k: int | None = None, visits: int | None = None) -> DataFrame:
        """query_id, rank, vec_id, score for the rows that are queries."""
        k = k or self.k
        queries = self.indexed.where(is_query).select("vec_id", "v", "dim")
        most = visits or self.calibrated(queries)
        shared = self.indexed.sparkSession.sparkContext.broadcast((self.trees, self.sizes))

        def to_visit(query: np.ndarray) -> list[int]:
            """The first ``most`` leaves, and more until they hold k rows besides the query's own."""
            trees, sizes = shared.value
            tree = trees.get(len(query))
            if tree is None:
                return [0]
            size = lambda leaf: sizes.get((len(query), leaf), 0)
            leaves = tree.visits(query, most)
            if sum(map(size, leaves)) <= k:
                leaves = tree.visits(query, tree.leaves)
                held = np.cumsum([size(leaf) for leaf in leaves])
                leaves = leaves[: int(np.searchsorted(held, k, side="right")) + 1]
            return leaves

        def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaves = [to_visit(np.array(v)) for v in batch.column("v").to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int32()))], names=["query_id", "q", "dim", "leaves"])

        asked = stored(queries.mapInArrow(visiting, "query_id long, q array<double>, dim int, leaves array<int>"), "asked")
        asked = asked.select("query_id", "q", "dim", F.posexplode("leaves").alias("turn", "leaf"))
        first = -(-most // FIRST)
        found = stored(self._meet(asked.where(F.col("turn") < first).withColumn("floor", F.lit(float("-inf"))), k), "first")
        lowest = nearest(found, k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
        rest = asked.where(F.col("turn") >= first).join(lowest.where(F.col("n") >= k).drop("n"), "query_id", "left")
        found = found.union(self._meet(rest.withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), k))
        return nearest(found, k)

    def _meet(self, asked: DataFrame, k: int) -> DataFrame:
        """Partial answers of queries (query_id, q, dim, leaf, floor) in their leaves."""
        at = ["dim", "leaf"]
        sizes = self.indexed.groupBy(*at).agg(F.ceil(F.count("*") / ROWS_PER_BLOCK).cast("int").alias("blocks"))
        loads = asked.groupBy(*at).agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).cast("int").alias("parts"))
        deal = sizes.join(loads, at)  # one row per leaf: the trees are of bounded size
        rows = self.indexed.join(F.broadcast(deal), at).select(
            *at, "vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        )
        sent = asked.join(F.broadcast(deal), at).select(
            *at, "query_id", "q", "floor", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part")
        )

        def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
            own, ids = right["query_id"].to_numpy(), left["vec_id"].to_numpy()
            found, place, scores = answers(matrix(left["v"]), ids, matrix(right["q"]), own, right["floor"].to_numpy(), k)
            return pd.DataFrame({"query_id": own[found], "vec_id": ids[place], "score": scores})

        keys = [*at, "block", "part"]
        return rows.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(meet, SCHEMA)


def nearest_with_leaf(found: DataFrame, k: int) -> DataFrame:
    ranked = nearest(found.select("query_id", "vec_id", "score"), k)
    return ranked.join(found.select("query_id", "vec_id", "leaf").distinct(), ["query_id", "vec_id"])
