"""Hard negatives by an STR-packed R-tree with score windows.

Rows are dealt to shards, and an R-tree is packed over each one and kept: rows of one
label stand together, within a label they are cut into slices along one coordinate after
the other (the widest first) until a slice fits a page, and pages are packed into nodes
in the same order.  A minimum bounding box holds the least and the largest value of each
coordinate and of the label.  For an anchor q each coordinate of a box gives an interval
of q_i * x_i, and the sums of their ends are bounds of the scores in the box.

An anchor first asks for its positives, the best rows of its own label.  Each positive
then opens a score window, and the rows of other labels are searched with the boxes in
order of their upper bound, cut off at the window's upper end: boxes outside the window,
boxes of the anchor's label only and boxes strictly below the k-th score are pruned.  A
few shards go first, and the k-th scores that they find bound the search in the others.

Scores are whole numbers and exact at any size; one beyond 64 bits is returned as the
nearest one within.  Ties go to the smaller id.

Edges: rows with a null id, a null label, or a vector that is null or empty or holds a
null or non-finite component take no part; vectors meet those of their own length; rows
that repeat an id are rows of their own, but never answer an anchor of the same id; of
several anchors with one id the least in label, then vector, asks; a positive that
stands in several rows is a positive for each; an anchor without positives, or a window
without rows, returns nothing.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrolume.llm.common import stored
from agrolume.llm.vectors import LEAST, Shards, as_longs, best, exact_products, integers, largest, quantised, usable

#: Rows of a page, nodes of a node.
PAGE, FANOUT = 128, 8
POSITIVES = "anchor_id long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"
#: place and score of a positive, and the k-th score so far of its window.
WINDOWS = "array<struct<place:int,positive_id:long,score:long,floor:long>>"


def packed(points: np.ndarray, labels: np.ndarray, page: int) -> list[np.ndarray]:
    """Places of the rows of each page, sort-tile-recursive within runs of labels."""
    order = np.argsort(labels, kind="stable")
    edges = [0, *(np.flatnonzero(np.diff(labels[order])) + 1), len(order)]
    runs, start = [], 0
    for low, high in zip(edges, edges[1:]):  # a label with less than a page shares one with its neighbours
        if high - start > page and low > start:
            runs.append(order[start:low])
            start = low
    runs.append(order[start:])
    axes = np.argsort(-np.ptp(points.astype(np.float64), axis=0), kind="stable")
    pages = []
    todo = [(run, 0) for run in reversed(runs)]
    while todo:
        rows, depth = todo.pop()
        if len(rows) <= page:
            pages.append(rows)
            continue
        left = max(1, len(axes) - depth)
        slices = max(2, int(np.ceil((len(rows) / page) ** (1 / left)))) if left > 1 else -(-len(rows) // page)
        rows = rows[np.argsort(points[rows, axes[depth % len(axes)]], kind="stable")]
        todo += [(part, depth + 1) for part in reversed(np.array_split(rows, slices))]
    return pages


class RTree:
    """Boxes over pages of rows; node 0 is the root."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray, page: int = PAGE, fanout: int = FANOUT):
        pages = packed(points, labels, page)
        order = np.concatenate(pages)
        self.points, self.ids, self.labels, self.largest = points[order], ids[order], labels[order], largest(points)
        ends = np.cumsum([len(p) for p in pages])
        # One level after the other from the pages up: (rows from, rows to, first child, last child).
        levels = [[(end - len(p), end, None) for p, end in zip(pages, ends)]]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([(below[i][0], below[min(i + fanout, len(below)) - 1][1], range(i, min(i + fanout, len(below)))) for i in range(0, len(below), fanout)])
        self.ranges, self.children, start = [], [], 0
        for level in reversed(levels):
            start += len(level)  # the level below begins here
            for low, high, inside in level:
                self.ranges.append((int(low), int(high)))
                self.children.append([] if inside is None else [start + i for i in inside])
        cut = lambda f, values: np.array([f(values[low:high], axis=0) for low, high in self.ranges])
        self.low, self.high = cut(np.min, self.points).astype(np.float64), cut(np.max, self.points).astype(np.float64)
        self.label_low, self.label_high = cut(np.min, self.labels), cut(np.max, self.labels)

    def intervals(self, query: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores in every box, with room for rounding."""
        up, down = np.maximum(query, 0), np.minimum(query, 0)
        room = 0.25 + 1e-9 * reach
        return self.low @ up + self.high @ down - room, self.high @ up + self.low @ down + room

    def search(self, query: np.ndarray, own: int, label: int, same: bool, windows: list[tuple[int | None, int | None, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (lowest score or None, highest or None, k-th score so far) ids and scores of its k best.

        They have the anchor's label if ``same``, else another one, and never its id.
        """
        q = query.astype(np.float64)
        reach = float(np.abs(q) @ self.largest)
        lower, upper = self.intervals(q, reach)
        if same:
            open_to = (self.label_low <= label) & (self.label_high >= label)
        else:
            open_to = (self.label_low != label) | (self.label_high != label)
        scored: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # pages, which windows of one anchor share
        out = []
        for lowest, highest, floor in windows:
            floor = floor if lowest is None else max(floor, lowest)
            top = float("inf") if highest is None else float(highest)
            kept, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            reaches = open_to & (lower <= top) & (upper >= floor)
            first = np.minimum(upper, top)
            heap = [(-first[0], 0)] if reaches[0] else []
            while heap and -heap[0][0] >= floor:
                _, node = heappop(heap)
                if self.children[node]:
                    for child in self.children[node]:
                        if reaches[child] and upper[child] >= floor:
                            heappush(heap, (-first[child], child))
                    continue
                if node not in scored:
                    rows = slice(*self.ranges[node])
                    fits = (self.labels[rows] == label) == same
                    fits &= self.ids[rows] != own
                    scored[node] = self.ids[rows][fits], exact_products(self.points[rows][fits], query, reach)
                ids, found = scored[node]
                near = found >= floor
                if highest is not None:
                    near &= found <= highest
                if not near.any():
                    continue
                kept, scores = np.concatenate([kept, ids[near]]), np.concatenate([scores, found[near]])
                places = best(scores, kept, k)
                kept, scores = kept[places], scores[places]
                if len(kept) == k:
                    floor = max(floor, int(scores[-1]))
            out.append((kept, scores))
        return out


def _columns(parts: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)


def _first(found: DataFrame, by: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, embedding and label.  A negative's score lies between ``low``
    and ``high`` percent of the positive's.
    """
    clean = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    ints = clean.select("vec_id", F.col("label").cast("long").alias("label"), quantised(F.col("embedding")).alias("v"), is_anchor.alias("asked"))
    build = lambda t: RTree(integers(t.column("v").combine_chunks()), t.column("vec_id").to_numpy(), t.column("label").to_numpy())
    shards = Shards(ints, build, "rows")
    anchors = stored(
        shards.rows.where("asked").groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "v")).alias("a")).select("anchor_id", "a.label", F.col("a.v").alias("q")),
        "anchors",
    )
    number = anchors.count()
    early, late = range(0, shards.first), range(shards.first, shards.count)

    def own_label(tree: RTree, asked: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for own, label, query, floor in zip(*(asked.column(c).to_pylist() for c in ("anchor_id", "label")), integers(asked.column("q")), asked.column("floor").to_pylist()):
            [(ids, scores)] = tree.search(query, own, label, True, [(None, None, floor)], positives)
            parts.append((np.full(len(ids), own), ids, as_longs(scores)))
        return _columns(parts, ["anchor_id", "positive_id", "positive_score"], [pa.int64()] * 3)

    def other_labels(tree: RTree, asked: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for own, label, query, windows in zip(*(asked.column(c).to_pylist() for c in ("anchor_id", "label")), integers(asked.column("q")), asked.column("windows").to_pylist()):
            bounds = [(-(-low * w["score"] // 100), high * w["score"] // 100, w["floor"]) for w in windows]
            for w, (ids, scores) in zip(windows, tree.search(query, own, label, False, bounds, negatives)):
                of = (np.full(len(ids), x) for x in (own, w["place"], w["positive_id"], w["score"]))
                parts.append((*of, ids, as_longs(scores)))
        names = ["anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
        return _columns(parts, names, [pa.int64(), pa.int32(), *[pa.int64()] * 4])

    # Positives: the k-th scores of the first shards are floors in the others.
    by_score = lambda found, k: _first(found, ["anchor_id"], "positive_score", "positive_id", k)
    found = stored(shards.ask(anchors.withColumn("floor", F.lit(LEAST)), number, early, own_label, POSITIVES), "positives")
    if len(late):
        lowest = found.transform(by_score, positives).groupBy("anchor_id").agg(F.count("*").alias("n"), F.min("positive_score").alias("floor"))
        bounded = anchors.join(lowest.where(F.col("n") >= positives).drop("n"), "anchor_id", "left").withColumn("floor", F.coalesce("floor", F.lit(LEAST)))
        found = found.union(shards.ask(bounded, number, late, own_label, POSITIVES))
    chosen = found.transform(by_score, positives)

    # Negatives: all windows of an anchor travel together.
    window = F.struct(F.col("rank").alias("place"), "positive_id", F.col("positive_score").alias("score"), F.lit(LEAST).alias("floor"))
    listed = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(window)).cast(WINDOWS).alias("windows"))  # ``positives`` at most
    waiting = stored(anchors.join(listed, "anchor_id"), "windows")
    by_window = lambda found: _first(found, ["anchor_id", "place"], "negative_score", "negative_id", negatives)
    found = stored(shards.ask(waiting, number, early, other_labels, NEGATIVES), "negatives")
    if len(late):
        full = found.transform(by_window).groupBy("anchor_id", "place").agg(F.count("*").alias("n"), F.min("negative_score").alias("floor")).where(F.col("n") >= negatives)
        floors = full.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "floor"))).alias("floors"))
        raised = F.transform("windows", lambda w: w.withField("floor", F.coalesce(F.try_element_at("floors", w["place"]), w["floor"])))
        bounded = waiting.join(floors, "anchor_id", "left").withColumn("windows", raised.cast(WINDOWS)).drop("floors")
        found = found.union(shards.ask(bounded, number, late, other_labels, NEGATIVES))
    return found.transform(by_window).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
