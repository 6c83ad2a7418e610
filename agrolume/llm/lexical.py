"""Ranked lexical search with range-maximum tables over posting lists.

Documents are cut into parts of about ``POSTINGS`` postings.  A part keeps one posting
list per term in order of the document, the impact of each posting, and a sparse table
of where the highest impact of each stretch of 2**k postings stands.  For an item a
queue holds intervals of documents; the sum over the terms of weight times highest
impact in the interval bounds every score in it.  The best interval is taken first: a
short one is scored whole, a longer one is split at the document of the term that adds
most to its bound, and an interval whose bound can't reach the k-th place is dropped.
The k-th score goes on from part to part within a task.

Items are handled in blocks of bounded size, each against all documents; only the terms
of a block, their counts and two totals reach the driver.

Edges: a null text has no terms, neither has one without letters and digits, and such
documents and items take no part; a null doc_id comes last among equal scores; documents
that repeat an id are documents of their own, as are items; an item whose terms are in
no document, and an empty table, return nothing; columns of other names are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrolume.llm.common import ascii_lower, sliced, stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Postings of a part; documents of an interval that is scored whole.
POSTINGS, SHORT = 1_000_000, 256
#: Items and terms of a block; items that one task answers over a part.
BLOCK_ITEMS, BLOCK_TERMS, TASK_ITEMS = 20_000, 1_000_000, 2_000
#: Characters of a text whose terms are listed at once.
LISTED = 1 << 20
LAST = np.iinfo(np.int64).max


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(TERM), F.lit(0))


class Part:
    """Posting lists of some documents with a sparse table over all of them."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, norms: np.ndarray):
        """``sizes`` are postings per document, in order; ``norms`` are the documents' m."""
        self.docs = len(sizes)
        doc = np.repeat(np.arange(self.docs), sizes)
        impact = 1_000_000_000 * counts // (1000 * counts + 8 * norms[doc])
        order = np.lexsort((doc, terms))
        self.doc, self.impact, terms = doc[order], impact[order], terms[order]
        self.terms, starts = np.unique(terms, return_index=True)
        lengths = np.diff([*starts, len(terms)])
        #: List number and document of each posting in one ascending number.
        self.keys = np.repeat(np.arange(len(self.terms)), lengths) * self.docs + self.doc
        tops = [np.arange(len(terms), dtype=np.int32)]
        while 2 ** len(tops) <= max(lengths, default=0):
            below, half = tops[-1], 2 ** (len(tops) - 1)
            left, right = below[:-half], below[half:]
            better = np.where(self.impact[right] > self.impact[left], right, left)
            tops.append(np.concatenate([better, below[len(better) :]]))
        self.tops = np.array(tops)

    def highest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Impact (0 for none) and place of the highest posting in each range of a list."""
        length = high - low
        some = length > 0
        level = np.where(some, np.frexp(np.maximum(length, 1))[1] - 1, 0)
        low, last = np.where(some, low, 0), np.where(some, high - (1 << level), 0)
        a, b = self.tops[level, low], self.tops[level, last]
        place = np.where(self.impact[b] > self.impact[a], b, a)
        return np.where(some, self.impact[place], 0), place

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best with a score of ``floor`` or more, equal ones in order."""
        lists = np.searchsorted(self.terms, terms)
        lists = np.where(lists < len(self.terms), lists, 0)
        here = (self.terms[lists] == terms) & (weights > 0)
        base, weights = lists[here] * self.docs, weights[here]
        best_docs, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(base):
            return best_docs, best_scores
        last = self.docs  # the k-th document; one after it with the same score comes too late

        def bounded(low: int, high: int) -> tuple:
            ends = np.searchsorted(self.keys, np.concatenate([base + low, base + high]))
            low_at, high_at = ends[: len(base)], ends[len(base) :]
            tops, places = self.highest(low_at, high_at)
            worth = tops * weights
            return -int(worth.sum()), low, high, low_at, high_at, int(self.doc[places[worth.argmax()]])

        heap, turn = [], 0  # turn: no two entries are alike, so arrays are never compared
        todo = [(0, self.docs)]
        while True:
            for low, high in todo:
                entry = bounded(low, high)
                if entry[0] < 0:
                    heappush(heap, (*entry[:3], turn, *entry[3:]))
                    turn += 1
            todo = []
            if not heap or -heap[0][0] < floor:
                return best_docs, best_scores
            bound, low, high, _, low_at, high_at, split = heappop(heap)
            if -bound == floor and low > last:
                continue
            if high - low > SHORT:
                todo = [(low, split), (split, split + 1), (split + 1, high)]
                longest = max(todo, key=lambda x: x[1] - x[0])
                if longest[1] - longest[0] > (high - low) * 7 // 8:  # nearly all on one side: halve that
                    todo.remove(longest)
                    middle = sum(longest) // 2
                    todo += [(longest[0], middle), (middle, longest[1])]
                todo = [x for x in todo if x[1] > x[0]]
                continue
            lengths = high_at - low_at
            postings = np.repeat(low_at - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            scores = np.zeros(high - low, np.int64)
            np.add.at(scores, self.doc[postings] - low, self.impact[postings] * np.repeat(weights, lengths))
            near = np.flatnonzero((scores >= floor) & (scores > 0))
            docs, scores = np.concatenate([best_docs, near + low]), np.concatenate([best_scores, scores[near]])
            order = np.lexsort((docs, -scores))[:k]
            best_docs, best_scores = docs[order], scores[order]
            if len(order) == k:
                if best_scores[-1] >= floor:
                    floor, last = int(best_scores[-1]), int(best_docs[-1])


def _counted(docs: DataFrame, numbers) -> DataFrame:
    """doc_id, n, terms, counts of each document with terms; ``numbers`` is a broadcast {term: number}."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, get = re.compile(TERM).findall, numbers.value.get
        each = re.compile(TERM).finditer
        for batch in sliced(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                if len(text) <= LISTED:
                    found = find(text)
                    n, held = len(found), Counter(map(get, found))
                else:
                    held = Counter(get(m.group()) for m in each(text))
                    n = sum(held.values())
                held.pop(None, None)
                rows.append((n, list(held), list(held.values())))
            n, terms, counts = zip(*rows) if rows else ((), (), ())
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(terms, ints), pa.array(counts, ints)], names=["doc_id", "n", "terms", "counts"])

    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), ascii_lower(F.col("text")).alias("text"))
    return texts.mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<int>").where("n > 0")


def _block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The answers to the items (item_id, terms) of one block."""
    spark = docs.sparkSession
    asked = [(r["item_id"], r["terms"]) for r in items.orderBy("item_id", "terms").collect()]
    numbers = {term: i for i, term in enumerate(dict.fromkeys(t for _, terms in asked for t in terms))}
    shared = spark.sparkContext.broadcast(numbers)
    counted = stored(_counted(docs, shared), "counted")
    shared.unpersist()
    total, words, postings = counted.agg(F.count("*"), F.sum("n"), F.sum(F.size("terms"))).first()
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row per term of the block
    weights = np.zeros(len(numbers), np.int64)
    for term, documents in held:
        weights[term] = math.floor(1000 * math.log((2 * total + 2) / (2 * documents + 1)))
    queries = [np.unique(np.array([numbers[t] for t in terms], np.int64)) for _, terms in asked]
    sent = spark.sparkContext.broadcast((queries, weights))
    ids = [i for i, _ in asked]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = sent.value
        floors = [1] * len(queries)
        waiting, size = [], 0

        def answered() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            doc_ids = table.column("doc_id").fill_null(LAST).to_numpy()
            order = np.argsort(doc_ids, kind="stable")
            table, doc_ids = table.take(pa.array(order)), doc_ids[order]
            known = table.column("doc_id").is_valid().to_numpy()
            lists = table.column("terms").combine_chunks()
            flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy().astype(np.int64)
            norms = 10 + 90 * table.column("n").to_numpy() * total // words
            part = Part(lists.value_lengths().to_numpy(), flat("terms"), flat("counts"), norms)
            found = [(np.zeros(0, np.int64),) * 3]
            for i, terms in enumerate(queries):
                docs, scores = part.search(terms, weights[terms], k, floors[i])
                if len(docs) == k:
                    floors[i] = max(floors[i], int(scores[-1]))
                found.append((np.full(len(docs), i), docs, scores))
            item, docs, scores = (np.concatenate(c) for c in zip(*found))
            columns = [pa.array(item, pa.int32()), pa.array(doc_ids[docs], pa.int64(), mask=~known[docs]), pa.array(scores, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

        for batch in sliced(batches):
            if batch.num_rows:
                waiting.append(batch)
                size += len(batch.column("terms").flatten())
            if size >= POSTINGS:
                yield answered()
                waiting, size = [], 0
        if waiting:
            yield answered()

    if not postings:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    tasks = -(-postings // POSTINGS) * -(-len(asked) // TASK_ITEMS)
    found = counted.where(F.size("terms") > 0).repartition(tasks).mapInArrow(answer, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = stored(found, "found").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
    return ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")  # BLOCK_ITEMS rows


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (doc_id, text) for each item (item_id, text)."""
    terms = items.select(F.col("item_id").cast("long").alias("item_id"), F.array_distinct(terms_of(F.col("text"))).alias("terms")).where(F.size("terms") > 0)
    dealt = stored(terms.withColumn("deal", F.xxhash64(F.monotonically_increasing_id())), "items")
    number, size = dealt.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(-(-number // BLOCK_ITEMS), -(-size // BLOCK_TERMS), 1)
    out = None
    for block in range(blocks):
        found = _block(docs, dealt.where(F.pmod("deal", F.lit(blocks)) == block).select("item_id", "terms"), k)
        out = found if out is None else out.union(found)
    return out
