"""Byte-level BPE: overlapping chunks are encoded in parallel and stitched; decoding joins bytes.

A text longer than ``CHUNK`` is cut into windows of ``CHUNK + OVERLAP`` characters and on
to the next place where white space follows another character; the next window starts
``OVERLAP`` before that end.  No pre-token spans that place, so both windows have a
boundary there.  Windows are dealt to tasks, pre-tokenised and encoded piece by piece.  From
any true boundary on the pattern finds the true pre-tokens, so where the boundaries of
a window and the next one first agree, the earlier hands over to the later; pieces
before that in the later window are thrown away.  A single pre-token longer than a
window widens it as far as needed.  A text of one window needs no stitching.

The ranks are read by the driver and broadcast (a vocabulary file of fixed size).

Edges: a null text counts as empty and has no ids; rows that repeat are encoded each;
an empty table gives no rows; extra columns stay in ``doc``.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.llm.common import sliced

CHUNK, OVERLAP = 16_384, 512
#: Pieces of a generation; bytes from which a piece is merged by a queue.
CACHED_PIECES, LONG = 200_000, 200
#: Tokens whose bytes are gathered at once.
GATHERED = 1 << 18
#: Above every rank.
NONE = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class Encoder:
    """Ids of pre-tokens, as bytes of 32-bit integers, remembered by piece in two generations.

    When the younger one is full it becomes the older one, so pieces in use stay known.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.find = regex.compile(pattern)
        self.merger = Merger(ranks)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        """After this ``known`` holds all of the pieces."""
        if len(self.known) >= CACHED_PIECES:
            self.known, self.older = {}, self.known
        new = []
        for piece in set(pieces).difference(self.known):
            if (ids := self.older.get(piece)) is not None:
                self.known[piece] = ids
            else:
                new.append(piece)
        self.known.update(zip(new, self.merger.ids([p.encode() for p in new])))

    def blobs(self, pieces: list[str]) -> list[bytes]:
        self.learn(pieces)
        return list(map(self.known.__getitem__, pieces))


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def encoder_of(ranks, pattern: str) -> Encoder:
    """The encoder of a broadcast rank table, kept while a worker lives."""
    key = (id(ranks.value), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks.value, pattern)
    return _ENCODERS[key]


class Merger:
    """Merges the neighbours of lowest rank, leftmost first, until no two have a rank.

    Many pieces are merged side by side, one pair of each in every turn.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        touching = np.zeros((256, 256), bool)
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                touching[token[i - 1], token[i]] = True
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        #: Neighbouring bytes that some token holds; no merge spans any others.
        self.touching = touching
        self.keys = np.array(sorted(pairs), np.int64)
        self.found = np.array([pairs[k] for k in self.keys.tolist()] or [0], np.int64)
        if not len(self.keys):
            self.keys = np.array([-1], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.found[at], NONE)

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as bytes of 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        several = []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONG:
                out[i] = self._long(piece).tobytes()
            elif piece:
                several.append(i)
        if not several:
            return out
        sizes = np.array([len(pieces[i]) for i in several], np.int64)
        token = self.byte[np.frombuffer(b"".join(pieces[i] for i in several), np.uint8)]
        owner = np.array(several, np.int64)
        rank = np.full(len(token), NONE, np.int64)  # of a token and the next one of its piece
        rank[:-1] = self.pair_ranks(token[:-1], token[1:])
        rank[np.cumsum(sizes) - 1] = NONE
        while len(owner):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NONE
            if done.any():
                data = token.astype("<i4").tobytes()
                for i, a, n in zip(owner[done].tolist(), starts[done].tolist(), sizes[done].tolist()):
                    out[i] = data[4 * a : 4 * (a + n)]
                stay = np.repeat(~done, sizes)
                token, rank, sizes, owner, lowest = token[stay], rank[stay], sizes[~done], owner[~done], lowest[~done]
                if not len(owner):
                    break
                starts = np.cumsum(sizes) - sizes
            hits = np.flatnonzero(rank == np.repeat(lowest, sizes))
            at = hits[np.searchsorted(hits, starts)]  # the leftmost of each piece
            token[at] = lowest
            stay = np.ones(len(token), bool)
            stay[at + 1] = False
            token, rank = token[stay], rank[stay]
            at -= np.arange(len(at))
            sizes = sizes - 1
            starts = np.cumsum(sizes) - sizes
            ends = starts + sizes - 1
            rank[ends] = NONE
            right = at < ends
            rank[at[right]] = self.pair_ranks(token[at[right]], token[at[right] + 1])
            left = at > starts
            rank[at[left] - 1] = self.pair_ranks(token[at[left] - 1], token[at[left]])
        return out

    def _long(self, piece: bytes) -> np.ndarray:
        """The ids of a long piece, which is cut where no token can span."""
        raw = np.frombuffer(piece, np.uint8)
        cuts = np.flatnonzero(~self.touching[raw[:-1], raw[1:]]) + 1
        edges = [0, *cuts.tolist(), len(piece)]
        return np.concatenate([self._queued(piece[a:b]) for a, b in zip(edges, edges[1:])])

    def _queued(self, data: bytes) -> np.ndarray:
        """A queue of pairs by rank and place over a linked list: n log n."""
        n, get = len(data), self.ranks.get
        part: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [r << 40 | i for i in range(n - 1) if (r := get(data[i : i + 2])) is not None]
        heapify(queue)
        while queue:
            top = heappop(queue)
            i = top & (1 << 40) - 1
            j = after[i] if part[i] is not None else n
            if j >= n or get(part[i] + part[j]) != top >> 40:
                continue  # one of the two has been merged meanwhile
            part[i] += part[j]
            part[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (rank := get(part[a] + part[b])) is not None:
                    heappush(queue, rank << 40 | a)
        return np.array([self.ranks[p] for p in part if p is not None], np.int32)


def windows(text: str) -> Iterator[tuple[int, str]]:
    """(start, text) of overlapping windows; see the top of this module."""
    seam = regex.compile(r"\S\s")
    start = 0
    while True:
        found = seam.search(text, start + CHUNK + OVERLAP) if start + CHUNK + OVERLAP < len(text) else None
        yield start, text[start : found.end() if found else len(text)]
        if not found:
            return
        start = found.end() - OVERLAP


def stitch(starts: list[np.ndarray], ends: list[int]) -> list[tuple[int, int]]:
    """For each window the range of its pieces that count.

    ``starts``: where its pieces begin in the text; ``ends``: where its text ends.
    The last piece of a window is cut unless the text ends there, and never needed.
    """
    ranges, first = [], 0
    for i, own in enumerate(starts):
        if i + 1 == len(starts):
            ranges.append((first, len(own)))
            break
        common = np.intersect1d(own[first:], starts[i + 1], assume_unique=True)
        ranges.append((first, bisect_left(own, common[0])))
        first = bisect_left(starts[i + 1], common[0])
    return ranges


def _lists(values: list[bytes]) -> pa.ListArray:
    """Lists of 32-bit integers from their bytes."""
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) // 4 for v in values], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(values), "<i4"), pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc`` (struct: the row without its text) and ``ids`` (array of int) of each row."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    rows = docs.select(rest.alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    doc_type = dict(rows.dtypes)["doc"]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(ranks, pattern)
        for batch in sliced(batches, 64):
            found = [encoder.find.findall(text) for text in batch.column(1).to_pylist()]
            encoder.learn(chain.from_iterable(found))
            ids = [b"".join(map(encoder.known.__getitem__, pieces)) for pieces in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], names=["doc", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for i, text in enumerate(batch.column(2).to_pylist()):
                for number, (start, window) in enumerate(windows(text)):
                    columns = [batch.column(0)[i : i + 1], batch.column(1)[i : i + 1], pa.array([number]), pa.array([start]), pa.array([window])]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "doc", "number", "start", "window"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(ranks, pattern)
        for batch in sliced(batches, 16):
            starts, counts, ids, ends = [], [], [], []
            for start, text in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                found = encoder.find.findall(text)
                blobs = encoder.blobs(found)
                lengths = np.fromiter(map(len, found), np.int32, len(found))
                starts.append((np.cumsum(lengths, dtype=np.int32) - lengths).tobytes())
                counts.append((np.fromiter(map(len, blobs), np.int32, len(found)) // 4).tobytes())
                ids.append(b"".join(blobs))
                ends.append(start + len(text))
            columns = [*(batch.column(i) for i in range(4)), pa.array(ends, pa.int64()), _lists(starts), _lists(counts), _lists(ids)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc", "number", "start", "end", "starts", "counts", "ids"])

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("number")
        ranges = stitch([start + np.asarray(s, np.int64) for start, s in zip(group["start"], group["starts"])], list(group["end"]))
        taken = []
        for (low, high), counts, ids in zip(ranges, group["counts"], group["ids"]):
            ends = np.concatenate([[0], np.cumsum(counts)])
            taken.append(np.asarray(ids)[ends[low] : ends[high]])
        return pd.DataFrame({"row": [group["row"].iloc[0]], "ids": [np.concatenate(taken)]})

    one_window = F.char_length("text") <= CHUNK
    short = rows.where(one_window).mapInArrow(whole, f"doc {doc_type}, ids array<int>")
    numbered = rows.where(~one_window).select(F.monotonically_increasing_id().alias("row"), "doc", "text")
    dealt = numbered.mapInArrow(cut, f"row long, doc {doc_type}, number long, start long, window string").repartition("row", "number")
    kinds = f"row long, doc {doc_type}, number long, start long, end long, starts array<int>, counts array<int>, ids array<int>"
    encoded = dealt.mapInArrow(pieces, kinds)
    long = encoded.groupBy("row", "doc").applyInPandas(
        lambda key, group: joined(group).assign(doc=[key[1]])[["doc", "ids"]], f"doc {doc_type}, ids array<int>"
    )
    return short.union(long)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the ids, one after the other."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    names = encoded.columns
    place = names.index("ids")

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: data for data, rank in ranks.value.items()}
        listed = [tokens.get(rank, b"") for rank in range(max(tokens) + 1)]
        size = np.array([len(t) for t in listed], np.int64)
        first, whole = np.cumsum(size) - size, np.frombuffer(b"".join(listed), np.uint8)
        for batch in sliced(batches, 64):
            lists = batch.column(place).fill_null([])
            ids, edges = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            ends = np.concatenate([[0], np.cumsum(size[ids])])  # of each token among the decoded bytes
            gathered = np.empty(ends[-1], np.uint8)
            for a in range(0, len(ids), GATHERED):
                b = min(a + GATHERED, len(ids))
                shift = np.repeat(first[ids[a:b]] - ends[a:b], size[ids[a:b]])
                gathered[ends[a] : ends[b]] = whole[shift + np.arange(ends[a], ends[b])]
            decoded = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends[edges].astype(np.int64)), pa.py_buffer(gathered)])
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded.cast(pa.binary())], names=[*names, "decoded"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(back, f"{kinds}, decoded binary")
