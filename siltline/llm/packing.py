"""Filling containers of fixed capacity (problem 8) along a space-filling curve.

Texts are measured in tokens of a public tokenizer.  A document is hashed into a vector of its tokens
and projected to three dimensions; its place on the Hilbert curve through them is the sort key.  The
documents are range-sorted by the key (and id, so that a third of all rows with one key still spread
over many ranges), and each range packs neighbouring documents along the curve: a stretch of the
curve at a time, largest piece first, each into the fullest container that still has room.  What is
not nearly full stays open for the next stretch.  Only the last few containers of a range are left
with room.

A text longer than a container is cut into full containers and a rest; no other text is split.
Texts without tokens (null, empty) are in no container, repeated rows (id and text) are packed once,
other texts under one id are packed each.  An empty table gives no container."""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .words import scramble

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern the vocabulary was made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
BITS, DIMENSIONS = 10, 3


@lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of integer points [n, dimensions], by Skilling's transform."""
    x = points.astype(np.int64).T.copy()
    d, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) > 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[d - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_keys(token_lists: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys: each distinct token is hashed to a direction, their mean is the document."""
    flat = np.concatenate(token_lists).astype(np.uint64)
    starts = np.cumsum([0, *map(len, token_lists[:-1])])
    points = np.empty((len(token_lists), DIMENSIONS))
    for j in range(DIMENSIONS):
        h = scramble((flat + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j + 1))
        u = (h >> np.uint64(11)).astype(np.float64) / (1 << 53) - 0.5
        n = np.maximum(np.array(list(map(len, token_lists))), 1)
        points[:, j] = np.add.reduceat(u, starts) / n
    # means of many directions are small; the logistic curve spreads them over the grid
    grid = (1 / (1 + np.exp(-40 * points)) * ((1 << BITS) - 1)).astype(np.int64)
    return hilbert(grid)


def _tokens(ranks, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(ranks.value, pattern)
        kind = np.uint16 if enc.max_token_value < 1 << 16 else np.uint32
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lists, rows = [], []
            for i, t in enumerate(texts):
                if t:
                    ids = np.array(enc.encode_ordinary(t.encode("utf-8", "replace").decode("utf-8")), kind)
                    if len(ids):
                        lists.append(ids)
                        rows.append(i)
            if not rows:
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(curve_keys(lists)), pa.array([len(x) for x in lists], pa.int64()), pa.array([x.tobytes() for x in lists], pa.binary())],
                ["id", "curve", "n", "tokens"],
            )

    return run


class Packer:
    """Containers that are still open, and best fit into them."""

    def __init__(self, capacity: int, nearly: float = 0.985):
        self.capacity, self.closed_at = capacity, int(capacity * (1 - nearly))
        self.open: list[tuple[int, int]] = []  # (room, number), in order of room
        self.bins: dict[int, list] = {}
        self.count = 0

    def put(self, size: int, piece: tuple) -> None:
        at = bisect_left(self.open, (size, -1))
        if at < len(self.open):
            room, no = self.open.pop(at)
        else:
            room, no = self.capacity, self.count
            self.bins[no] = []
            self.count += 1
        self.bins[no].append(piece)
        insort(self.open, (room - size, no))

    def done(self, all_of_them: bool = False, keep: int = 64) -> list[tuple[int, list]]:
        """Containers to close: nearly full ones, and the fullest beyond ``keep``."""
        n = len(self.open) if all_of_them else max(bisect_left(self.open, (self.closed_at + 1, -1)), len(self.open) - keep)
        out = [(no, self.bins.pop(no)) for _, no in self.open[:n]]
        del self.open[:n]
        return out


def _pack(capacity: int, width: int, stretch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = Packer(capacity), TaskContext.get().partitionId() << 32
        waiting: list[tuple[int, tuple]] = []
        total, seen = 0, (None, set())

        def emit(closed: list[tuple[int, list]]) -> pa.RecordBatch:
            rows = {"container_id": [], "n_tokens": [], "n_items": [], "items": [], "tokens": []}
            for no, pieces in closed:
                rows["container_id"].append(base + no)
                rows["n_tokens"].append(sum(len(p[3]) for p in pieces) // width)
                rows["n_items"].append(len(pieces))
                rows["items"].append([{"id": p[0], "piece": p[1], "first_token": p[2], "n_tokens": len(p[3]) // width} for p in pieces])
                rows["tokens"].append(b"".join(p[3] for p in pieces))
            item = pa.struct([("id", pa.string()), ("piece", pa.int64()), ("first_token", pa.int64()), ("n_tokens", pa.int64())])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(item), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))

        def settle() -> None:
            waiting.sort(key=lambda x: -x[0])
            for size, piece in waiting:
                packer.put(size, piece)
            waiting.clear()

        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if seen[0] != key:
                    seen = (key, set())
                mark = hash(raw)
                if mark in seen[1]:
                    continue
                seen[1].add(mark)
                for piece, at in enumerate(range(0, len(raw), capacity * width)):
                    part = raw[at : at + capacity * width]
                    waiting.append((len(part) // width, (str(key), piece, at // width, part)))
                    total += len(part) // width
                if total >= stretch * capacity:
                    settle()
                    total = 0
                    if closed := packer.done():
                        yield emit(closed)
        settle()
        if closed := packer.done(all_of_them=True):
            yield emit(closed)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, vocabulary: str = VOCABULARY, pattern: str = PATTERN, stretch: int = 64) -> DataFrame:
    """(container_id, n_tokens, n_items, items, tokens): the filled containers.  ``items`` names the
    pieces in order (id as text), ``tokens`` holds their token ids as little-endian integers of 16
    bits (32, if the vocabulary needs them)."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        ranks = f.read()
    width = 2 if ranks.count(b"\n") < 1 << 16 else 4
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("id IS NOT NULL AND t IS NOT NULL")
    measured = staged(rows.mapInArrow(_tokens(spark.sparkContext.broadcast(ranks), pattern), f"id {rows.schema['id'].dataType.simpleString()}, curve long, n long, tokens binary"))
    ordered = measured.repartitionByRange("curve", "id").sortWithinPartitions("curve", "id").select("id", "tokens")
    return ordered.mapInArrow(_pack(capacity, width, stretch), "container_id long, n_tokens long, n_items long, items array<struct<id:string,piece:long,first_token:long,n_tokens:long>>, tokens binary")
