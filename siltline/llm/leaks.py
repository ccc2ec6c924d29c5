"""Evaluation texts inside a corpus (problem 9) by winnowing.

Every text becomes a sequence of word hashes.  Of each ``window`` successive k-grams of words the one
with the least hash is kept as a fingerprint, on both sides, so any shared span of ``k + window - 1``
words gives a common fingerprint.  A hit is extended: the runs of words that item and document
share, in order and within a stretch of ``stretch`` times the item's length, are chained, and a
document holds an item if the chained words are at least ``share`` of the item's words.  Words
outside a run of ``run`` shared words count only where they are all that lies between two runs on both
sides; chance agreements of single words do not add up to a hit.

The items are taken in blocks of bounded size (rows and characters); each block goes to the workers as one sorted array,
and the corpus is read once per block and never shuffled.  Fingerprints of the corpus stay in the
task that made them.  A fingerprint that more than ``stock`` items share (stock instructions) starts no
extension unless an item has hardly any other.  Items of fewer than ``k + window - 1`` words, for which
winnowing gives no guarantee, are searched by their exact word sequence too.

Null or empty texts and items give no row, a repeated row counts once, a tie of fingerprints in a
window keeps the last one, an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import WordHashes, scramble, words

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-grams that start at each word; none for a text shorter than k."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + (h[j : len(h) - k + 1 + j] ^ np.uint64(j + 1))
    return scramble(out)


def winnow(g: np.ndarray, window: int) -> np.ndarray:
    """Positions of the fingerprints: of each window the least, of equal ones the last."""
    n = len(g)
    if n == 0:
        return np.zeros(0, np.int64)
    if n <= window:
        return np.array([n - 1 - int(np.argmin(g[::-1]))])
    least, at = g[: n - window + 1].copy(), np.arange(n - window + 1)
    for j in range(1, window):
        other = g[j : n - window + 1 + j]
        less = other <= least
        least = np.where(less, other, least)
        at[less] = np.nonzero(less)[0] + j
    return np.unique(at)


def shared_runs(item: np.ndarray, doc: np.ndarray, run: int) -> list[tuple[int, int, int]]:
    """Maximal runs of at least ``run`` equal words as (start in doc, start in item, length)."""
    gi, gd = grams(item, run), grams(doc, run)
    if not len(gi) or not len(gd):
        return []
    order = np.argsort(gi, kind="stable")
    lo, hi = np.searchsorted(gi[order], gd, "left"), np.searchsorted(gi[order], gd, "right")
    open_runs: dict[int, tuple[int, int, int]] = {}
    out = []
    for p in np.nonzero(hi > lo)[0].tolist():
        for q in order[lo[p] : hi[p]].tolist():
            d = p - q
            last = open_runs.get(d)
            if last and last[0] + last[2] - run + 1 == p:
                open_runs[d] = (last[0], last[1], last[2] + 1)
            else:
                if last:
                    out.append(last)
                open_runs[d] = (p, q, run)
    return sorted([*out, *open_runs.values()])


def held(item: np.ndarray, doc: np.ndarray, run: int = 3, gap: int = 3, stretch: float = 2.0) -> int:
    """The most words of ``item`` that ``doc`` holds in order within one stretch."""
    runs, n = shared_runs(item, doc, run), len(item)
    best = 0
    limit = int(stretch * n)
    score = [0] * len(runs)
    begin = [0] * len(runs)
    for i, (p, q, length) in enumerate(runs):
        score[i], begin[i] = min(length, limit), p
        for j in range(i - 1, -1, -1):
            pp, qq, ll = runs[j]
            if p - pp > limit:
                break
            # overlapping ends are cut
            cut = max(0, pp + ll - p, qq + ll - q)
            if pp >= p or qq >= q or cut >= length or p + length - begin[j] > limit:
                continue
            between = min(p - pp - ll, q - qq - ll)
            filled = between if 0 < between and max(p - pp - ll, q - qq - ll) <= gap else 0
            if score[j] + length - cut + filled > score[i]:
                score[i], begin[i] = score[j] + length - cut + filled, begin[j]
        best = max(best, score[i])
    return best


def _items(rows: list, k: int, window: int, stock: int) -> dict:
    """A block of items as arrays: the sorted fingerprints with their items, and the items' words."""
    known, ids, texts, fps, exact = WordHashes(), [], [], [], {}
    for r in rows:
        h = known.of(words(r[1]))
        if len(h):
            if len(h) < k + window - 1:
                exact.setdefault(len(h), []).append((int(grams(h, len(h))[0]), len(ids)))
            ids.append(r[0])
            texts.append(h)
            g = grams(h, k)
            fps.append(np.unique(g[winnow(g, window)]))
    short = {n: (np.array([x[0] for x in sorted(found)], np.uint64), np.array([x[1] for x in sorted(found)])) for n, found in exact.items()}
    if not ids:
        return {"ids": [], "texts": [], "fp": np.zeros(0, np.uint64), "of": np.zeros(0, np.int64), "size": np.zeros(0, np.int64), "short": {}}
    fp, of = np.concatenate(fps), np.repeat(np.arange(len(ids)), [len(f) for f in fps])
    value, inverse, count = np.unique(fp, return_inverse=True, return_counts=True)
    common = count[inverse] > stock
    own = np.bincount(of[~common], minlength=len(ids))
    keep = ~common | (own * 2 < np.array([len(f) for f in fps]))[of]
    fp, of = fp[keep], of[keep]
    order = np.argsort(fp, kind="stable")
    return {"ids": ids, "texts": texts, "fp": fp[order], "of": of[order], "size": np.array([len(f) for f in fps]), "short": short}


def candidates(b: dict, g: np.ndarray, least: float = 0.08) -> list[int]:
    """Items that share a fingerprint and at least a twelfth of their own.  Half an item with every seventh
    word changed still has a fingerprint in each span of six words, a seventh of the item's own."""
    lo, hi = np.searchsorted(b["fp"], g, "left"), np.searchsorted(b["fp"], g, "right")
    hits = np.concatenate([b["of"][a:z] for a, z in zip(lo, hi)])
    item, n = np.unique(hits, return_counts=True)
    return item[n >= least * b["size"][item]].tolist()


def whole(b: dict, flat: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], int]:
    """(document, item) of the short items whose exact word sequence occurs, with its length."""
    out = {}
    for length, (value, of) in b["short"].items():
        g = grams(flat, length)
        lo, hi = np.searchsorted(value, g, "left"), np.searchsorted(value, g, "right")
        at = np.nonzero(hi > lo)[0]
        of_doc = np.searchsorted(ends, at, "right")
        inside = at + length <= ends[of_doc]
        for p, d in zip(at[inside].tolist(), of_doc[inside].tolist()):
            for i in of[lo[p] : hi[p]].tolist():
                out[d, i] = length
    return out


def _search(block, k: int, window: int, share: float, run: int, stretch: float):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, b = WordHashes(), block.value
        fp, of = b["fp"], b["of"]
        for batch in batches:
            docs, items, counts, of_item = [], [], [], []
            keys, lists = batch.column(0).to_pylist(), [words(t) for t in batch.column(1).to_pylist()]
            flat = known.of(list(chain.from_iterable(lists)))
            ends = np.cumsum([len(x) for x in lists])
            short = whole(b, flat, ends)
            for (d, i), n in short.items():
                docs.append(keys[d])
                items.append(b["ids"][i])
                counts.append(n)
                of_item.append(1.0)
            g = grams(flat, k)
            if len(g) and len(fp):
                # k-grams across two texts never win a window
                across = (ends[:-1, None] - np.arange(1, k)).ravel()
                g[across[(across >= 0) & (across < len(g))]] = EMPTY
                at = winnow(g, window)
                to = np.searchsorted(fp, g[at])
                to[to == len(fp)] = 0
                at = at[fp[to] == g[at]]
                of_doc = np.searchsorted(ends, at, "right")
                for d in np.unique(of_doc).tolist():
                    h = flat[ends[d] - len(lists[d]) : ends[d]]
                    for i in candidates(b, np.unique(g[at[of_doc == d]])):
                        if (d, i) in short:
                            continue
                        n = held(b["texts"][i], h, run, stretch=stretch)
                        if n >= share * len(b["texts"][i]):
                            docs.append(keys[d])
                            items.append(b["ids"][i])
                            counts.append(n)
                            of_item.append(n / len(b["texts"][i]))
            yield pa.RecordBatch.from_arrays([pa.array(docs, batch.column(0).type), pa.array(items, pa.int64()), pa.array(counts, pa.int64()), pa.array(of_item, pa.float64())], ["doc_id", "item_id", "n_words", "share"])

    return found


def leaked(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    k: int = 4, window: int = 3, share: float = 0.5, run: int = 3, stretch: float = 2.0, stock: int = 5, block: int = 20_000, block_chars: int = 20_000_000,
) -> DataFrame:
    """(doc_id, item_id, n_words, share): documents that hold an item, whole or in part."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("id IS NOT NULL AND t IS NOT NULL")
    schema = f"doc_id {rows.schema['id'].dataType.simpleString()}, item_id long, n_words long, share double"
    wanted = items.select(F.col(item_id_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").dropDuplicates()
    spark, out, part, chars = docs.sparkSession, None, [], 0

    def search(part: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(_items(part, k, window, stock))
        return rows.mapInArrow(_search(shared, k, window, share, run, stretch), schema)

    for r in wanted.orderBy("i").toLocalIterator():
        part.append(r)
        chars += len(r[1])
        if len(part) == block or chars >= block_chars:
            out, part, chars = (search(part) if out is None else out.unionByName(search(part))), [], 0
    if part or out is None:
        out = search(part) if out is None else out.unionByName(search(part))
    return out.dropDuplicates(["doc_id", "item_id"])
