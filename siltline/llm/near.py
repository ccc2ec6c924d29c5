"""Near-duplicate records (problem 7) by covering locality-sensitive hashing.

A document is the set of its word shingles.  Its sketch holds ``4 * 8`` minima of hash functions;
two documents agree in a coordinate with a probability equal to their Jaccard similarity.  Each of
the four groups of eight coordinates is taken as the points of the affine space AG(3,2); its
fourteen planes are the bit masks.  Any three points lie in a common plane, whose complement is a
plane too, so two sketches that differ in at most three coordinates of any group certainly agree on
the four coordinates of some mask and meet in that table; by the pigeonhole principle that covers
every pair that differs in at most 15 of the 32 coordinates.  A pair of similarity 0.6 meets with
probability 0.98, one of 0.7 with 0.999.  What meets is then checked exactly on the shingle sets.

Copies (equal word sequences) form a class first; only one row per class goes on, and the copies' sketches
are never brought together.  The join in the
tables streams its pairs and is split where a table's bucket is skewed, so no bucket is held in
one task; no bucket is capped.

A null or blank text has no row.  A text shorter than a shingle counts as one shingle.  Repeated
rows count once.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small, staged
from .groups import hash_to_min
from .words import WordHashes, scramble, shingles, words

GROUPS, WIDTH = 4, 8
PLANES = np.array([p for p in combinations(range(WIDTH), 4) if p[0] ^ p[1] ^ p[2] ^ p[3] == 0])
SEEDS = scramble(np.arange(1, GROUPS * WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def sketch(shingle: np.ndarray) -> np.ndarray:
    """GROUPS * WIDTH minima, 32 bits each."""
    return np.array([((shingle * s) >> np.uint64(32)).min() for s in SEEDS], np.uint32)


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, cls, sketches, sets = [], [], [], []
            arrays = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ws = words(text)
                if ws:
                    h = known.of(ws)
                    s = shingles(h, size)
                    ids.append(key)
                    cls.append(int(scramble(np.bitwise_xor.accumulate(h * np.arange(1, 2 * len(h), 2, dtype=np.uint64))[-1:] + np.uint64(len(h)) * h[:1])[0].astype(np.int64)))
                    arrays.append(s)
            if not ids:
                continue
            flat, starts = np.concatenate(arrays), np.cumsum([0, *map(len, arrays[:-1])])
            minima = np.stack([np.minimum.reduceat((flat * s) >> np.uint64(32), starts) for s in SEEDS], 1).astype(np.uint32)
            short = (flat >> np.uint64(16)).astype(np.uint32)
            for i, a in enumerate(arrays):
                sets.append(np.unique(short[starts[i] : starts[i] + len(a)]).tobytes())
            sketches = [row.tobytes() for row in minima]
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(cls, pa.int64()), pa.array(sketches, pa.binary()), pa.array(sets, pa.binary())], ["id", "cls", "sketch", "shingles"])

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and table: the hash of the four coordinates that the mask keeps."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        minima = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, GROUPS, WIDTH).astype(np.uint64)
        out = np.empty((n, GROUPS, len(PLANES)), np.uint64)
        for p, plane in enumerate(PLANES):
            h = np.zeros((n, GROUPS), np.uint64)
            for c in plane:
                h = scramble(h * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, c])
            out[:, :, p] = h + (np.arange(GROUPS, dtype=np.uint64) * np.uint64(len(PLANES)) + np.uint64(p)) * np.uint64(0xC2B2AE3D27D4EB4F)
        cls = np.repeat(batch.column(0).to_numpy(), GROUPS * len(PLANES))
        yield pa.RecordBatch.from_arrays([pa.array(scramble(out.ravel()).view(np.int64)), pa.array(cls)], ["key", "cls"])


def _jaccard(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sims = [], []
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                a, b = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                if min(len(a), len(b)) < least * max(len(a), len(b)):
                    continue
                both = np.concatenate([a, b])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                sim = common / (len(both) - common)
                if sim >= least:
                    keep.append(i)
                    sims.append(sim)
            part = batch.select([0, 1]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sims, pa.float64())], ["a", "b", "similarity"])

    return run


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): ``members`` (id, cls, rep, n) gives each document its class of copies, the
    class's smallest id and size; ``pairs`` (a, b, similarity) links classes of different texts."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("id IS NOT NULL AND t IS NOT NULL")
    made = staged(rows.mapInArrow(_sketches(shingle), rows.select("id").schema.simpleString()[7:-1].replace(":", " ") + ", cls long, sketch binary, shingles binary"))
    ids = made.select("id", "cls").dropDuplicates()
    classes = staged(ids.groupBy("cls").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    members = ids.join(classes, "cls")
    # one row per class: rows of texts that occur once need no lookup, so only the copied classes are joined
    copied = small(staged(classes.where("n > 1")), 500_000)
    left_out = staged(ids.join(copied, "cls").where("id <> rep").select("id", "cls"))
    reps = made.join(small(left_out, 500_000), ["id", "cls"], "left_anti")
    keys = reps.select("cls", "sketch").mapInArrow(_keys, "key long, cls long")
    left, right = keys.toDF("key", "a"), keys.toDF("key", "b")
    met = staged(left.join(right, "key").where("a < b").select("a", "b").distinct())
    near = met.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    # staged, as all sides of joins on classes, so that a class with a great part of the pairs is split
    sets = staged(reps.select("cls", "shingles").join(near, "cls", "left_semi").dropDuplicates(["cls"]))
    both = met.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    return members, both.mapInArrow(_jaccard(similarity), "a long, b long, similarity double")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, group_id) of every document with words: all that are linked directly or indirectly have the
    smallest id among them as their group's."""
    members, pairs = near_duplicates(df, id_col, text_col, shingle, similarity)
    members = staged(members)
    linked = hash_to_min(pairs.select(F.col("a").alias("lo"), F.col("b").alias("hi"))).toDF("top", "cls")
    tops = staged(linked.unionByName(linked.select("top", F.col("top").alias("cls")).distinct()))
    reps = members.select("cls", "rep").distinct()
    leads = staged(tops.join(reps, "cls").groupBy("top").agg(F.min("rep").alias("group_id")))
    of_class = staged(tops.join(leads, "top").select("cls", "group_id"))
    return members.join(of_class, "cls", "left").select("id", F.coalesce("group_id", "rep").alias("group_id"))


def near_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, expand: int = 1000) -> DataFrame:
    """Pairs (``lo``, ``hi``) of documents at or above the similarity, copies among them.

    A class of more than ``expand`` copies is linked as a star to its smallest id, and only that id
    stands for it in pairs with other classes; no link between different texts is lost."""
    members, pairs = near_duplicates(df, id_col, text_col, shingle, similarity)
    members, pairs = staged(members), staged(pairs)
    sides = members.where(F.col("n").between(1, expand) | (F.col("id") == F.col("rep"))).select("cls", "id")
    across = pairs.select("a", "b").join(sides.toDF("a", "x"), "a").join(sides.toDF("b", "y"), "b").select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))
    copies = members.where(F.col("n").between(2, expand)).select("cls", "id")
    within = copies.toDF("cls", "lo").join(copies.toDF("cls", "hi"), "cls").where("lo < hi").select("lo", "hi")
    star = members.where((F.col("n") > expand) & (F.col("id") != F.col("rep"))).select(F.col("rep").alias("lo"), F.col("id").alias("hi"))
    return across.unionByName(within).unionByName(star)
