"""Exact, fuzzy and semantic deduplication, and removal."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small, spread, staged, unstage


def shuffle_on(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows with equal keys in one partition."""
    return df.repartition(parts, *keys) if parts else df.repartition(*keys)


def exact_duplicates(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Ids to remove: of each group of equal texts all but the smallest id.

    Only hashes and ids are shuffled.  The group's smallest id is found with partial aggregation and
    joined back, so a group of a third of all rows is never sorted or held in one task."""
    rows = staged(df.select(F.col(id_col).alias("id"), F.md5(F.col(text_col)).alias("h")).where("h IS NOT NULL"))
    return with_least(rows, ["h"], "id", "keep").where("id <> keep").select(F.col("id").alias(id_col)).distinct()


def with_least(rows: DataFrame, keys: Sequence[str], of: str, name: str, broadcast_rows: int = 500_000) -> DataFrame:
    """Rows of groups with two different values of ``of`` or more, with the least as ``name``.

    The least values are aggregated partially and written before they are joined back: adaptive execution
    splits the rows of a hot key in a join of two tables that are read, not where one side is aggregated in
    the same plan.  They are broadcast if they are few."""
    least = rows.groupBy(*keys).agg(F.min(of).alias(name), F.max(of).alias("__top")).where(F.col(name) != F.col("__top")).drop("__top")
    return rows.join(small(staged(least), broadcast_rows), list(keys))


def remove(df: DataFrame, ids: DataFrame, id_col: str = "id", duplicate_id_col: str = "id", broadcast_rows: int = 1_000_000) -> DataFrame:
    """Rows whose id is not in ``ids``.  The ids are broadcast only if they are at most
    ``broadcast_rows``; beyond that both sides are shuffled and skewed keys split."""
    gone = staged(ids.select(F.col(duplicate_id_col).alias("__gone")).where("__gone IS NOT NULL").distinct())
    return df.join(small(gone, broadcast_rows), F.col(id_col) == F.col("__gone"), "left_anti")


# --- fuzzy ---------------------------------------------------------------------------------------

def permutations(hashes: int, seed: int) -> np.ndarray:
    """Odd multipliers: the upper half of a product with one is a random order of the n-grams."""
    return np.random.RandomState(seed).randint(1, 1 << 62, hashes, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def ngram_hashes(texts: list[str], ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of all texts in a row, and where each text's begin; a shorter text
    is one n-gram."""
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    # a text is as long as one n-gram at least, and the n-grams that reach into the next text are left out
    sizes = np.array([max(len(p), ngram) for p in parts], np.int64)
    ends = np.cumsum(sizes)
    flat = np.zeros(int(ends[-1]) + ngram if len(ends) else ngram, np.uint64)
    for p, e, n in zip(parts, ends.tolist(), sizes.tolist()):
        flat[e - n : e - n + len(p)] = p
    m = len(flat) - ngram
    power, h = np.uint64(0x9E3779B97F4A7C15), np.zeros(m, np.uint64)
    for j in range(ngram):  # a polynomial of the n-gram's characters, modulo 2**64
        h *= power
        h += flat[j : m + j]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    whole = np.ones(m, bool)
    for back in range(1, ngram):
        whole[ends - back] = False
    return h[whole], np.r_[0, np.cumsum(sizes - ngram + 1)[:-1]] if len(ends) else np.zeros(0, np.int64)


def minhash(texts: list[str], multipliers: np.ndarray, ngram: int) -> np.ndarray:
    """Signatures [text, hash] of the character n-grams: of each text the least of each permutation."""
    h, starts = ngram_hashes(texts, ngram)
    out, buffer = np.empty((len(texts), len(multipliers)), np.int64), np.empty_like(h)
    for j, m in enumerate(multipliers):
        np.multiply(h, m, out=buffer)
        out[:, j] = np.minimum.reduceat(buffer, starts) >> np.uint64(33)
    return out


def _signatures(hashes: int, ngram: int, seed: int, characters: int = 500_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = permutations(hashes, seed)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            begin, held = 0, 0
            for i, t in enumerate(texts):  # some texts at a time, so that what is hashed stays in the cache
                held += len(t)
                if held >= characters or i + 1 == len(texts):
                    made = minhash(texts[begin : i + 1], multipliers, ngram)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, hashes), pa.int32()), pa.array(made.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, i + 1 - begin), lists], ["id", "signature"])
                    begin, held = i + 1, 0

    return run


def minhash_signatures(df: DataFrame, id_col: str = "id", text_col: str = "text", hashes: int = 260, ngram: int = 24, seed: int = 42) -> DataFrame:
    """(id, signature) of every text that is not null."""
    rows = spread(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t IS NOT NULL"))
    return rows.mapInArrow(_signatures(hashes, ngram, seed), f"id {rows.schema['id'].dataType.simpleString()}, signature array<long>")


def lsh_edges(signatures: DataFrame, bands: int = 20, rows_per_band: int = 13) -> DataFrame:
    """(lo, hi) star edges: every member of a bucket with the bucket's smallest id.

    A star has the bucket's components with one edge per member, and it takes the bucket's minimum only,
    which partial aggregation gives; no bucket is collected."""
    band = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.slice("signature", i * rows_per_band + 1, rows_per_band)))
    keys = signatures.select("id", F.explode(band).alias("bucket"))
    return with_least(keys, ["bucket"], "id", "lo").where("id <> lo").select("lo", F.col("id").alias("hi")).distinct()


def lsh_buckets(signatures: DataFrame, bands: int = 20, rows_per_band: int = 13) -> DataFrame:
    """(band, bucket, id) of the buckets with two documents or more, as rows."""
    band = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.struct(i.alias("band"), F.xxhash64(i, F.slice("signature", i * rows_per_band + 1, rows_per_band)).alias("bucket")))
    keys = signatures.select("id", F.inline(band))
    return with_least(keys, ["band", "bucket"], "id", "lo").select("band", "bucket", "id")


def chain_edges(buckets: DataFrame, members_col: str = "ids") -> DataFrame:
    """(x, y) of neighbours in each bucket's array of members: one edge less than members."""
    ids = F.col(members_col)
    pairs = F.when(F.size(ids) > 1, F.transform(F.sequence(F.lit(1), F.size(ids) - 1), lambda i: F.struct(F.element_at(ids, i).alias("x"), F.element_at(ids, i + 1).alias("y"))))
    return buckets.select(F.inline(pairs)).distinct()


def stars(most: int = 1_000_000):
    """The links of a task as stars around the smallest members, at most ``most`` records at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def top(x):
            while (p := parent[x]) != x:
                parent[x] = x = parent[p]
            return x

        def made() -> pa.RecordBatch:
            members = [x for x in parent if top(x) != x]
            out = pa.RecordBatch.from_arrays([pa.array([parent[x] if parent[parent[x]] == parent[x] else top(x) for x in members], kind), pa.array(members, kind)], ["lo", "hi"])
            parent.clear()
            return out

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for lo, hi in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parent.setdefault(lo, lo)
                parent.setdefault(hi, hi)
                a, b = top(lo), top(hi)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > most:
                yield made()
        if parent:
            yield made()

    return run


def connected_components(edges: DataFrame, rounds: int = 60, staged_from: int = 1_000_000) -> DataFrame:
    """(id, group): the smallest id each id is connected to, for edges (lo, hi).

    Alternating large-star and small-star: in each round every vertex links its larger neighbours, then
    its smaller ones, to the smallest it knows.  Rows only; the smallest come from partial aggregation and
    are written before they are joined back, so that a hot vertex is split.  Each task first joins the edges
    it reads into stars."""
    kind = edges.schema["lo"].dataType.simpleString()
    if kind in ("string", "bigint", "int") and kind == edges.schema["hi"].dataType.simpleString():
        edges = edges.where("lo IS NOT NULL AND hi IS NOT NULL AND lo <> hi").select("lo", "hi").mapInArrow(stars(), f"lo {kind}, hi {kind}")
    now = staged(edges.where("lo <> hi").select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi")).distinct())
    before, edges_now = None, now.count()
    for _ in range(rounds):
        both = now.select(F.col("lo").alias("v"), F.col("hi").alias("u")).unionByName(now.select(F.col("hi").alias("v"), F.col("lo").alias("u")))
        hold = staged if edges_now > staged_from else lambda df: df  # a table this small has no hot vertex to split
        least = hold(both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m")))
        large = hold(both.join(least, "v").where("u > v AND u <> m").select(F.col("m").alias("lo"), F.col("u").alias("hi")).distinct())
        down = hold(large.groupBy("hi").agg(F.min("lo").alias("m")))
        linked = large.join(down, "hi").select(F.explode(F.array(F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")), F.struct(F.col("m").alias("lo"), F.col("hi").alias("hi")))).alias("e")).select("e.lo", "e.hi").where("lo <> hi")
        old, now = now, staged(linked.distinct())
        for table in (old, least, large, down) if hold is staged else (old,):
            unstage(table)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi"))).first()
        edges_now = state[0]
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"not stable after {rounds} rounds")
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("group")).unionByName(now.select(F.col("lo").alias("id"), F.col("lo").alias("group")).distinct())


def fuzzy_duplicates(df: DataFrame, id_col: str = "id", text_col: str = "text", ngram: int = 24, bands: int = 20, rows_per_band: int = 13, seed: int = 42) -> DataFrame:
    """(id, group) of documents that share a bucket, directly or through others.  Equal texts are
    signed once: only their smallest id goes through the hashing."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    keys = staged(rows.select("id", F.md5("t").alias("h")))
    copies = staged(with_least(keys, ["h"], "id", "keep").where("id <> keep").select(F.col("keep").alias("lo"), F.col("id").alias("hi")))
    once = rows.join(small(copies.select(F.col("hi").alias("id")), 1_000_000), "id", "left_anti")
    signed = staged(minhash_signatures(once, "id", "t", bands * rows_per_band, ngram, seed))
    return connected_components(lsh_edges(signed, bands, rows_per_band).unionByName(copies))


def duplicates_of_groups(groups: DataFrame, id_col: str = "id", group_col: str = "group") -> DataFrame:
    """Ids to remove: all but the smallest of each group."""
    return with_least(groups, [group_col], id_col, "__keep").where(F.col(id_col) != F.col("__keep")).select(id_col)


# --- semantic ------------------------------------------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def unit(vector: Column) -> Column:
    """At length 1; null for null and all-zero vectors."""
    norm = F.sqrt(dot(vector, vector))
    return F.when(norm > 0, F.transform(vector, lambda x: x.cast("double") / norm))


def k_means(df: DataFrame, k: int = 100, vector_col: str = "embeddings", iterations: int = 300, tolerance: float = 1e-4, seed: int = 42) -> DataFrame:
    """Add ``centroid``, ``l2_dist_to_cent`` and ``cosine_dist_to_cent`` of the vectors at length 1."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = df.withColumn("__unit", unit(F.col(vector_col))).where("__unit IS NOT NULL").withColumn("__v", array_to_vector("__unit"))
    model = KMeans(k=k, featuresCol="__v", predictionCol="centroid", maxIter=iterations, tol=tolerance, seed=seed, initMode="k-means||").fit(rows.select("__v"))
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    out = model.transform(rows).withColumn("__c", F.element_at(centres, F.col("centroid") + 1))
    apart = F.zip_with("__unit", "__c", lambda x, y: x - y)
    return out.withColumn("l2_dist_to_cent", F.sqrt(dot(apart, apart))).withColumn("cosine_dist_to_cent", 1 - dot(F.col("__unit"), unit(F.col("__c")))).drop("__unit", "__v", "__c")


Order = Sequence[tuple[str, "str | Column"]]


def ranked(which: str = "hard", by: str = "cosine_dist_to_cent", id_col: str = "id", seed: int = 42) -> Order:
    """The order within a cluster, as (direction, column): far from the centre first, near first, or random."""
    if which == "random":
        return (("asc", F.xxhash64(F.col(id_col), F.lit(seed))), ("asc", id_col))
    if which not in ("hard", "easy"):
        raise ValueError("which must be hard, easy or random")
    direction = "desc" if which == "hard" else "asc"
    return ((direction, by), (direction, id_col))


def _directions(order: Order) -> list[Callable]:
    return [{"asc": F.asc, "desc": F.desc}[direction] for direction, _ in order]


def _bare(order: Order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for _, c in order]


def pairwise_similarity(df: DataFrame, order: Order, id_col: str = "id", vector_col: str = "embeddings", cluster_col: str = "centroid", block: int = 4096) -> DataFrame:
    """(id, max_id, cosine_sim_score): for each vector the most similar of those ranked before it in its
    cluster, at least 0; the first of a cluster gets itself and 0.

    A cluster is cut into blocks of ranks, and a task compares a block with one that comes no later, so
    a task's memory is two blocks whatever the size of the cluster."""
    keyed = df.select(F.col(id_col).alias("id"), F.col(cluster_col).alias("c"), unit(F.col(vector_col)).alias("v"), *[o.alias(f"__o{i}") for i, o in enumerate(_bare(order))]).where("v IS NOT NULL")
    keyed = staged(keyed.withColumn("__vec", F.monotonically_increasing_id()))
    by = [F.asc("c") if c is None else c for c in (None, *(d(f"__o{i}") for i, d in enumerate(_directions(order))))]
    # ranks within a cluster without a window: rows are range-sorted by cluster and rank key, numbered, and a
    # cluster's first number taken off; the vectors, which were not sorted, are joined by row
    sorted_ids = numbered(keyed.drop("v", "id"), "r", by).select("__vec", "c", "r")
    first = small(staged(sorted_ids.groupBy("c").agg(F.min("r").alias("first"), F.count("*").alias("n"))), 1_000_000)
    places = sorted_ids.join(first, "c").select("__vec", (F.col("r") - F.col("first")).alias("r"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    ranks = staged(keyed.select("__vec", "id", "c", "v").join(places, "__vec").drop("__vec").withColumn("b", F.floor(F.col("r") / block).cast("int")))
    left = ranks.select("c", F.col("b").alias("b1"), F.explode(F.sequence(F.lit(0), F.col("b"))).alias("b2"), "id", "r", "v")
    right = ranks.select(F.col("c").alias("c_"), F.explode(F.sequence(F.col("b"), F.col("blocks") - 1)).alias("b1_"), F.col("b").alias("b2_"), F.col("id").alias("id_"), F.col("r").alias("r_"), F.col("v").alias("v_"))
    kind = df.schema[id_col].dataType.simpleString()

    def best(one: pa.Table, two: pa.Table) -> pa.Table:
        r1, r2 = one["r"].to_numpy(), two["r_"].to_numpy()
        x, y = (np.array(v.combine_chunks().flatten().to_numpy(), np.float32).reshape(len(v), -1) for v in (one["v"], two["v_"]))
        o = np.argsort(r2, kind="stable")
        sims = np.where(r2[o][None, :] < r1[:, None], x @ y[o].T, np.float32(0))
        at = sims.argmax(1)
        top = sims[np.arange(len(at)), at]
        ids = two["id_"].combine_chunks().take(pa.array(o[at]))
        return pa.table({"id": one["id"].combine_chunks(), "max_id": ids, "s": pa.array(top.astype(np.float64)), "r2": pa.array(r2[o][at].astype(np.int32))})

    compared = left.groupBy("c", "b1", "b2").cogroup(right.groupBy("c_", "b1_", "b2_")).applyInArrow(best, f"id {kind}, max_id {kind}, s double, r2 int")
    chosen = compared.groupBy("id").agg(F.max_by(F.struct("max_id", "s"), F.struct("s", -F.col("r2"))).alias("m"))
    none = F.col("m.s") <= 0
    return chosen.select("id", F.when(none, F.col("id")).otherwise(F.col("m.max_id")).alias("max_id"), F.when(none, F.lit(0.0)).otherwise(F.col("m.s")).cast("float").alias("cosine_sim_score"))


def similar_ids(pairs: DataFrame, eps: float = 0.01, id_col: str = "id", score_col: str = "cosine_sim_score") -> DataFrame:
    """Ids whose similarity is at least 1 - eps."""
    return pairs.where(F.col(score_col) >= F.lit(1 - eps).cast(pairs.schema[score_col].dataType)).select(id_col).distinct()


@dataclass
class Result:
    """What a workflow found: tables by name and counts by name."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)


def exact_workflow(df: DataFrame, id_col: str = "id", text_col: str = "text", perform_removal: bool = False) -> Result:
    gone = staged(exact_duplicates(df, id_col, text_col))
    out = Result({"duplicates": gone}, {"duplicates": gone.count()})
    if perform_removal:
        out.tables["kept"] = remove(df, gone, id_col, id_col)
    return out


def fuzzy_workflow(df: DataFrame, id_col: str = "id", text_col: str = "text", ngram: int = 24, bands: int = 20, rows_per_band: int = 13, seed: int = 42, perform_removal: bool = False) -> Result:
    groups = staged(fuzzy_duplicates(df, id_col, text_col, ngram, bands, rows_per_band, seed))
    gone = staged(duplicates_of_groups(groups))
    out = Result({"groups": groups, "duplicates": gone}, {"groups": groups.select("group").distinct().count(), "duplicates": gone.count()})
    if perform_removal:
        out.tables["kept"] = remove(df, gone, id_col, "id")
    return out


def semantic_workflow(df: DataFrame, id_col: str = "id", vector_col: str = "embeddings", clusters: int = 100, eps: float = 0.01, which: str = "hard", seed: int = 42, iterations: int = 300, perform_removal: bool = False) -> Result:
    placed = staged(k_means(df, clusters, vector_col, iterations, seed=seed))
    pairs = staged(pairwise_similarity(placed, ranked(which, id_col=id_col, seed=seed), id_col, vector_col))
    gone = staged(similar_ids(pairs, eps))
    out = Result({"clusters": placed, "pairs": pairs, "duplicates": gone}, {"duplicates": gone.count()})
    if perform_removal:
        out.tables["kept"] = remove(df, gone, id_col, "id")
    return out


# --- ids -----------------------------------------------------------------------------------------


def numbered(df: DataFrame, id_col: str = "_dedup_id", order: Sequence[str | Column] | None = None) -> DataFrame:
    """Add consecutive numbers from 0.  Partitions are counted first and numbered by their offsets, so
    nothing is gathered; with ``order`` the rows are range-sorted by it."""
    rows = df.orderBy(*order) if order else df
    held = staged(rows.withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()))
    counts = held.groupBy("__part").count().orderBy("__part").collect()
    offsets, total = [], 0
    for r in counts:
        offsets.append((r["__part"], total))
        total += r["count"]
    table = df.sparkSession.createDataFrame(offsets or [(0, 0)], "__part int, __offset long")
    inside = F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    return held.join(F.broadcast(table), "__part").withColumn(id_col, F.col("__offset") + inside).drop("__part", "__row", "__offset")


class IdRegistry:
    """Ranges of ids by set of files, the same for the same files."""

    def __init__(self, next_id: int = 0, ranges: dict[str, tuple[int, int]] | None = None):
        self.next_id, self.ranges = next_id, dict(ranges or {})

    @staticmethod
    def key(files: Sequence[str]) -> str:
        import uuid

        return str(uuid.uuid5(uuid.NAMESPACE_URL, ";".join(sorted(files))))

    def register(self, files: Sequence[str], rows: int) -> int:
        """The first id of the range; a set of files that is known keeps its range."""
        key = self.key(files)
        if key not in self.ranges:
            self.ranges[key] = (self.next_id, self.next_id + rows - 1)
            self.next_id += rows
        return self.ranges[key][0]

    def range_of(self, files: Sequence[str]) -> tuple[int, int]:
        return self.ranges[self.key(files)]

    def save(self, path: str) -> None:
        import json

        with open(path, "w") as f:
            json.dump({"next_id": self.next_id, "batch_registry": {k: list(v) for k, v in self.ranges.items()}}, f)

    @classmethod
    def load(cls, path: str) -> IdRegistry:
        import json

        with open(path) as f:
            d = json.load(f)
        return cls(d["next_id"], {k: tuple(v) for k, v in d["batch_registry"].items()})
