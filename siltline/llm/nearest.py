"""The k most similar vectors of every vector (problem 2): inverted file with product quantisation.

Coarse centroids and the codebooks of the residuals are fitted on a bounded sample (``train`` rows,
chosen by a hash of the id, or ``LEAST`` a list); every vector is indexed.  There are as many lists as give
``list_size`` vectors each; a list that would hold more than twice its share of the sample is split into
further ones.  A vector is in the list of its nearest centroid.  Its neighbours are looked for in its own
list, where all vectors are at hand and the similarity is exact, and in the other lists whose centroids are
nearest to the vector itself: as many as 0.7 times the square root of the number of lists, ``probe`` at least.
To these only the vector's code goes.  The asymmetric distance of a code to the vectors of a list is the
sum of table entries, one per sub-space; for the codes of a list together these sums are the product of
the vectors with the decoded codes, and they are computed as that.  A vector whose estimate comes within
the estimate's error of the fifth best known so far is requested, fetched, and the similarity is computed
exactly.

What is known of a list's vectors is written once, in buckets by list, and every later step reads it where it lies.  Shuffled are
each vector once, its code once for each list probed and the vectors requested.  Of more than ``k + 1``
equal vectors in a batch the rest follow the first: their nearest are copies of themselves.

Unusable vectors (null, wrong length, not finite, all zero) have no row.  Repeated rows count once.
Ties go to the smaller id.  With k or fewer usable vectors all the others come.  An empty table
gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bucketed

SUB, LEAST, LISTS_A_BUCKET = 32, 4, 4


def usable(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of usable vectors and the vectors at length 1."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    at = np.nonzero(sizes == dim)[0]
    if not len(at):
        return at, np.zeros((0, dim), np.float32)
    flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    norm = np.sqrt((flat * flat).sum(1))
    good = np.isfinite(norm) & (norm > 0)
    return at[good], (flat[good] / norm[good, None]).astype(np.float32)


def _closest(x: np.ndarray, c: np.ndarray, cells: int = 16_000_000) -> np.ndarray:
    """The nearest centroid of each vector, in blocks that bound the matrix of distances."""
    half, block = (c * c).sum(1) / 2, max(1, cells // len(c))
    return np.concatenate([(x[b : b + block] @ c.T - half).argmax(1) for b in range(0, len(x), block)]) if len(x) else np.zeros(0, np.int64)


def k_means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's centroids; an empty cluster keeps its centroid."""
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        a = _closest(x, c)
        n = np.bincount(a, minlength=k)
        total = np.stack([np.bincount(a, x[:, j], k) for j in range(x.shape[1])], 1)
        c[n > 0] = (total[n > 0] / n[n > 0, None]).astype(np.float32)
    return c


class Index:
    """Centroids, how many lists a vector probes, codebooks and the estimate's error."""

    def __init__(self, sample: np.ndarray, lists: int, probe: int, seed: int = 7):
        self.c = k_means(sample, lists, 12, seed)
        own = self.assign(sample)
        n, share = np.bincount(own, minlength=lists), len(sample) / lists
        more = [k_means(sample[own == j], int(min(n[j], np.ceil(n[j] / share))), 6, seed) for j in np.nonzero(n > 2 * share)[0]]
        if more:
            self.c = np.concatenate([self.c[n <= 2 * share], *more])
            lists = len(self.c)
        self.probe = min(lists - 1, max(probe, round(0.7 * lists**0.5)))
        rest = sample - self.c[self.assign(sample)]
        self.width = sample.shape[1] // SUB if sample.shape[1] % SUB == 0 else sample.shape[1]
        subs = sample.shape[1] // self.width
        k = min(256, len(sample))
        self.books = [k_means(rest[:50_000, s * self.width : (s + 1) * self.width], min(k, len(rest[:50_000])), 6, seed + s) for s in range(subs)]
        few = sample[:2000]
        lost = self.decode(self.assign(few), self.encode(few)) - few
        self.error = float(np.quantile(np.abs(few @ lost.T), 0.998)) if len(few) else 0.0

    def assign(self, x: np.ndarray) -> np.ndarray:
        return _closest(x, self.c)

    def probes(self, x: np.ndarray, home: int) -> np.ndarray:
        """The lists to search for each vector of a list, nearest to the vector, without the list itself."""
        near = x @ self.c.T - (self.c * self.c).sum(1) / 2
        near[:, home] = -np.inf
        return np.argpartition(-near, self.probe - 1, axis=1)[:, : self.probe] if self.probe else np.zeros((len(x), 0), np.int64)

    def encode(self, x: np.ndarray) -> np.ndarray:
        rest, w = x - self.c[self.assign(x)], self.width
        return np.stack([(rest[:, s * w : (s + 1) * w] @ b.T - (b * b).sum(1) / 2).argmax(1) for s, b in enumerate(self.books)], 1).astype(np.uint8)

    def decode(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.c[lists] + np.concatenate([b[codes[:, s]] for s, b in enumerate(self.books)], 1)


def _place(index, dim: int, k: int):
    """(list, id, vector, key, follows): follows is the hash of the vector for copies beyond k + 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for batch in batches:
            at, x = usable(batch.column(1), dim)
            if not len(at):
                continue
            ids = batch.column(0).take(pa.array(at)).to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            keys = (x.view(np.uint32).astype(np.uint64) * (np.arange(1, 2 * dim, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))).sum(1).view(np.int64)
            by = np.argsort(keys, kind="stable")
            first = np.searchsorted(keys[by], keys[by], "left")
            nth = np.empty(len(by), np.int64)
            nth[by] = np.arange(len(by)) - first
            follows = nth > k
            yield pa.RecordBatch.from_arrays(
                [pa.array(ix.assign(x).astype(np.int32)), pa.array(ids), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(keys), pa.array(follows)],
                ["list", "id", "vector", "key", "follows"],
            )

    return run


def _matrix(column: pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _best(sims: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Positions of the k greatest of each row, ties by the smaller id."""
    n = sims.shape[1]
    if n <= k:
        return [np.lexsort((ids, -row.round(6))) for row in sims]
    fifth = np.partition(sims, n - k, axis=1)[:, n - k]
    out = []
    for row, t in zip(sims, fifth):
        c = np.nonzero(row >= t - 1e-6)[0]
        out.append(c[np.lexsort((ids[c], -row[c].round(6)))][:k])
    return out


def _worth_asking(r: np.ndarray, estimate: np.ndarray, error: float, k: int) -> np.ndarray:
    """Which vectors may still be among the k best of their query ``r`` (ascending), given what the
    others are at least worth."""
    keep = np.ones(len(r), bool)
    starts = np.nonzero(np.r_[True, r[1:] != r[:-1]])[0] if len(r) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(r)]
    for a, z in zip(starts[ends - starts > k], ends[ends - starts > k]):
        mine = estimate[a:z]
        keep[a:z] = mine > np.partition(mine, len(mine) - k)[len(mine) - k] - 2 * error
    return keep


def _own_list(index, dim: int, k: int, cells: int = 8_000_000):
    """Per list, a row for each of its vectors: the exact neighbours within it, the k-th best similarity so
    far, the code and the lists it probes.  Vectors that follow another pass through without."""

    def run(key: tuple, placed: pa.Table) -> pa.Table:
        ix, home_list = index.value, int(key[0].as_py())
        follows = placed["follows"].combine_chunks()
        late, home = placed.filter(follows), placed.filter(pc.invert(follows))
        ids, first = np.unique(home["id"].to_numpy(), return_index=True)
        x = _matrix(home["vector"], np.float32, dim)[first]
        near, sims_of, floors, codes, probes = [], [], [], [], []
        block = max(16, min(512, cells // max(1, len(ids), len(ix.c))))  # bounds the matrix of similarities
        for b in range(0, len(ids), block):
            q = x[b : b + block]
            sims = q @ x.T
            sims[np.arange(len(q)), np.arange(b, b + len(q))] = -2
            floor = np.full(len(q), -1.0, np.float32)
            for r, c in enumerate(_best(sims, ids, k)):
                c = c[sims[r, c] > -2]
                near.append(ids[c])
                sims_of.append(sims[r, c])
                if len(c) == k:
                    floor[r] = sims[r, c[-1]]
            floors += floor.tolist()
            codes += [v.tobytes() for v in ix.encode(q)]
            probes += ix.probes(q, home_list).tolist()
        n, m = len(ids), late.num_rows
        none = [None] * m
        return pa.table({
            "list": pa.array(np.full(n + m, home_list), pa.int32()), "id": pa.array(np.concatenate([ids, late["id"].to_numpy()])), "vector": pa.array([v.tobytes() for v in x] + none, pa.binary()),
            "key": pa.array(np.concatenate([home["key"].to_numpy()[first], late["key"].to_numpy()])), "follows": pa.array(np.arange(n + m) >= n), "floor": pa.array(floors + none, pa.float32()), "code": pa.array(codes + none, pa.binary()),
            "lists": pa.array(probes + none, pa.list_(pa.int32())), "near": pa.array(near + none, pa.list_(pa.int64())), "sims": pa.array(sims_of + none, pa.list_(pa.float32())),
        })

    return run


def _probed(index, dim: int, k: int, cells: int = 8_000_000):
    """Per list: its vectors that may be among the k best of the vectors whose codes came."""

    def run(key: tuple, codes: pa.Table, home: pa.Table) -> pa.Table:
        ix = index.value
        out: list[list] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)], [np.zeros(0, np.int32)]]
        if codes.num_rows and home.num_rows:
            ids, first = np.unique(home["id"].to_numpy(), return_index=True)
            x = _matrix(home["vector"], np.float32, dim)[first]
            q, floor, of = (codes[c].to_numpy() for c in ("q", "floor", "home"))
            code = _matrix(codes["code"], np.uint8, len(ix.books))
            block = max(16, min(512, cells // len(ids)))  # bounds the matrix of estimates
            for b in range(0, len(q), block):
                at = slice(b, b + block)
                estimate = ix.decode(of[at], code[at]).astype(np.float32) @ x.T
                r, c = np.nonzero(estimate > (floor[at] - ix.error)[:, None])
                keep = _worth_asking(r, estimate[r, c], ix.error, k)
                r, c = r[keep], c[keep]
                for o, v in zip(out, (q[at][r], ids[c], estimate[r, c], of[at][r])):
                    o.append(v)
        made = [np.concatenate(o) for o in out]
        return pa.table({
            "q": pa.array(made[0], pa.int64()), "n": pa.array(made[1], pa.int64()), "estimate": pa.array(made[2], pa.float32()),
            "home": pa.array(made[3], pa.int32()), "of_list": pa.array(np.full(len(made[0]), codes["to_list"][0].as_py() if codes.num_rows else 0), pa.int32()),
        })

    return run


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and the row of each."""
    lists = lists.combine_chunks()
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())


def _requests(index, k: int):
    """Per home list: of what the lists probed offer, the vectors that may still be among the k best,
    given the neighbours known and what the other offers are at least worth."""

    def run(key: tuple, offered: pa.Table, known: pa.Table) -> pa.Table:
        error, asks = index.value.error, offered["q"].to_numpy()
        sims, row = _flat(known["sims"])
        q = np.concatenate([asks, known["q"].to_numpy()[row]])
        sure = np.concatenate([offered["estimate"].to_numpy() - error, sims])
        order = np.lexsort((-sure, q))
        ids, first, n = np.unique(q[order], return_index=True, return_counts=True)
        least = np.where(n >= k, sure[order[np.minimum(first + k, len(q)) - 1]], -np.inf) if len(ids) else np.zeros(0)
        keep = offered["estimate"].to_numpy() > least[np.searchsorted(ids, asks)] - error
        return offered.select(["q", "n", "home", "of_list"]).filter(pa.array(keep))

    return run


def _fetch(dim: int):
    """Per list: the vectors asked for, once for each list that asks, with the queries they are for."""

    def run(key: tuple, asked: pa.Table, home: pa.Table) -> pa.Table:
        if not asked.num_rows or not home.num_rows:
            return pa.table({"home": pa.array([], pa.int32()), "n": pa.array([], pa.int64()), "vector": pa.array([], pa.binary()), "queries": pa.array([], pa.list_(pa.int64()))})
        ids = home["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        q, n, of = (asked[c].to_numpy() for c in ("q", "n", "home"))
        by = np.lexsort((q, n, of))
        q, n, of = q[by], n[by], of[by]
        first = np.nonzero(np.r_[True, (n[1:] != n[:-1]) | (of[1:] != of[:-1])])[0]
        at = order[np.searchsorted(ids[order], n[first])]
        queries = pa.ListArray.from_arrays(pa.array(np.r_[first, len(q)], pa.int32()), pa.array(q))
        return pa.table({"home": pa.array(of[first], pa.int32()), "n": pa.array(n[first]), "vector": home["vector"].take(pa.array(at)), "queries": queries})

    return run


def _final(dim: int, k: int):
    """Per home list: the k best of each of its vectors, of those known and those fetched."""

    def run(key: tuple, fetched: pa.Table, home: pa.Table) -> pa.Table:
        if not home.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "similarity": pa.array([], pa.float32())})
        ids = home["id"].to_numpy()
        near, row = _flat(home["near"])
        q, n, s = ids[row], near, _flat(home["sims"])[0]
        if fetched.num_rows:
            order = np.argsort(ids, kind="stable")
            asked, of = _flat(fetched["queries"])
            at, v = order[np.searchsorted(ids[order], asked)], _matrix(fetched["vector"], np.float32, dim)
            x = _matrix(home["vector"], np.float32, dim)
            exact = np.concatenate([np.einsum("ij,ij->i", x[at[b : b + 65536]], v[of[b : b + 65536]]) for b in range(0, len(at), 65536)])
            q, n, s = np.concatenate([q, asked]), np.concatenate([n, fetched["n"].to_numpy()[of]]), np.concatenate([s, exact.astype(np.float32)])
        order = np.lexsort((n, -s.round(6), q))
        q, n, s = q[order], n[order], s[order]
        same = np.zeros(len(q), bool)  # a vector is in one list only, so a pair can come once only but for repeats
        same[1:] = (q[1:] == q[:-1]) & (n[1:] == n[:-1])
        q, n, s = q[~same], n[~same], s[~same]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        return pa.table({"q": pa.array(q[rank < k]), "n": pa.array(n[rank < k]), "similarity": pa.array(s[rank < k], pa.float32())})

    return run


def nearest(df: DataFrame, id_col: str = "id", vector_col: str = "embeddings", k: int = 5, dim: int = 64, list_size: int = 3000, probe: int = 3, train: int = 20_000) -> DataFrame:
    """(q, n, similarity): for each usable vector its ``k`` most similar others by cosine.

    ``probe`` is the least number of further lists searched.  ``train`` bounds the sample of the fit, ``LEAST`` rows
    a list if there are many lists."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    total = rows.count()
    lists = int(max(1, total // list_size))
    train = max(train, LEAST * lists)
    share = min(1_000_000, int(1.3e6 * train / max(total, 1)) + 1)
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share).orderBy(F.xxhash64("id"), "id").limit(train).toArrow()
    x = usable(sample["v"], dim)[1]
    if not len(x):
        return spark.createDataFrame([], "q long, n long, similarity float")
    index = Index(x, min(lists, len(x)), probe)
    lists, index = len(index.c), spark.sparkContext.broadcast(index)
    placed = rows.mapInArrow(_place(index, dim, k), "list int, id long, vector binary, key long, follows boolean")
    # buckets of some lists each, and enough of them for every core
    buckets = max(min(lists, spark.sparkContext.defaultParallelism), lists // LISTS_A_BUCKET)
    schema = "list int, id long, vector binary, key long, follows boolean, floor float, code binary, lists array<int>, near array<long>, sims array<float>"
    first = bucketed(placed.repartition(buckets, "list").groupBy("list").applyInArrow(_own_list(index, dim, k), schema), "list", buckets)
    home = first.where("NOT follows")
    vectors = home.select("list", "id", "vector").groupBy("list")
    codes = home.select(F.col("id").alias("q"), "floor", F.col("list").alias("home"), "code", F.explode("lists").alias("to_list"))
    offered = codes.groupBy("to_list").cogroup(vectors).applyInArrow(_probed(index, dim, k), "q long, n long, estimate float, home int, of_list int")
    known = home.select("list", F.col("id").alias("q"), "sims").groupBy("list")
    asked = offered.groupBy("home").cogroup(known).applyInArrow(_requests(index, k), "q long, n long, home int, of_list int")
    fetched = asked.groupBy("of_list").cogroup(vectors).applyInArrow(_fetch(dim), "home int, n long, vector binary, queries array<long>")
    direct = fetched.groupBy("home").cogroup(home.select("list", "id", "vector", "near", "sims").groupBy("list")).applyInArrow(_final(dim, k), "q long, n long, similarity float")
    # copies beyond k + 1 of a batch: the nearest are the copies with the smallest ids
    followers = first.where("follows").select("id", "key")
    if followers.isEmpty():
        return direct
    salted = first.select("key", "id").join(followers.select("key").distinct(), "key", "left_semi").groupBy("key", F.pmod("id", F.lit(997)).alias("salt")).agg(F.slice(F.array_sort(F.collect_set("id")), 1, k + 1).alias("ids"))
    leaders = salted.groupBy("key").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
    late = followers.dropDuplicates(["id"]).join(leaders, "key").select(F.col("id").alias("q"), F.explode(F.slice(F.filter("ids", lambda i: i != F.col("id")), 1, k)).alias("n")).withColumn("similarity", F.lit(1.0).cast("float"))
    return direct.unionByName(late)
