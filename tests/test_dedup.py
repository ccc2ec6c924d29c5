"""Deduplication, components, ids and removal."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltline.operators import dedup as D

TEXTS = {1: "a text that is repeated in full", 2: "another text", 300: "a text that is repeated in full", 4: "another text", -1: "one more"}


def ids(df):
    return sorted(r[0] for r in df.collect())


def frame(spark, rows, kind="id long, text string"):
    return spark.createDataFrame(list(rows), kind).repartition(3)


def test_exact(spark):
    df = frame(spark, [*TEXTS.items(), (7, None), (8, None), (2, "another text")])
    assert ids(D.exact_duplicates(df)) == [4, 300]
    out = D.exact_workflow(df, perform_removal=True)
    assert out.counts == {"duplicates": 2} and ids(out.tables["kept"].select("id")) == [-1, 1, 2, 2, 7, 8]
    assert D.exact_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("gone,left", [([2, 4, 6], [1, 3, 5]), ([], [1, 2, 3, 4, 5]), ([9], [1, 2, 3, 4, 5]), ([1, 2, 3, 4, 5], [])])
def test_remove(spark, gone, left):
    df = frame(spark, [(i, "t") for i in range(1, 6)])
    dups = spark.createDataFrame([(g,) for g in gone] + [(None,)], "dup long")
    assert ids(D.remove(df, dups, "id", "dup").select("id")) == left
    assert ids(D.remove(df, dups, "id", "dup", broadcast_rows=0).select("id")) == left


def test_minhash_estimates_jaccard():
    rng = random.Random(1)
    m = D.permutations(260, 42)
    texts = ["".join(rng.choice("abcd ") for _ in range(200)) for _ in range(3)]
    texts += [texts[0][:150] + texts[1][:50], texts[0][:190] + "xxxxxxxxxx", "short", ""]
    signed = D.minhash(texts, m, 5)
    for i, j in itertools.combinations(range(5), 2):
        sx, sy = ({t[i : i + 5] for i in range(len(t) - 4)} for t in (texts[i], texts[j]))
        assert abs((signed[i] == signed[j]).mean() - len(sx & sy) / len(sx | sy)) < 0.15
    # a text's signature does not depend on its neighbours in the batch
    assert all((D.minhash([t], m, 5)[0] == s).all() for t, s in zip(texts, signed)) and D.minhash([], m, 5).shape == (0, 260)


def test_fuzzy(spark):
    base = " ".join(f"word{i}" for i in range(120))
    rows = [(1, base), (2, base + " end"), (300, "start " + base), (4, "short text"), (-1, "short text"), (9, " ".join(f"other{i}" for i in range(120))), (10, None)]
    out = D.fuzzy_workflow(frame(spark, rows), ngram=5, bands=10, rows_per_band=1)
    groups = {}
    for r in out.tables["groups"].collect():
        groups.setdefault(r["group"], set()).add(r["id"])
    assert {-1, 4} in groups.values() and any({1, 2, 300} <= g for g in groups.values())
    strict = D.fuzzy_duplicates(frame(spark, rows), ngram=24)
    found = {}
    for r in strict.collect():
        found.setdefault(r["group"], set()).add(r["id"])
    assert found == {-1: {-1, 4}, 1: {1, 2, 300}}
    assert D.fuzzy_workflow(frame(spark, [(1, "a" * 50), (2, "b" * 50)])).counts == {"groups": 0, "duplicates": 0}


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(1000, 1000)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["id"]: r["group"] for r in D.connected_components(spark.createDataFrame(edges, "lo long, hi long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_chain_edges(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([3, 4],), ([5],), ([],), ([1, 2],)], "ids array<long>")
    assert sorted(map(tuple, D.chain_edges(df).collect())) == [(1, 2), (2, 3), (3, 4)]


VECTORS = [[1.0, 2.0, 3.0], [1.0, 2.0, 3.0], [1.1, 2.0, 3.5], [0.0, 1.0, 0.0], [-1.0, -2.0, -3.0], [1.1, 2.0, 3.5]]


@pytest.mark.parametrize("block", [1, 2, 4096])
def test_pairwise(spark, block):
    df = frame(spark, [(i, v, 0) for i, v in enumerate(VECTORS)] + [(10, [1.0, 0.0, 0.0], 1), (11, None, 1)], "id long, embeddings array<float>, centroid int")
    got = {r["id"]: (r["max_id"], r["cosine_sim_score"]) for r in D.pairwise_similarity(df, (("asc", "id"),), block=block).collect()}
    u = np.array(VECTORS) / np.linalg.norm(VECTORS, axis=1, keepdims=True)
    s = u @ u.T
    for i in range(len(VECTORS)):
        best = max([0.0, *(s[i, j] for j in range(i))])
        assert got[i][1] == pytest.approx(best, abs=1e-5)
    assert got[0] == (0, 0.0) and got[1][0] == 0 and got[5][0] == 2 and got[10] == (10, 0.0) and 11 not in got


def test_semantic(spark):
    rng = np.random.default_rng(0)
    centres = np.eye(8)[:4] * 5
    rows = [(i, (centres[i % 4] + rng.normal(size=8) * 0.1).tolist()) for i in range(80)] + [(100, (centres[0] * 1.001).tolist()), (101, (centres[0] * 2).tolist()), (102, None)]
    df = frame(spark, rows, "id long, embeddings array<double>")
    for which in ("hard", "easy", "random"):
        out = D.semantic_workflow(df, clusters=4, eps=1e-6, which=which, iterations=20, perform_removal=True)
        assert out.counts["duplicates"] == 1 and ids(out.tables["duplicates"])[0] in (100, 101)
    assert out.tables["clusters"].where("cosine_dist_to_cent > 0.05").count() == 0
    with pytest.raises(ValueError):
        D.ranked("other")


def test_numbered(spark):
    df = spark.range(1000).repartition(7).toDF("x")
    got = D.numbered(df, "n", ["x"]).collect()
    assert sorted((r["n"], r["x"]) for r in got) == [(i, i) for i in range(1000)]
    assert sorted(r["n"] for r in D.numbered(df, "n").collect()) == list(range(1000))


def test_registry(tmp_path):
    r = D.IdRegistry()
    assert r.register(["a", "b"], 10) == 0 and r.register(["c"], 5) == 10 and r.register(["b", "a"], 10) == 0
    r.save(str(tmp_path / "r.json"))
    again = D.IdRegistry.load(str(tmp_path / "r.json"))
    assert again.range_of(["c"]) == (10, 14) and again.next_id == 15
    with pytest.raises(KeyError):
        again.range_of(["d"])


def test_a_hot_key_is_split(spark):
    """A third of all rows with one text: the rows that are joined with their least id are read in parts."""
    rows = staged_rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("h"), "id")
    path = D.staged(staged_rows.withColumn("pad", F.sha2(F.col("id").cast("string"), 512)))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = D.with_least(path, ["h"], "id", "keep", broadcast_rows=0)
        assert found.select("h", "id", "keep", "pad").toArrow().num_rows == 20_000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString() or _final_plan_splits(found)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows.count() == 60_000


def _final_plan_splits(df):
    df._jdf.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()
