"""Groups from pairwise matches (problem 4) by hash-to-min.

Every record holds a cluster, at first itself and its partners.  In each round a record sends its
cluster to the cluster's smallest member and that smallest member to all others, and new clusters
are what arrived.  A smallest member whose cluster's other members all hold nothing but it is done: no
record outside names any of them, so the group is written out and takes no part in later rounds.  It
ends when no record is left.

Before the first round each task joins the links it has into stars, which saves rounds and rows and
changes no group.

A cluster is kept as rows (record, member), never as one value, so the largest group is spread over
tasks: the minima are found with partial aggregation and written to the shared folder before they are
joined back, so that adaptive execution can split the rows of a hot record (it does not where one side
of the join is being aggregated); what arrives is made distinct by both columns.

Null ids, self pairs and scores that are null, NaN or below the threshold link nothing; repeated and
reversed pairs count once; of several scores one that suffices is enough.  An empty table gives none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import stars as _stars
from ..session import small, staged, unstage


def links(df: DataFrame, a: str = "id", b: str = "max_id", score: str | None = "cosine_sim_score", least: float = 0.9) -> DataFrame:
    """(lo, hi) of the rows that link two records, repeats included.  The threshold has the score's own
    type, so that a float of 0.9 is at least 0.9."""
    rows = df.select(F.col(a).alias("x"), F.col(b).alias("y"), *([F.col(score).alias("s")] if score else []))
    if score:
        rows = rows.where(~F.isnan("s") & (F.col("s") >= F.lit(least).cast(rows.schema["s"].dataType)))
    return rows.where("x <> y").select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))


def hash_to_min(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """(group_id, id) of every record in ``pairs`` (lo, hi) but each group's smallest."""
    kind = pairs.schema["lo"].dataType.simpleString()
    stars = pairs.mapInArrow(_stars(), f"lo {kind}, hi {kind}") if kind in ("string", "bigint", "int") else pairs
    # a record and itself, a record and its partner, both ways
    both = F.array(F.struct(F.col("lo").alias("v"), F.col("hi").alias("u")), F.struct(F.col("hi").alias("v"), F.col("lo").alias("u")), F.struct(F.col("lo").alias("v"), F.col("lo").alias("u")), F.struct(F.col("hi").alias("v"), F.col("hi").alias("u")))
    cluster = staged(stars.select(F.inline(both)).distinct())
    done = []
    for number in range(rounds):
        least = staged(cluster.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n")))
        live = least
        if number:
            calm = least.where("n = 1 AND v <> m").groupBy("m").agg(F.count("*").alias("calm"))
            closed = staged(least.where("v = m").select("m", "n").join(calm, "m").where("calm = n - 1").select("m"))
            if not closed.isEmpty():
                closed = small(closed, 1_000_000)
                done.append(least.join(closed, "m", "left_semi").where("v <> m").select(F.col("m").alias("group_id"), F.col("v").alias("id")))
                live = least.join(closed, "m", "left_anti")
        sent = cluster.join(live.select("v", "m"), "v").select("u", "m")
        arrived = sent.select(F.inline(F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))))
        old, cluster = cluster, staged(arrived.distinct())
        unstage(old)
        if cluster.isEmpty():
            break
    else:
        raise RuntimeError(f"not stable after {rounds} rounds")
    return reduce(DataFrame.unionByName, done) if done else cluster.select(F.col("u").alias("group_id"), F.col("v").alias("id"))


def groups(df: DataFrame, a: str = "id", b: str = "max_id", score: str | None = "cosine_sim_score", least: float = 0.9) -> DataFrame:
    """(group_id, id) of every linked record, the smallest of a group included."""
    others = hash_to_min(links(df, a, b, score, least))
    return others.unionByName(others.select("group_id").distinct().select("group_id", F.col("group_id").alias("id")))
