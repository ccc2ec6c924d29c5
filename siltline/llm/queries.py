"""The pN_ queries over the test tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import canon, groups, language, leaks, mainbody, near, nearest, packing, quality, turns


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "interleaved")).select("src", "rec_id", "seg_no", "lang", "confidence")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.mislabelled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "interleaved"))


def p2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(_table(spark, sf_dir, "vectors"), "id", "embeddings").toDF("id", "neighbour_id", "similarity")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest.nearest(_table(spark, sf_dir, "vectors"), "id", "embeddings").where("similarity >= 0.9")
    return found.select(F.least("q", "n").alias("id_lo"), F.greatest("q", "n").alias("id_hi")).distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainbody.main_lines(_table(spark, sf_dir, "web_pages")).select("page_id", "line_no").distinct()


def p3_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainbody.main_text(_table(spark, sf_dir, "web_pages"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.hash_to_min(groups.links(_table(spark, sf_dir, "pairwise_results")))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.groups(_table(spark, sf_dir, "pairwise_results"))


def p5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "quality_labels")).withColumnRenamed("id", "doc_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "quality_labels")).where("verdict <> 'prose'").select(F.col("id").alias("doc_id")).distinct()


def p6_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.turns(_table(spark, sf_dir, "manifest_a")).withColumnRenamed("id", "audio_filepath")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.turns(_table(spark, sf_dir, "manifest_a"), with_text=False).withColumnRenamed("id", "audio_filepath").drop("text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_pairs(_table(spark, sf_dir, "documents"), "doc_id", "text", shingle=3, similarity=0.6).toDF("doc_lo", "doc_hi")


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(_table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), "doc_id", "text", capacity=2048)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.same_look(_table(spark, sf_dir, "documents"), "doc_id", "text").toDF("doc_lo", "doc_hi")


def p10_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.canonicalise(_table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "text_canonical").select("doc_id", "text_canonical")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit()}


_GROUPS = """WITH RECURSIVE e AS (SELECT id AS a, max_id AS b FROM pairwise_results WHERE id <> max_id AND cosine_sim_score >= 0.9::float AND NOT isnan(cosine_sim_score)),
two AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(id, m) AS (SELECT a, least(a, b) FROM two UNION SELECT two.a, reach.m FROM reach JOIN two ON two.b = reach.id WHERE reach.m < two.a)
SELECT min(m) AS group_id, id FROM reach GROUP BY id"""


_CANON = canon.canonical_sql("documents", "text")
_LOOKS = rf"WITH c AS (SELECT DISTINCT doc_id, text, canon FROM {_CANON} WHERE doc_id IS NOT NULL AND regexp_matches(canon, '\S')) SELECT DISTINCT least(a.doc_id, b.doc_id) AS doc_lo, greatest(a.doc_id, b.doc_id) AS doc_hi FROM c a JOIN c b ON a.canon = b.canon AND a.text <> b.text AND a.doc_id <> b.doc_id"


def _near(size: int, least: float) -> str:
    """Pairs (a, b) of documents by brute force: all that share a shingle, with the sizes of their sets."""
    gram = " || ' ' || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(size))
    return rf"""w AS (SELECT doc_id, regexp_extract_all(lower(canon), '[\p{{L}}\p{{N}}]+') AS w FROM {_CANON} WHERE doc_id IS NOT NULL AND text IS NOT NULL),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {size} THEN list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: {gram})) ELSE [array_to_string(w, ' ')] END) AS g FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE c.c >= {least} * (x.n + y.n - c.c))"""


_NEAR_GROUPS = f"""WITH RECURSIVE {_near(5, 0.8)}, two AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reach(id, m) AS (SELECT doc_id, doc_id FROM n UNION SELECT two.a, reach.m FROM reach JOIN two ON two.b = reach.id WHERE reach.m < two.a) SELECT id AS doc_id, min(m) AS group_id FROM reach GROUP BY id"""
_NEAREST = """WITH v AS (SELECT DISTINCT id, embeddings::double[] AS e FROM vectors WHERE id IS NOT NULL AND len(embeddings) = 64 AND len(list_filter(embeddings, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(embeddings, lambda x: abs(x))) > 0),
s AS (SELECT a.id AS q, b.id AS n, list_cosine_similarity(a.e, b.e) AS s FROM v a JOIN v b ON a.id <> b.id), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(s, 6) DESC, n) AS k FROM s)
SELECT DISTINCT least(q, n) AS id_lo, greatest(q, n) AS id_hi FROM r WHERE k <= 5 AND s >= 0.9"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can say it on whole tables; the others are tested against brute force."""
    return {
        "p2_found": _NEAREST, "p4_found": f"SELECT group_id, id FROM ({_GROUPS}) WHERE group_id < id", "p4_groups": _GROUPS, "p7_found": f"WITH {_near(3, 0.6)} SELECT a AS doc_lo, b AS doc_hi FROM near", "p7_groups": _NEAR_GROUPS,
        "p10_found": _LOOKS, "p10_canonical": f"SELECT doc_id, canon AS text_canonical FROM {_CANON}",
    }
