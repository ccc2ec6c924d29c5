"""Media metadata, windows, joins and relational staples over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics as E
from ..functions import models
from ..operators import interleaved as I
from ..operators import joins, media, windows
from .demo import DW, register, table

# --- interleaved ---------------------------------------------------------------------------------


@register("r15_keep_content", "WITH v AS (SELECT sample_id, position, modality FROM interleaved WHERE (modality = 'metadata' AND position = -1) OR (modality IN ('text', 'image') AND position >= 0 AND text_content IS NOT NULL)), c AS (SELECT *, count(*) FILTER (modality <> 'metadata') OVER (PARTITION BY sample_id) AS n, row_number() OVER (PARTITION BY sample_id, modality = 'metadata' ORDER BY position) - 1 AS r FROM v) SELECT sample_id, CASE WHEN modality = 'metadata' THEN -1 ELSE r END::int AS position, modality FROM c WHERE n > 0")
def keep_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.keep_content(table(spark, sf_dir, "interleaved"), F.col("text_content").isNotNull()).select("sample_id", F.col("position").cast("int"), "modality")


@register("g05_image_to_text_ratio", f"WITH s AS (SELECT sample_id, count(*) FILTER (modality = 'image') / greatest(coalesce(sum(CASE WHEN modality = 'text' THEN coalesce(len({DW.replace('text,', 'text_content,')}), 0) END), 0), 1) AS share FROM interleaved GROUP BY sample_id) SELECT i.sample_id, i.position FROM interleaved i JOIN s USING (sample_id) WHERE share BETWEEN 0.001 AND 0.5")
def image_to_text_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.image_to_text_ratio(table(spark, sf_dir, "interleaved"), 0.001, 0.5).select("sample_id", "position")


@register("g04_modality_counts", "SELECT count(DISTINCT sample_id) AS samples, count(*) FILTER (modality = 'metadata') AS metadata, count(*) FILTER (modality = 'text') AS text, count(*) FILTER (modality = 'image') AS image FROM interleaved")
def modality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.modality_counts(table(spark, sf_dir, "interleaved"))


@register("p13_locate".replace("p13", "model_p13"), "SELECT sample_id, position, CASE WHEN modality <> 'image' THEN 'not_image' WHEN binary_content IS NOT NULL THEN 'present' WHEN source_ref IS NULL OR json_extract_string(source_ref, '$.path') IS NULL THEN 'missing' WHEN json_extract_string(source_ref, '$.byte_offset') IS NOT NULL AND json_extract_string(source_ref, '$.byte_size') IS NOT NULL THEN 'range' WHEN json_extract_string(source_ref, '$.member') IS NOT NULL THEN 'tar' ELSE 'direct' END AS how FROM interleaved")
def locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.locate(table(spark, sf_dir, "interleaved")).select("sample_id", "position", "how")


@register("w06_drop_sample", "SELECT sample_id, position FROM interleaved WHERE sample_id NOT IN (SELECT sample_id FROM interleaved WHERE materialize_error IS NOT NULL)")
def drop_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.apply_error_policy(table(spark, sf_dir, "interleaved"), "drop_sample").select("sample_id", "position")


@register("w06_drop_row", "SELECT sample_id, position FROM interleaved WHERE materialize_error IS NULL")
def drop_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.apply_error_policy(table(spark, sf_dir, "interleaved"), "drop_row").select("sample_id", "position")


@register("s18_align", "SELECT sample_id, position, modality, content_type, text_content, source_ref, NULL::varchar AS materialize_error, url, host, language_id_whole_page_fasttext, previous_word_count::int AS previous_word_count FROM interleaved")
def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.align(table(spark, sf_dir, "interleaved").drop("materialize_error"), {"previous_word_count": "int"}).drop("binary_content", "ingested_at")


@register("g10_bins_by_bytes")
def bins_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "interleaved").withColumn("n", F.coalesce(F.length("text_content"), F.lit(0)).cast("long"))
    return I.bins_by_bytes(rows, "sample_id", "n", 20_000).groupBy("bin").agg(F.sum("n").alias("bytes"), F.countDistinct("sample_id").alias("samples"))


@register("model_p12_text_match", "WITH b AS (SELECT DISTINCT i.sample_id, i.position FROM interleaved i JOIN interleaved t ON i.sample_id = t.sample_id AND i.modality = 'image' AND t.modality = 'text' WHERE 1 - abs(i.position / 10.0::double - t.position / 10.0::double) >= 0.85), v AS (SELECT i.sample_id, i.position, modality FROM interleaved i LEFT JOIN b ON b.sample_id = i.sample_id AND b.position = i.position WHERE (modality = 'metadata' AND i.position = -1) OR (modality = 'text' AND i.position >= 0) OR (modality = 'image' AND i.position >= 0 AND b.position IS NOT NULL)), c AS (SELECT *, count(*) FILTER (modality <> 'metadata') OVER (PARTITION BY sample_id) AS n, row_number() OVER (PARTITION BY sample_id, modality = 'metadata' ORDER BY position) - 1 AS r FROM v) SELECT sample_id, CASE WHEN modality = 'metadata' THEN -1 ELSE r END::int AS position, modality FROM c WHERE n > 0")
def text_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "interleaved").withColumn("p", F.col("position") / 10.0)
    return I.best_text_match(rows, lambda a, b: 1 - F.abs(a - b), "p", "p", 0.85).select("sample_id", F.col("position").cast("int"), "modality")


def _pictures(spark: SparkSession, sf_dir: str, width, pattern) -> DataFrame:
    """The pages with pictures of a width and a pattern that depend on the position."""
    size = (width * 20).cast("int")
    picture = F.concat(F.encode(F.concat(F.lit("P5\n"), width.cast("string"), F.lit(" 20\n255\n")), "UTF-8"), F.unhex(F.expr("repeat(__pattern, __size)")))
    rows = table(spark, sf_dir, "interleaved").withColumns({"__pattern": pattern, "__size": (size / 2).cast("int")})
    return rows.withColumn("binary_content", F.when(F.col("modality") == "image", picture)).drop("__pattern", "__size")


def _kept_sql(condition: str) -> str:
    return f"WITH v AS (SELECT sample_id, position, modality FROM interleaved WHERE (modality = 'metadata' AND position = -1) OR (modality = 'text' AND position >= 0) OR (modality = 'image' AND position >= 0 AND {condition})), c AS (SELECT *, count(*) FILTER (modality <> 'metadata') OVER (PARTITION BY sample_id) AS n, row_number() OVER (PARTITION BY sample_id, modality = 'metadata' ORDER BY position) - 1 AS r FROM v) SELECT sample_id, CASE WHEN modality = 'metadata' THEN -1 ELSE r END::int AS position, modality FROM c WHERE n > 0"


@register("model_p12_aspect_ratio", _kept_sql("(10 + 5 * (position % 7)) / 20.0 BETWEEN 1 AND 2"))
def aspect_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.aspect_ratio_filter(_pictures(spark, sf_dir, 10 + 5 * (F.col("position") % 7), F.lit("0000"))).select("sample_id", F.col("position").cast("int"), "modality")


@register("model_p12_blur", _kept_sql("position % 2 = 0"))
def blur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.blur_filter(_pictures(spark, sf_dir, F.lit(20), F.when(F.col("position") % 2 == 0, "00FF").otherwise("8080"))).select("sample_id", F.col("position").cast("int"), "modality")


@register("model_p12_codes", _kept_sql("true"))
def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.code_filter(_pictures(spark, sf_dir, F.lit(20), F.lit("00FF"))).select("sample_id", F.col("position").cast("int"), "modality")


@register("r13_to_documents", "SELECT sample_id, source_ref, url FROM interleaved WHERE modality = 'image'")
def to_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.to_documents(table(spark, sf_dir, "interleaved").where("modality = 'image'"), ["sample_id", "source_ref", "url"])


_CLIPS = "SELECT l_suppkey AS video, l_tax > 0.02 AS passed, l_discount > 0.05 AS filtered_by_motion, l_quantity AS duration FROM lineitem"


@register("g07_clip_stats", f"SELECT video, sum(filtered_by_motion::int)::bigint AS num_filtered_by_motion, sum(passed::int)::bigint AS num_passed, sum(duration) AS total_clip_duration, max(duration) AS max_clip_duration FROM ({_CLIPS}) GROUP BY video")
def clip_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("video"), (F.col("l_tax") > 0.02).alias("passed"), (F.col("l_discount") > 0.05).alias("filtered_by_motion"), F.col("l_quantity").alias("duration"))
    return media.combine_stats(media.clip_stats(clips.withColumn("part", F.col("duration") > 25), ["video", "part"]).drop("part"), ["video"])


@register("w09_clips", "SELECT user_id AS video, sum((event_type = 'purchase')::int)::bigint AS num_passed, count(props)::bigint AS num_transcoded, 0::bigint AS num_with_embeddings, 0::bigint AS num_with_webp, round(sum(coalesce(value, 0)), 4) AS total_clip_duration, round(max(coalesce(value, 0)), 4) AS max_clip_duration FROM events GROUP BY user_id")
def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .demo_text import _folder

    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("clip_id"), F.col("user_id").alias("video"), F.encode("props", "UTF-8").alias("mp4"), (F.col("event_type") == "purchase").alias("passed"), F.coalesce("value", F.lit(0.0)).alias("duration"))
    stats = media.write_clips(rows, _folder(spark, "clips"))
    return stats.withColumns({c: F.round(c, 4) for c in ("total_clip_duration", "max_clip_duration")})


# --- windows -------------------------------------------------------------------------------------


@register("n02_frame_windows", "WITH d AS (SELECT DISTINCT audio_filepath, floor(duration * 30)::bigint AS n FROM manifest_a WHERE duration IS NOT NULL), c AS (SELECT *, greatest(n // 128 + CASE WHEN n % 128 >= 64 THEN 1 ELSE 0 END, 1) AS k FROM d WHERE n >= 4) SELECT audio_filepath, i * 128 AS \"start\", CASE WHEN i = k - 1 THEN n ELSE (i + 1) * 128 END AS \"end\" FROM c, unnest(range(k)) AS t(i)")
def frame_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "manifest_a").where("duration IS NOT NULL").select("audio_filepath", F.floor(F.col("duration") * 30).cast("long").alias("n")).distinct()
    return m.select("audio_filepath", F.inline(windows.frame_windows(F.col("n"), 128, 64)))


@register("n03_stride_windows", "WITH d AS (SELECT DISTINCT audio_filepath, duration FROM manifest_a WHERE duration > 0) SELECT audio_filepath, round(i * 5.0, 6)::double AS \"start\", round(least(i * 5.0 + 10, duration), 6)::double AS \"end\" FROM d, unnest(range(ceil(duration / 5.0)::bigint)) AS t(i) WHERE least(i * 5.0 + 10, duration) - i * 5.0 >= 2")
def stride_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "manifest_a").where("duration > 0").select("audio_filepath", "duration").distinct()
    return m.select("audio_filepath", F.inline(windows.stride_windows(F.col("duration"), 10.0, 5.0, 2.0))).select("audio_filepath", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


_SCENES = """WITH f AS (SELECT l_suppkey AS video, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate, l_returnflag) - 1 AS frame, l_returnflag = 'R' AS cut FROM lineitem),
p AS (SELECT *, coalesce(lag(cut) OVER (PARTITION BY video ORDER BY frame), false) AS before FROM f), i AS (SELECT *, sum((before AND NOT cut)::int) OVER (PARTITION BY video ORDER BY frame) AS island FROM p),
r AS (SELECT video, island, min(frame) FILTER (NOT cut) AS a, min(frame) FILTER (cut) AS c, max(frame) AS z FROM i GROUP BY ALL), g AS (SELECT video, bool_or(cut) AS any_cut, count(*) AS n FROM i GROUP BY video),
s AS (SELECT video, a AS "start", coalesce(c, z) AS "end" FROM r JOIN g USING (video) WHERE any_cut AND a IS NOT NULL AND coalesce(c, z) > a UNION ALL SELECT video, 0, n FROM g WHERE NOT any_cut)
SELECT video, "start" + k * 20 AS "start", least("end", "start" + (k + 1) * 20) AS "end" FROM s, unnest(range(ceil(("end" - "start") / 20.0)::bigint)) AS t(k) WHERE least("end", "start" + (k + 1) * 20) - ("start" + k * 20) >= 3"""


@register("n04_scenes", _SCENES)
def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("video"), F.row_number().over(windows.Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag")).alias("frame"), (F.col("l_returnflag") == "R").alias("cut")).withColumn("frame", F.col("frame") - 1)
    found = windows.scenes(frames, "video", "frame", "cut")
    return windows.fit_scenes(found, least=3, most=20, mode="stride")


def _recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of the manifest, repeated ones once."""
    return table(spark, sf_dir, "manifest_a").select("audio_filepath", "audio_sample_rate", "segments").dropDuplicates()


_WINDOWS = """WITH e AS (SELECT row_number() OVER () AS eid, * FROM (SELECT DISTINCT audio_filepath, audio_sample_rate AS rate, segments FROM manifest_a)),
u AS (SELECT eid, k, unnest(segments) AS x FROM (SELECT eid, segments, 0 AS k FROM e)), o AS (SELECT eid, x, row_number() OVER () AS nth FROM u),
s AS (SELECT eid, x.start AS s, x."end" AS e, nullif(x.speaker, '') AS who, coalesce(x.metrics.bandwidth, 0) < 8000 AS narrow, row_number() OVER (PARTITION BY eid ORDER BY x.start, x."end", nth) AS r FROM o WHERE x IS NOT NULL AND x.start IS NOT NULL AND x."end" IS NOT NULL),
n AS (SELECT eid, count(*) AS total FROM s GROUP BY eid),
p AS (SELECT a.eid, a.r AS i, b.r AS j, a.s AS s0, a.e AS e0, b.s, b.e, b.who, b.narrow, b.e - a.s > 30 * 1.1::double AS late, coalesce(b.who = 'no-speaker', false) AS nobody, (SELECT count(DISTINCT c.who) FROM s c WHERE c.eid = a.eid AND c.r BETWEEN a.r AND b.r) AS names FROM s a JOIN s b ON a.eid = b.eid AND b.r >= a.r WHERE NOT a.narrow),
q AS (SELECT *, min(CASE WHEN late OR narrow OR nobody OR names > 5 THEN j END) OVER (PARTITION BY eid, i) AS stop FROM p),
w AS (SELECT q.eid, i, any_value(s0) AS s0, any_value(coalesce(stop, total + 1)) AS stop, any_value(total) AS total,
  bool_or(j = stop AND late AND NOT narrow AND s < s0 + 30 * 1.1::double) AS cut, bool_or(j = stop AND late AND NOT narrow AND s < s0 + 30 * 1.1::double AND NOT nobody AND names <= 5) AS added,
  max(s) FILTER (j = stop) AS cut_at, max(e) FILTER (j = coalesce(stop, total + 1) - 1) AS last, any_value(e0) AS e0, max(names) FILTER (j = stop) AS names_cut, max(names) FILTER (j = coalesce(stop, total + 1) - 1) AS names_last,
  bool_or((who IS NULL OR nobody) AND j = least(coalesce(stop, total + 1), total)) AS next_nobody, bool_or(narrow AND j = least(coalesce(stop, total + 1), total)) AS next_narrow FROM q JOIN n ON n.eid = q.eid GROUP BY q.eid, i),
v AS (SELECT *, CASE WHEN added THEN cut_at WHEN stop > i THEN last ELSE e0 END - s0 AS seconds, stop - i + added::int AS held, coalesce(CASE WHEN added THEN names_cut ELSE names_last END, 0) AS names FROM w),
k AS (SELECT *, NOT (seconds BETWEEN 30 * (1 - 0.1::double) AND 30 * 1.1::double AND held >= 2) AS lost FROM v),
t AS (SELECT eid, count(*) FILTER (NOT lost AND names BETWEEN 2 AND 5) AS windows, count(*) FILTER (NOT lost AND NOT names BETWEEN 2 AND 5) AS lost_spk, count(*) FILTER (lost) AS lost_win, count(*) FILTER (lost AND next_nobody) AS lost_no_spkr, count(*) FILTER (lost AND NOT next_nobody AND next_narrow) AS lost_next_seg_bm, count(*) FILTER (cut) AS truncations FROM k GROUP BY eid),
b AS (SELECT eid, count(*) FILTER (narrow) AS lost_bw, count(*) AS total FROM s GROUP BY eid)
SELECT audio_filepath, CASE WHEN coalesce(rate, 0) < 16000 THEN 0 ELSE coalesce(t.windows, 0) END::int AS windows, CASE WHEN coalesce(rate, 0) < 16000 THEN 0 ELSE coalesce(lost_bw, 0) END::int AS lost_bw, CASE WHEN coalesce(rate, 0) < 16000 THEN coalesce(total, 0) ELSE 0 END::int AS lost_sr,
 CASE WHEN coalesce(rate, 0) < 16000 THEN 0 ELSE coalesce(lost_spk, 0) END::int AS lost_spk, CASE WHEN coalesce(rate, 0) < 16000 THEN 0 ELSE coalesce(lost_win, 0) END::int AS lost_win, CASE WHEN coalesce(rate, 0) < 16000 THEN 0 ELSE coalesce(lost_no_spkr, 0) END::int AS lost_no_spkr,
 CASE WHEN coalesce(rate, 0) < 16000 THEN 0 ELSE coalesce(lost_next_seg_bm, 0) END::int AS lost_next_seg_bm, CASE WHEN coalesce(rate, 0) < 16000 THEN 0 ELSE coalesce(truncations, 0) END::int AS truncations FROM e LEFT JOIN t USING (eid) LEFT JOIN b USING (eid)"""


@register("n05_conversation_windows", _WINDOWS)
def conversation_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = windows.conversation_windows(_recordings(spark, sf_dir), target=30.0)
    return m.select("audio_filepath", F.size("windows").alias("windows"), *[f"window_stats.{c}" for c in ("lost_bw", "lost_sr", "lost_spk", "lost_win", "lost_no_spkr", "lost_next_seg_bm", "truncations")])


@register("n06_filter_overlaps")
def filter_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = windows.conversation_windows(_recordings(spark, sf_dir), target=30.0)
    return windows.filter_overlaps(m, percent=50, target=30.0).select("audio_filepath", F.size("filtered_windows").alias("windows"), F.round("filtered_dur", 3).alias("seconds"))


@register("g06_speaker_durations", "WITH s AS (SELECT DISTINCT audio_filepath, segments FROM manifest_a), u AS (SELECT audio_filepath, unnest(segments) AS x FROM s) SELECT audio_filepath, x.speaker AS speaker, round(sum(x.\"end\" - x.start), 4) AS seconds FROM u WHERE x.speaker IS NOT NULL AND x.start IS NOT NULL AND x.\"end\" IS NOT NULL GROUP BY ALL")
def speaker_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "manifest_a").select("audio_filepath", "segments").dropDuplicates()
    return m.select("audio_filepath", F.explode(windows.speaker_durations(F.col("segments"))).alias("speaker", "seconds")).select("audio_filepath", "speaker", F.round("seconds", 4).alias("seconds"))


@register("g11_chunk_numbers", "SELECT o_orderkey, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 100 AS chunk, ntile(7) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS part FROM orders")
def chunk_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", windows.chunk_numbers(100, [F.col("o_orderkey")], ["o_orderstatus"]).alias("chunk"), windows.n_chunks(7, [F.col("o_orderkey")], ["o_orderstatus"]).alias("part"))


@register("g12_pick_frame", "SELECT user_id, list_sort(list(event_id))[(count(*) + 1) // 2] AS middle FROM events GROUP BY user_id")
def pick_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list("event_id").alias("t")).select("user_id", windows.pick_frame(F.col("t")).alias("middle"))


@register("l03_top_shares", "WITH n AS (SELECT user_id, event_type, count(*) AS c FROM events GROUP BY ALL), r AS (SELECT *, c / sum(c) OVER (PARTITION BY user_id) AS p, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, event_type DESC) AS k FROM n) SELECT user_id, max(event_type) FILTER (k = 1) AS \"first\", coalesce(max(event_type) FILTER (k = 2 AND p >= 0.1), 'NA') AS \"second\" FROM r GROUP BY user_id")
def top_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy("user_id", "event_type").count()
    total = n.groupBy("user_id").agg(F.collect_list("event_type").alias("l"), F.collect_list(F.col("count") * 1.0).alias("c"), F.sum("count").alias("s"))
    shares = F.transform("c", lambda x: x / F.col("s"))
    return total.select("user_id", windows.top_shares(F.col("l"), shares).alias("t")).select("user_id", "t.first", "t.second")


# --- audio ---------------------------------------------------------------------------------------

_SEG = "WITH s AS (SELECT DISTINCT audio_filepath, segments FROM manifest_a), u AS (SELECT audio_filepath, unnest(segments) AS x FROM s)"


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "manifest_a").select("audio_filepath", "segments").dropDuplicates()
    return m.select("audio_filepath", F.explode("segments").alias("x")).select("audio_filepath", "x.*")


@register("e01_wer")
def wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _segments(spark, sf_dir).where("text IS NOT NULL")
    return s.select("audio_filepath", "start", "end", E.wer()(F.col("text"), F.lower("text")).alias("wer"))


@register("e02_cer")
def cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _segments(spark, sf_dir).where("text IS NOT NULL")
    return s.select("audio_filepath", "start", "end", F.round(E.cer(F.col("text"), F.lower("text")), 6).alias("cer"))


@register("e03_rates", _SEG + f" SELECT audio_filepath, \"start\", \"end\", round(length(text)::double / nullif(\"end\" - \"start\", 0), 6) AS char_rate, round(len({DW})::double / nullif(\"end\" - \"start\", 0), 6) AS word_rate FROM (SELECT audio_filepath, x.start AS \"start\", x.\"end\" AS \"end\", x.text AS text FROM u)")
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = F.col("end") - F.col("start")
    return _segments(spark, sf_dir).select("audio_filepath", "start", "end", F.round(E.char_rate(F.col("text"), length), 6).alias("char_rate"), F.round(E.word_rate(F.col("text"), length), 6).alias("word_rate"))


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.filter("segments", lambda s: s["start"].isNotNull() & s["end"].isNotNull())
    ms = F.transform(good, lambda s: F.struct(F.round(s["start"] * 1000).cast("long").alias("start_ms"), F.round(s["end"] * 1000).cast("long").alias("end_ms")))
    m = table(spark, sf_dir, "manifest_a").select("audio_filepath", "segments").where("segments IS NOT NULL").dropDuplicates()
    return m.select("audio_filepath", F.inline(E.concatenation_map(ms, 500)))


_MAPPING = """WITH e AS (SELECT row_number() OVER () AS eid, * FROM (SELECT DISTINCT audio_filepath, segments FROM manifest_a WHERE segments IS NOT NULL)), u AS (SELECT eid, audio_filepath, unnest(segments) AS x FROM e),
o AS (SELECT eid, audio_filepath, round(x.start * 1000)::bigint AS a, round(x."end" * 1000)::bigint AS b FROM u WHERE x.start IS NOT NULL AND x."end" IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY eid ORDER BY a, b) AS r FROM o),
m AS (SELECT eid, audio_filepath, a AS original_start_ms, b AS original_end_ms, (sum(b - a) OVER (PARTITION BY eid ORDER BY r) - (b - a) + 500 * (r - 1))::bigint AS concat_start_ms, (sum(b - a) OVER (PARTITION BY eid ORDER BY r) + 500 * (r - 1))::bigint AS concat_end_ms FROM r)
"""


@register("e05_concatenation", _MAPPING + "SELECT audio_filepath, original_start_ms, original_end_ms, concat_start_ms, concat_end_ms FROM m")
def concatenation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapping(spark, sf_dir)


@register("j06_map_timestamps", _MAPPING + """, s AS (SELECT row_number() OVER () AS seg, audio_filepath, concat_start_ms + 10 AS a, concat_end_ms - 10 AS b FROM m WHERE concat_end_ms - 10 > concat_start_ms + 10),
p AS (SELECT s.*, m.concat_start_ms AS c, m.concat_end_ms AS d, m.original_start_ms AS o, count(*) OVER (PARTITION BY seg) AS n FROM s JOIN m ON s.audio_filepath = m.audio_filepath AND s.a < m.concat_end_ms AND m.concat_start_ms < s.b AND m.concat_end_ms > m.concat_start_ms)
SELECT audio_filepath, greatest(a, c) - c + o AS start_ms, least(b, d) - c + o AS end_ms FROM p WHERE n = 1""")
def map_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = _mapping(spark, sf_dir)
    inner = mapping.select("audio_filepath", (F.col("concat_start_ms") + 10).alias("start_ms"), (F.col("concat_end_ms") - 10).alias("end_ms")).where("end_ms > start_ms")
    return joins.map_timestamps(inner, mapping.drop("original_end_ms"), "audio_filepath").select("audio_filepath", "start_ms", "end_ms")


@register("j06_interval_overlaps", "WITH e AS (SELECT event_id, event_type, epoch_ms(ts) AS a, epoch_ms(ts) + 60000 AS b FROM events) SELECT x.event_id AS left_id, y.event_id AS right_id FROM e x JOIN e y ON x.event_type = y.event_type AND x.a < y.b AND y.a < x.b AND x.event_id < y.event_id")
def interval_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("a"))
    x = e.select("event_type", F.col("event_id").alias("left_id"), F.col("a").alias("a0"), (F.col("a") + 60_000).alias("a1"))
    y = e.select("event_type", F.col("event_id").alias("right_id"), F.col("a").alias("b0"), (F.col("a") + 60_000).alias("b1"))
    return joins.interval_overlaps(x, y, "event_type", ("a0", "a1"), ("b0", "b1"), 60_000).where("left_id < right_id").select("left_id", "right_id")


_NEAREST = """WITH e AS (SELECT row_number() OVER () AS eid, * FROM (SELECT DISTINCT audio_filepath, segments FROM manifest_a WHERE segments IS NOT NULL)),
t AS (SELECT eid, audio_filepath, list_sort(list_filter(list_transform(segments, lambda x: x.start), lambda x: x IS NOT NULL)) AS t FROM e), g AS (SELECT *, unnest(range(greatest(ceil((t[len(t)] - t[1] + 2.5) / 5.0)::bigint, 1))) AS i FROM t WHERE len(t) > 0),
k AS (SELECT *, t[1] + i * 5.0 AS x_at, len(list_filter(t, lambda x: x < t[1] + i * 5.0)) AS before FROM g), r AS (SELECT *, least(greatest(before, 1), len(t) - 1) AS hi FROM k),
n AS (SELECT eid, audio_filepath, CASE WHEN x_at >= t[len(t)] THEN len(t) - 1 WHEN len(t) = 1 THEN 0 WHEN abs(x_at - t[hi + 1]) < abs(x_at - t[hi]) THEN hi ELSE hi - 1 END::int AS "index" FROM r)
SELECT audio_filepath, "index", hits FROM (SELECT eid, audio_filepath, "index", count(*)::int AS hits FROM n GROUP BY ALL)"""


@register("j11_sample_nearest", _NEAREST)
def sample_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.array_sort(F.filter(F.transform("segments", lambda s: s["start"]), lambda t: t.isNotNull()))
    m = table(spark, sf_dir, "manifest_a").where("segments IS NOT NULL").select("audio_filepath", "segments").dropDuplicates().select("audio_filepath", good.alias("t")).where("size(t) > 0")
    return m.select("audio_filepath", F.inline(joins.sample_nearest(F.col("t"), 0.2)))


@register("as_of_join", "SELECT e.event_id, p.event_id AS last_purchase FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY ALL) p ON e.user_id = p.user_id AND e.ts >= p.ts")
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    p = table(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("bought")).agg(F.max("event_id").alias("last_purchase"))
    return joins.as_of(e, p, "user_id", "ts", "bought").select("event_id", "last_purchase")


@register("w13_rttm", _SEG + " SELECT format('SPEAKER {} 1 {:.3f} {:.3f} <NA> <NA> {} <NA> <NA>', audio_filepath, x.start, x.\"end\" - x.start, coalesce(x.speaker, 'unknown')) AS line FROM u WHERE x.\"end\" > x.start AND audio_filepath IS NOT NULL")
def rttm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).select(E.rttm(F.col("audio_filepath"), F.col("start"), F.col("end"), F.coalesce("speaker", F.lit("unknown"))).alias("line")).where("line IS NOT NULL")


@register("model_p14_thresholds", "SELECT DISTINCT audio_filepath FROM manifest_a WHERE duration >= 60 AND duration < 400")
def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "manifest_a").where(models.threshold_keep(F.col("duration"), 60.0, 400.0)).select("audio_filepath").distinct()


@register("model_p15_motion", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount * 0.02 >= 0.00098 AND l_tax * 0.001 >= 0.000001")
def motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(models.motion_keep(F.col("l_discount") * 0.02, F.col("l_tax") * 0.001)).select("l_orderkey", "l_linenumber")


# --- relational ----------------------------------------------------------------------------------


@register("j04_lookup", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return joins.lookup(table(spark, sf_dir, "orders"), c, "o_custkey").select("o_orderkey")


@register("g08_performance", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS total, round(avg(l_extendedprice), 4) AS mean, round(stddev_pop(l_discount), 6) AS deviation, count(*) AS n FROM lineitem GROUP BY ALL")
def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("total"), F.round(F.avg("l_extendedprice"), 4).alias("mean"), F.round(F.stddev_pop("l_discount"), 6).alias("deviation"), F.count("*").alias("n"))


@register("n01_ranking", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS nth, count(*) OVER (PARTITION BY user_id, event_type) > 1 AS repeated FROM events")
def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.Window
    return table(spark, sf_dir, "events").select("event_id", (F.row_number().over(w.partitionBy("user_id").orderBy("ts", "event_id")) - 1).alias("nth"), (F.count("*").over(w.partitionBy("user_id", "event_type")) > 1).alias("repeated"))


@register("u01_union", "SELECT doc_id AS id, text, NULL::varchar AS suite FROM documents UNION ALL SELECT item_id, text, suite FROM eval_items")
def union(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, e = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), table(spark, sf_dir, "eval_items").select(F.col("item_id").alias("id"), "text", "suite")
    return d.unionByName(e, allowMissingColumns=True)


@register("u04_unpivot", "SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_discount', 'l_tax']) AS field, unnest([l_quantity, l_discount, l_tax]) AS value FROM lineitem")
def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "field", "value")


@register("l01_sorted_top", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 100")
def sorted_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.desc_nulls_last("n_chars"), "doc_id").limit(100)


@register("stream_windowed_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming.streams import windowed_counts

    return windowed_counts(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"]).select("window_start", "event_type", "n")
