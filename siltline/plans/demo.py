"""Queries over the test tables, one or more per operator, with their SQL.

Each query runs over its whole tables.  Where plain SQL says the same, it stands beside the query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import flat
from ..functions import modifiers as M
from ..functions import scores as S
from ..functions.expr import SPACE_CLASS
from ..operators import dedup, score_filter, split_join
from ..session import spread

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _duck_class() -> str:
    import re

    return "[" + re.sub(r"\\u(\w{4})", r"\\x{\1}", SPACE_CLASS) + "]"


WS = _duck_class()
DW = f"list_filter(string_split_regex(text, '{WS}+'), lambda w: w <> '')"
DS = f"list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{WS}+', '', 'g') <> '')"
DP = "string_split(text, chr(10) || chr(10))"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return put


# What the test documents lack and some rules look for: what is put before and after the text of each
# document, by the remainder of its id.
CASES = (
    ("", ""), ('"', '"'), ('<?xml version="1.0"?>\n', ""), ("", " see https://www.example.org/a%20b?c=1 and http://porn.example/x"), ("This site has a Privacy Policy.\n\n", ""),
    ("", "\n\nPlease read our terms of use"), ("lorem ipsum dolor\n\n", ""), ("http://a.example/one http://b.example/two-three.html\n", ""), ("", "\nThe tokenizer\nThe parser\nThe end"), ('"one"\n', '"'),
)


def adorned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with these cases."""
    case = F.pmod("doc_id", F.lit(len(CASES)))
    at = lambda side: F.array(*[F.lit(c[side]) for c in CASES])[case.cast("int")]
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(at(0), "text", at(1)).alias("text"))


_LIT = lambda x: "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
ADORNED = f"(SELECT doc_id, [{', '.join(_LIT(a) for a, _ in CASES)}][(doc_id % {len(CASES)})::int + 1] || text || [{', '.join(_LIT(b) for _, b in CASES)}][(doc_id % {len(CASES)})::int + 1] AS text FROM documents)"
_ADORNED = {"q04_urls", "q10_boilerplate", "q16_pornographic_urls", "q28_xml_header", "m01_remove_boilerplate", "m02_remove_lines", "m05_remove_quotes", "m07_remove_urls"}


def _documents(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return adorned(spark, sf_dir) if name in _ADORNED else table(spark, sf_dir, "documents").select("doc_id", "text")


def _score_query(name: str, rule: S.Rule, sql: str | None, keep: str | None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = score_filter.score(_documents(name, spark, sf_dir), rule, "s")
        return docs.select("doc_id", F.round(F.col("s").cast("double"), 6).alias("score"), rule.keep(F.col("s")).alias("keep"))

    full = None if sql is None else f"SELECT doc_id, round(s::double, 6) AS score, coalesce({keep}, false) AS keep FROM (SELECT doc_id, {sql} AS s FROM {ADORNED if name in _ADORNED else 'documents'})"
    if sql and sql.startswith("WITH"):
        full = f"SELECT doc_id, round(s::double, 6) AS score, coalesce({keep}, false) AS keep FROM ({sql})"
    register(name, full)(run)


def top_gram_sql(n: int) -> str:
    """(doc_id, s) of the share of the most frequent n-gram of words."""
    return f"""WITH w AS (SELECT doc_id, text, {DW} AS ws FROM documents), g AS (SELECT doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS g FROM w, unnest(range(1, len(ws) - {n - 2})) AS t(i)),
c AS (SELECT doc_id, g, count(*) AS n, min(i) AS f FROM g GROUP BY ALL), best AS (SELECT doc_id, arg_max(g, n * 1000000 - f) AS g FROM c GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL WHEN len(ws) < {n} THEN 1.0 ELSE (length(text) - length(replace(text, best.g, '')))::double / length(text) END AS s FROM w LEFT JOIN best USING (doc_id)"""


def duplicate_gram_sql(n: int) -> str:
    """(doc_id, s) of the share of characters in n-grams that came before."""
    return f"""WITH w AS (SELECT doc_id, text, {DW} AS ws FROM documents), g AS (SELECT doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS g FROM w, unnest(range(1, len(ws) - {n - 2})) AS t(i)),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS r FROM g), a AS (SELECT doc_id, i, greatest(0, {n} - (i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - {n}))) AS c FROM k WHERE r > 1),
d AS (SELECT a.doc_id, sum(list_sum(list_transform(ws[i + c:i + {n - 1}], lambda x: length(x))) + least({n} - c, {n - 1})) AS chars FROM a JOIN w ON a.doc_id = w.doc_id GROUP BY a.doc_id)
SELECT w.doc_id, CASE WHEN text IS NULL THEN NULL WHEN len(ws) < {n} THEN 1.0 ELSE coalesce(chars, 0)::double / length(text) END AS s FROM w LEFT JOIN d ON d.doc_id = w.doc_id"""


def _share(part: str, whole: str) -> str:
    return f"({part})::double / nullif(({whole})::double, 0)"


def _count(pattern: str, of: str = "text") -> str:
    return f"len(regexp_extract_all({of}, '{pattern}'))"


_ELL = "[" + ", ".join(f"'{e}'" for e in S.ELLIPSES) + "]"
_POLICY = "[" + ", ".join(f"'{p}'" for p in S.POLICY) + "]"
_URL = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
_one = lambda e: f"CASE WHEN text = '' THEN 1.0 ELSE {e} END"
_DQ = "\"''"
_chars = lambda xs: f"coalesce(list_sum(list_transform({xs}, lambda x: length(x))), 0)"

_SCORES = [
    ("q01_non_alphanumeric", S.non_alphanumeric(), _one(f"1 - {_share(_count('[a-zA-Z0-9' + chr(92) + 'n?!,.]'), 'length(text)')}"), "s <= 0.25"),
    ("q02_symbols_to_words", S.symbols_to_words(), _share(f"len(list_filter({DW}, lambda w: list_contains({_ELL}, w) OR len(regexp_extract_all(w, '#+')) > length(w) * 0.5))", f"len({DW})"), "s <= 0.1"),
    ("q03_numbers", S.numbers(), _one(_share(_count(r"\p{Nd}"), "length(text)")), "s <= 0.15"),
    ("q04_urls", S.urls(), _one(_share(_chars(f"regexp_extract_all(text, '{_URL}')"), "length(text)")), "s <= 0.2"),
    ("q05_bullets", S.bullets(), _share(f"len(list_filter({DS}, lambda x: regexp_matches({strip_sql('x')}, '^[{S.BULLETS}]')))", f"len({DS})"), "s <= 0.9"),
    ("q06_white_space", S.white_space(), _one(_share(_count(r"[\t\n\r\x08 ]"), "length(text)")), "s <= 0.25"),
    ("q07_parentheses", S.parentheses(), _one(_share(_count(r"[{}⟨⟩\[\]()]"), "length(text)")), "s <= 0.1"),
    ("q08_long_word", S.long_word(), f"list_max(list_transform({DW}, lambda w: length(w)))", "s <= 1000"),
    ("q09_word_count", S.word_count(), f"len({DW})", "s BETWEEN 50 AND 100000"),
    ("q10_boilerplate", S.boilerplate(), f"CASE WHEN len(list_filter({DP}, lambda p: contains(lower(p), 'lorem ipsum'))) > 0 THEN 1.0 WHEN text = '' THEN 0.0 ELSE {_share(f'len(list_filter({DP}, lambda p: len(list_filter({_POLICY}, lambda y: contains(lower(p), y))) > 0))', f'len({DP})')} END", "s <= 0.4"),
    ("q11_mean_word_length", S.mean_word_length(), _share(_chars(DW), f"len({DW})"), "s BETWEEN 3 AND 10"),
    ("q12_punctuation", S.punctuation(), _share(f"len(list_filter({DS}, lambda x: NOT regexp_matches({strip_sql('x')}, '[.?!{_DQ}]$')))", f"len({DS})"), "s <= 0.85"),
    ("q13_ellipsis", S.ellipsis(), _share(f"len(list_filter({DS}, lambda x: len(list_filter({_ELL}, lambda y: suffix(lower({strip_sql('x')}), y))) > 0))", f"len({DS})"), "s <= 0.3"),
    ("q14_common_english_words", S.common_english_words(), f"least(2, len(list_filter({DW}, lambda w: list_contains(['the','be','to','of','and','that','have','with'], w))))", "s >= 2"),
    ("q15_words_without_alphabets", S.words_without_alphabets(), _share(rf"len(list_filter({DW}, lambda w: regexp_matches(w, '\p{{L}}')))", f"len({DW})"), "s >= 0.8"),
    ("q16_pornographic_urls", S.pornographic_urls(), f"(len(list_filter(regexp_extract_all(text, '{_URL}'), lambda u: contains(u, 'porn'))) > 0)::int", "s <> 1"),
    ("q17_substring_any", S.substring("pipeline", "any"), "contains(text, 'pipeline')::int", "s = 1"),
    ("q17_substring_prefix", S.substring("The ", "prefix"), "starts_with(text, 'The ')::int", "s = 1"),
    ("q17_substring_suffix", S.substring(".", "suffix"), "suffix(text, '.')::int", "s = 1"),
    ("q18_repeated_lines", S.repeated_lines(), _share(f"len(list_distinct({DS}))", f"len({DS})"), "s >= 0.7"),
    ("q19_repeated_paragraphs", S.repeated_paragraphs(), _share(f"len(list_distinct({DP}))", f"len({DP})"), "s >= 0.7"),
    ("q20_repeated_lines_by_char", S.repeated_lines_by_char(), _share(_chars(f"list_distinct({DS})"), _chars(DS)), "s >= 0.8"),
    ("q21_repeated_paragraphs_by_char", S.repeated_paragraphs_by_char(), _share(_chars(f"list_distinct({DP})"), _chars(DP)), "s >= 0.8"),
    ("q22_repeating_top_2grams", S.repeating_top_ngrams(2, 0.2), top_gram_sql(2), "s <= 0.2"),
    ("q22_repeating_top_4grams", S.repeating_top_ngrams(4, 0.16), top_gram_sql(4), "s <= 0.16"),
    ("q23_repeating_duplicate_5grams", S.repeating_duplicate_ngrams(5, 0.15), duplicate_gram_sql(5), "s <= 0.15"),
    ("q24_python_comments", S.python_comments(), None, None),
    ("q25_general_comments", S.general_comments("text/x-c"), None, None),
    ("q26_lines_of_code", S.lines_of_code(), "length(text) - length(replace(text, chr(10), '')) + 1", "s BETWEEN 10 AND 20000"),
    ("q28_xml_header", S.xml_header(), "contains(left(text, 100), '<?xml version=')::int", "s <> 1"),
    ("q29_alpha", S.alphabetic(), _share(_count(r"\p{L}"), "length(text)"), "s >= 0.25"),
    ("q30_html_boilerplate", S.html_boilerplate(), None, None),
]
for _args in _SCORES:
    _score_query(*_args)


_CASCADE_KEEP = " AND ".join(f"coalesce({k.replace('s ', f'({e}) ', 1)}, false)" for n, r, e, k in _SCORES if n[:3] in ("q01", "q09", "q12", "q18", "q19") and e)


def _cascade_sql(left_out: tuple[str, ...] = ()) -> str:
    """The whole cascade: the conditions of its rules on characters, words and lines, and of those on n-grams."""
    names = [n for n in ("q01", "q02", "q03", "q04", "q06", "q07", "q10", "q18", "q19", "q20", "q21", "q09", "q12", "q15", "q14", "q11", "q08", "q13", "q05") if n not in left_out]
    plain = {n[:3]: (e, k) for n, r, e, k in _SCORES if e and not e.startswith("WITH")}
    conditions = [f"coalesce({k.replace('s ', f'({e}) ', 1)}, false)" for e, k in (plain[n] for n in names)]
    grams = [(top_gram_sql(n), x) for n, x in ((2, 0.2), (3, 0.18), (4, 0.16))] + [(duplicate_gram_sql(n), x) for n, x in zip(range(5, 11), (0.15, 0.14, 0.13, 0.12, 0.11, 0.10))]
    conditions += [f"doc_id IN (SELECT doc_id FROM ({sql}) WHERE s <= {x})" for sql, x in grams]
    return f"SELECT doc_id, lang, length(text) AS n FROM documents WHERE text IS NOT NULL AND {' AND '.join(conditions)}"


@register("quality_cascade", f"SELECT doc_id, lang, length(text) AS n FROM documents WHERE {_CASCADE_KEEP}")
def quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [S.non_alphanumeric(), S.word_count(), S.punctuation(), S.repeated_lines(), S.repeated_paragraphs()]
    return score_filter.score_filter(table(spark, sf_dir, "documents"), rules).select("doc_id", "lang", F.length("text").alias("n"))


@register("english_cascade", _cascade_sql())
def english_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heuristic_cascade(table(spark, sf_dir, "documents"), S.english_cascade()).select("doc_id", "lang", F.length("text").alias("n"))


def heuristic_cascade(df: DataFrame, rules: list[S.Rule], text_col: str = "text") -> DataFrame:
    """Rules in order.  Rules whose scores come from one pass over a batch share it, and so do the n-gram
    rules, which see only what the others leave."""
    jvm = [r for r in rules if not r.name.startswith("repeating_")]
    one_pass = [r for r in jvm if flat.supported([r.name])]
    jvm = [r for r in jvm if r not in one_pass]
    grams = [r for r in rules if r.name.startswith("repeating_")]
    out = spread(df)
    if one_pass:
        out = out.withColumn("__scores", flat.heuristics([r.name for r in one_pass])(F.col(text_col)))
        for r in one_pass:
            out = out.where(r.keep(F.col(f"__scores.{r.name}")))
        out = out.drop("__scores")
    out = score_filter.score_filter(out, jvm, text_col)
    if grams:
        name = lambda r: ("top_" if "top" in r.name else "dup_") + "".join(c for c in r.name if c.isdigit())
        sizes = lambda kind: tuple(int(name(r)[4:]) for r in grams if name(r).startswith(kind))
        out = out.withColumn("__shares", flat.gram_shares(sizes("top_"), sizes("dup_"))(F.col(text_col)))
        for r in grams:
            out = out.where(r.keep(F.col(f"__shares.{name(r)}")))
        out = out.drop("__shares")
    return out


@register("other_cascade", _cascade_sql(("q01", "q15", "q14")))
def other_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heuristic_cascade(table(spark, sf_dir, "documents"), S.other_cascade()).select("doc_id", "lang", F.length("text").alias("n"))


@register("r03_score_filter_inverted", f"SELECT doc_id FROM documents WHERE NOT coalesce(len({DW}) BETWEEN 50 AND 100000, false)")
def score_filter_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_filter.score_filter(table(spark, sf_dir, "documents"), S.word_count(), invert=True).select("doc_id")


@register("r02_filter", "SELECT doc_id, n_chars FROM documents WHERE n_chars > 500 AND lang IN ('en', 'de')")
def filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = score_filter.filter_rows(table(spark, sf_dir, "documents"), lambda c: c > 500, "n_chars")
    return score_filter.keep_labels(docs, "lang", ["en", "de"]).select("doc_id", "n_chars")


@register("r06_preserve_by_value", "SELECT audio_filepath, duration FROM manifest_a WHERE duration >= 100")
def preserve_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_filter.preserve_by_value(table(spark, sf_dir, "manifest_a"), "duration", 100.0, "ge").select("audio_filepath", "duration")


@register("r08_add_id", "SELECT count(*) AS n, count(*) AS ids FROM documents")
def add_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_filter.add_id(table(spark, sf_dir, "documents"), "uid", "doc").agg(F.count("*").alias("n"), F.countDistinct("uid").alias("ids"))


@register("r09_split_documents", f"SELECT doc_id, unnest(coalesce({DP}, [NULL])) AS text, unnest(range(coalesce(len({DP}), 1)))::int AS segment_id FROM documents")
def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_join.split_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), "\n\n").select("doc_id", "text", "segment_id")


@register("g01_join_segments", "SELECT sample_id, string_agg(coalesce(text_content, ''), chr(10) || chr(10) ORDER BY position, coalesce(text_content, '')) AS text_content FROM interleaved WHERE modality = 'text' GROUP BY sample_id")
def join_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "interleaved").where("modality = 'text'").select("sample_id", "position", "text_content")
    return split_join.join_segments(rows, "sample_id", "position", "text_content")


_BOUNDED = """WITH RECURSIVE s AS (SELECT sample_id, coalesce(text_content, '') AS t, length(coalesce(text_content, '')) AS n, row_number() OVER (PARTITION BY sample_id ORDER BY position, coalesce(text_content, '')) AS r FROM interleaved WHERE modality = 'text' AND sample_id IS NOT NULL),
f AS (SELECT sample_id, r, t, n AS size, 0 AS piece FROM s WHERE r = 1 UNION ALL SELECT s.sample_id, s.r, s.t, CASE WHEN f.size + s.n + 2 <= 400 THEN f.size + s.n + 2 ELSE s.n END, CASE WHEN f.size + s.n + 2 <= 400 THEN f.piece ELSE f.piece + 1 END FROM f JOIN s ON s.sample_id = f.sample_id AND s.r = f.r + 1)
SELECT sample_id, piece AS position, string_agg(t, chr(10) || chr(10) ORDER BY r) AS text_content FROM f GROUP BY ALL"""


@register("g02_join_segments_bounded", _BOUNDED)
def join_segments_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "interleaved").where("modality = 'text'").select("sample_id", "position", "text_content")
    return split_join.join_segments(rows, "sample_id", "position", "text_content", max_length=400)


@register("r09_g01_round_trip", "SELECT doc_id, coalesce(text, '') AS text FROM documents")
def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split_join.split_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), "\n\n")
    return split_join.join_segments(parts, "doc_id", "segment_id", "text").select("doc_id", "text")


@register("g03_merge_chunks", "SELECT sample_id, string_agg(text_content, chr(10) ORDER BY position) AS text_content, sum(length(text_content))::bigint AS n FROM (SELECT sample_id, position, min(text_content) AS text_content FROM interleaved WHERE modality = 'text' AND trim(text_content) <> '' GROUP BY ALL) GROUP BY sample_id HAVING sum(length(text_content)) + count(*) - 1 <= 900000")
def merge_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "interleaved").where("modality = 'text' AND trim(text_content) <> ''").groupBy("sample_id", "position").agg(F.min("text_content").alias("text_content"))
    return split_join.merge_chunks(rows.withColumn("n", F.length("text_content").cast("long")), ["sample_id"], "position", "text_content", "text_content", ["n"]).select("sample_id", "text_content", "n")


@register("r11_center_crop", "SELECT doc_id, CASE WHEN text IS NOT NULL THEN substr(text, greatest(0, length(text) // 2 - 100) + 1, least(length(text) // 2 + 100, length(text)) - greatest(0, length(text) // 2 - 100)) END AS text FROM documents")
def center_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", score_filter.center_crop(F.col("text"), 100).alias("text"))


@register("r12_head", "SELECT doc_id, left(text, 200) AS text FROM documents")
def head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", score_filter.head(F.col("text"), 200).alias("text"))


# --- modifiers -----------------------------------------------------------------------------------


def _modifier_query(name: str, fn: Callable, sql: str | None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return score_filter.modify(_documents(name, spark, sf_dir), fn)

    register(name, None if sql is None else f"SELECT doc_id, {sql} AS text FROM {ADORNED if name in _ADORNED else 'documents'}")(run)


_NL = r"regexp_replace(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), '(\r\n){3,}', chr(13) || chr(10) || chr(13) || chr(10), 'g')"
_MD = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '\*\*(.*?)\*\*', '\1', 'g'), '\*(.*?)\*', '\1', 'g'), '_(.*?)_', '\1', 'g'), '\[.*?\]\((.*?)\)', '\1', 'g')"
_BARE = strip_sql("text")
_HITS = f"list_filter(list_transform({DP}, lambda p, i: CASE WHEN len(list_filter({_POLICY}, lambda y: contains(lower(p), y))) > 0 THEN i END), lambda i: i IS NOT NULL)"
for _name, _fn, _sql in [
    ("m01_remove_boilerplate", M.remove_boilerplate, f"CASE WHEN len(list_filter({DP}, lambda p: contains(lower(p), 'lorem ipsum'))) > 0 THEN '' WHEN len({_HITS}) = 0 THEN text WHEN list_max({_HITS}) - list_min({_HITS}) + 1 = len({_HITS}) AND (list_min({_HITS}) = 1 OR list_max({_HITS}) = len({DP})) AND len({_HITS}) < len({DP}) THEN array_to_string(list_filter({DP}, lambda p, i: NOT list_contains({_HITS}, i)), chr(10) || chr(10)) ELSE text END"),
    ("m02_remove_lines", lambda t: M.remove_lines(t, ["The tokenizer", "The parser"]), "array_to_string(list_filter(string_split(text, chr(10)), lambda s: s NOT IN ('The tokenizer', 'The parser')), chr(10))"),
    ("m03_remove_markdown", M.remove_markdown, f"array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_MD}), chr(10))"),
    ("m04_normalise_newlines", M.normalise_newlines, _NL),
    ("m05_remove_quotes", M.remove_quotes, f"CASE WHEN length({_BARE}) > 2 AND starts_with(text, '\"') AND suffix(text, '\"') AND (NOT contains({_BARE}, chr(10)) OR NOT suffix(string_split({_BARE}, chr(10))[1], '\"')) THEN substr(text, 2, length(text) - 2) ELSE text END"),
    ("m06_slice_positions", lambda t: M.slice_text(t, 5, -3, trim=False), "CASE WHEN text IS NOT NULL THEN substr(text, 6, greatest(0, length(text) - 3 - 5)) END"),
    ("m06_slice_strings", lambda t: M.slice_text(t, "the", "."), f"CASE WHEN text IS NULL THEN NULL WHEN instr(text, 'the') > 0 AND contains(text, '.') THEN {strip_sql('substr(text, instr(text, ' + chr(39) + 'the' + chr(39) + '), greatest(0, length(text) - instr(reverse(text), ' + chr(39) + '.' + chr(39) + ') + 1 - instr(text, ' + chr(39) + 'the' + chr(39) + ') + 1))')} ELSE '' END"),
    ("m07_remove_urls", M.remove_urls, rf"regexp_replace(text, '(?i)(https?://[^{WS[1:-1]}]+|www\.[^{WS[1:-1]}]+)', '', 'g')"),
    ("m08_reformat_unicode", M.unicode_reformatter(), None),
    ("m09_label_for_training", lambda t: M.label_for_training(t, "__label__hq"), "'__label__hq ' || replace(replace(text, chr(10), ' '), '__label__', ' ')"),
    ("m12_knowledge_list", M.knowledge_list, f"array_to_string(list_transform(list_filter(string_split(coalesce(text, ''), chr(10)), lambda s, i: i > 1 OR starts_with(s, '-')), lambda s: CASE WHEN starts_with(s, '  ') OR starts_with(s, '- ') THEN {strip_sql('substr(s, 3)')} ELSE s END), chr(10))"),
    ("q36_remove_control_characters", M.remove_control_characters, r"regexp_replace(text, '\p{Cc}', '', 'g')"),
    ("q37_strip_punctuation", S.strip_punctuation, r"regexp_replace(lower(text), '[!-/:-@\[-`{-~]', '', 'g')"),
]:
    _modifier_query(_name, _fn, _sql)


# --- deduplication -------------------------------------------------------------------------------


@register("d02_exact_duplicates", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r > 1")
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


@register("j01_remove_duplicates", "SELECT doc_id, length(text) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r > 1)")
def remove_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return dedup.exact_workflow(docs, "doc_id", "text", perform_removal=True).tables["kept"].select("doc_id", F.length("text").alias("n"))


@register("d04_minhash_signatures")
def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.minhash_signatures(table(spark, sf_dir, "documents"), "doc_id", "text", hashes=260, ngram=24)


@register("d06_lsh_buckets")
def lsh_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.lsh_buckets(dedup.minhash_signatures(table(spark, sf_dir, "documents"), "doc_id", "text"))


COMPONENTS = """WITH RECURSIVE e AS (SELECT id AS a, max_id AS b FROM pairwise_results WHERE id <> max_id AND cosine_sim_score >= 0.9::float AND NOT isnan(cosine_sim_score)),
two AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(id, m) AS (SELECT a, least(a, b) FROM two UNION SELECT two.a, reach.m FROM reach JOIN two ON two.b = reach.id WHERE reach.m < two.a)
SELECT id, min(m) AS "group" FROM reach GROUP BY id"""


@register("d08_connected_components", COMPONENTS)
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pairwise_results").where("NOT isnan(cosine_sim_score) AND cosine_sim_score >= cast(0.9 AS float)")
    return dedup.connected_components(rows.select(F.least("id", "max_id").alias("lo"), F.greatest("id", "max_id").alias("hi")).where("lo <> hi"))


@register("d10_fuzzy_duplicates")
def fuzzy_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicates_of_groups(dedup.fuzzy_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text"))


@register("d11_k_means")
def k_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup.k_means(table(spark, sf_dir, "embeddings"), 10, "embedding", iterations=20)
    return out.groupBy("centroid").agg(F.count("*").alias("n"), F.round(F.avg("cosine_dist_to_cent"), 6).alias("mean_distance"))


_UNIT = "SELECT vec_id AS id, label AS c, embedding AS v FROM embeddings"


@register("d14_pairwise_similarity", f"WITH e AS ({_UNIT}), p AS (SELECT a.id, greatest(0, max(list_cosine_similarity(a.v::double[], b.v::double[]))) AS s FROM e a JOIN e b ON a.c = b.c AND b.id < a.id GROUP BY a.id) SELECT e.id, round(coalesce(p.s, 0), 4)::double AS score FROM e LEFT JOIN p USING (id)")
def pairwise_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return dedup.pairwise_similarity(e, (("asc", "vec_id"),), "vec_id", "embedding", "label").select("id", F.round(F.col("cosine_sim_score").cast("double"), 4).alias("score"))


@register("d15_similar_ids", "SELECT DISTINCT id FROM pairwise_results WHERE cosine_sim_score >= 0.95::float AND NOT isnan(cosine_sim_score)")
def similar_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.similar_ids(table(spark, sf_dir, "pairwise_results").where("NOT isnan(cosine_sim_score)"), 0.05)


@register("d16_semantic_duplicates")
def semantic_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.semantic_workflow(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", clusters=10, eps=0.4, iterations=20).tables["duplicates"]


@register("d17_numbered", "SELECT (row_number() OVER (ORDER BY doc_id) - 1)::bigint AS n, doc_id FROM documents")
def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.numbered(table(spark, sf_dir, "documents").select("doc_id"), "n", ["doc_id"]).select("n", "doc_id")


@register("d07_chain_edges", "WITH b AS (SELECT source, list(doc_id ORDER BY doc_id) AS ids FROM documents GROUP BY source) SELECT DISTINCT ids[i] AS x, ids[i + 1] AS y FROM b, unnest(range(1, len(ids))) AS t(i)")
def chain_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = table(spark, sf_dir, "documents").groupBy("source").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return dedup.chain_edges(buckets)


def queries() -> dict[str, Query]:
    from . import demo_media, demo_text  # noqa: F401  they register theirs

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
