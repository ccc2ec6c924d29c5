"""Text extraction, sources and sinks, models and pipelines over the test tables."""

from __future__ import annotations

import gzip
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import models
from ..functions import modifiers as M
from ..functions import scores as S
from ..operators import score_filter
from ..session import new_folder, spread
from ..sources import archives, files, sinks
from . import pipeline
from .demo import DW, WS, register, strip_sql, table


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder for files a query writes and reads, whatever its file system."""
    return new_folder(spark, name)


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as HTML, a paragraph per line."""
    line = lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))
    body = F.array_join(F.transform(F.split("text", "\n"), line), "\n")
    return spread(table(spark, sf_dir, "web_pages")).where("text IS NOT NULL").select("page_id", "url", F.concat(F.lit("<html><head><title>page</title></head><body>"), body, F.lit("</body></html>")).alias("html"))


@register("x01_html_blocks")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _html(spark, sf_dir).withColumn("x", X.html_text("blocks")(F.col("html"))).select("page_id", "x.language", "x.text")


@register("x02_html_density")
def html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _html(spark, sf_dir).withColumn("x", X.html_text("density")(F.col("html"))).select("page_id", "x.language", "x.text")


@register("x03_html_largest")
def html_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _html(spark, sf_dir).withColumn("x", X.html_text("largest")(F.col("html"))).select("page_id", "x.language", "x.text")


_STOPS = "[" + ", ".join(f"'{w}'" for w in X.STOP_WORDS["en"]) + "]"


@register("x05_stop_word_density", f"SELECT doc_id, round(len(list_filter({DW.replace('text', 'lower(text)')}, lambda w: list_contains({_STOPS}, w)))::double / nullif(len({DW}), 0), 6) AS density FROM documents")
def stop_word_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.round(X.stop_word_density(F.col("text"), "en"), 6).alias("density"))


@register("x06_wiki_text")
def wiki_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    source = F.concat(F.lit("{{Infobox|a={{b}}}}'''"), F.coalesce("source", F.lit("x")), F.lit("''' is [[site|a site]].<ref>r</ref>\n== History ==\n[[File:a.jpg|thumb|b]]"), F.col("text"))
    return docs.select("doc_id", X.wiki_extractor("en")(source).alias("text"))


@register("x07_latex_text", r"SELECT doc_id, regexp_replace('\section{One}' || chr(10) || 'The value. ' || regexp_replace(text, '[%\\{}]', ' ', 'g') || chr(10), '^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$', '', 'g') AS text FROM documents WHERE text IS NOT NULL")
def latex_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    source = F.concat(F.lit("\\newcommand{\\name}{value}\n\\begin{document}\n\\section{One}\n% note\nThe \\name. "), F.regexp_replace("text", r"[%\\{}]", " "), F.lit("\n\\begin{thebibliography}{9}x"))
    return docs.select("doc_id", X.latex_extractor()(source).alias("text"))


@register("x08_content", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'notebook' ELSE 'text' END AS kind FROM documents WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''")
def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(~F.col("text").rlike(r"^\s*$"))
    book = F.to_json(F.struct(F.array(F.struct(F.lit("markdown").alias("cell_type"), F.array(F.col("text")).alias("source"))).alias("cells"), F.lit(4).alias("nbformat")))
    rows = docs.select("doc_id", F.encode(F.when(F.col("doc_id") % 2 == 0, book).otherwise(F.col("text")), "UTF-8").alias("content"), F.when(F.col("doc_id") % 2 == 0, "a/b.ipynb").otherwise("a/b").alias("u"))
    return X.extract_content(rows, "content", url_col="u").select("doc_id", "kind")


@register("x10_layout", "SELECT doc_id, 'Text' AS kind, trim(source) AS text FROM documents WHERE source IS NOT NULL AND trim(source) <> '' UNION ALL SELECT doc_id, 'Picture', '' FROM documents WHERE source IS NOT NULL AND trim(source) <> ''")
def layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("trim(source) <> ''")
    raw = F.concat(F.lit("<x_0.1><y_0.2>"), F.col("source"), F.lit("<x_0.9><y_0.3><class_Text><x_0.1><y_0.5><x_0.9><y_0.9><class_Picture>"))
    return docs.select("doc_id", F.explode(X.parse_layout(reorder=True)(raw)).alias("e")).select("doc_id", "e.kind", "e.text")


# --- tokens --------------------------------------------------------------------------------------

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def tokenizer(path: str = VOCABULARY):
    """A loader of a byte-level tokenizer from a file of ranks."""

    def load():
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
        enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [enc.encode_ordinary(t) for t in texts]

    return load


@register("q27_tokenizer_fertility")
def tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_filter.score(table(spark, sf_dir, "documents").select("doc_id", "text"), S.tokenizer_fertility(tokenizer()), "fertility").select("doc_id", F.round("fertility", 6).alias("fertility"))


@register("q33_token_count")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_filter.score_filter(table(spark, sf_dir, "documents"), S.token_count(tokenizer(), 10, 100_000), score_cols="n_tokens").select("doc_id", "n_tokens")


@register("m10_token_splitter")
def token_splitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.inline(M.token_splitter(tokenizer(), 200)(F.col("text"))))


@register("p01_tokenize".replace("p01", "model_p01"))
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(models.tokenize(tokenizer())(F.col("text"))).alias("n"))


@register("q31_per_extension", "SELECT doc_id, CASE WHEN text IS NOT NULL THEN (len(regexp_extract_all(text, '[a-zA-Z0-9\\n?!,.]'))::double / nullif(length(text), 0) >= 0.5 AND list_max(list_transform(string_split(text, chr(10)), lambda x: length(x))) <= 400 AND (length(text) + 1.0) / len(string_split(text, chr(10))) - 1 <= 100)::int END AS ok FROM documents WHERE text IS NULL OR text <> ''")
def per_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = spark.createDataFrame([("python", "py", True, 400, 0.5, None)], "language string, extension string, include boolean, line_max int, alphanum_min double, alpha_min double")
    docs = table(spark, sf_dir, "documents").where("text IS NULL OR text <> ''")
    return S.per_extension(docs, limits, "Python", "py", output_col="ok").select("doc_id", "ok")


_USUAL = f"CASE WHEN text IS NOT NULL THEN (len(list_filter(string_split({strip_sql('text')}, ''), lambda x: list_contains(usual, x)))::double / nullif(length(text), 0) > 0.8)::int END"


@register("q32_histogram", f"WITH c AS (SELECT c, count(*) AS n FROM (SELECT unnest(string_split({strip_sql('text')}, '')) AS c FROM documents WHERE lang = 'en') WHERE c <> '' GROUP BY c), r AS (SELECT c, sum(n) OVER (ORDER BY n DESC, c) - n AS before, sum(n) OVER () AS total FROM c), u AS (SELECT list(c) AS usual FROM r WHERE before < 0.99 * total) SELECT doc_id, {_USUAL} AS usual FROM documents, u")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    usual = S.usual_characters(docs.where("lang = 'en'"), share=0.99)
    return score_filter.score(docs.select("doc_id", "text"), S.histogram(usual, 0.8), "usual").select("doc_id", "usual")


_LOMAX = "pow(1 - ('0x' || substr(md5('42:' || doc_id), 1, 8))::bigint / 4294967296.0::double, -1.0::double / 3) - 1 > 1 - score"


@register("q34_quality_probability", f"SELECT doc_id, round(score, 6) AS score FROM (SELECT doc_id, len(list_filter({DW}, lambda w: list_contains(['the','be','to','of','and','that','have','with'], w)))::double / len(string_split(text, ' ')) AS score FROM documents WHERE text IS NOT NULL) WHERE {_LOMAX}")
def quality_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    share = S.common_english_words(1_000_000, stop_early=False).score(F.col("text")) / F.greatest(F.size(F.split("text", " ")), F.lit(1))
    return docs.withColumn("score", share).where(S.quality_probability(F.col("score"), F.col("doc_id"))).select("doc_id", F.round("score", 6).alias("score"))


_DENSE = lambda words: "coalesce(len(list_filter(ws, lambda w: list_contains([" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "], trim(w, '.,;:!?\"''()'))))::double / nullif(len(ws), 0), 0)"
_DENSITIES = "[" + ", ".join(_DENSE(ws) for ws in X.STOP_WORDS.values()) + "]"
_CODES = "[" + ", ".join(f"'{k.upper()}'" for k in X.STOP_WORDS) + "]"


@register("q35_language_score", f"SELECT doc_id, {_CODES}[list_position(d, list_max(d))] AS language, round(list_max(d), 6) AS score FROM (SELECT doc_id, {_DENSITIES} AS d FROM (SELECT doc_id, {DW.replace('text', 'lower(text)')} AS ws FROM documents WHERE text IS NOT NULL)) WHERE list_max(d) >= 0.1")
def language_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    def predict(texts: list[str]) -> list[tuple[float, str]]:
        out = []
        for t in texts:
            best = max(X.STOP_WORDS, key=lambda k: X.stop_density(t, frozenset(X.STOP_WORDS[k])))
            out.append((X.stop_density(t, frozenset(X.STOP_WORDS[best])), f"__label__{best}"))
        return out

    rule = S.language_score(predict, 0.1)
    return score_filter.score_filter(table(spark, sf_dir, "documents"), rule, score_cols="l").select("doc_id", F.col("l.lang").alias("language"), F.round("l.score", 6).alias("score"))


# --- models --------------------------------------------------------------------------------------


@register("model_p02_classifier")
def classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "text")
    labels = table(spark, sf_dir, "quality_labels").where("quality IS NOT NULL").select("doc_id", "quality")
    model = models.text_classifier(docs.join(labels, "doc_id"), "text", "quality", 1 << 14)
    return models.predict_labels(model, docs).select("doc_id", "predicted")


@register("model_p03_education", "SELECT doc_id, least(5.0, greatest(0.0, n_chars / 500.0 - 1)) AS score, round_even(least(5.0, greatest(0.0, n_chars / 500.0 - 1)), 0)::int AS int_score, CASE WHEN n_chars / 500.0 - 1 >= 2.5 THEN 'high_quality' ELSE 'low_quality' END AS label FROM documents WHERE n_chars IS NOT NULL")
def education(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("n_chars IS NOT NULL")
    return docs.select("doc_id", models.education_score(F.col("n_chars").cast("double") / 500.0 - 1).alias("e")).select("doc_id", "e.*")


@register("model_p05_complexity", "SELECT doc_id, round(0.35 * a + 0.25 * a + 0.15 * b + 0.15 * b + 0.05 * a + 0.05 * CASE WHEN b >= 0.05 THEN b ELSE 0 END, 5) AS complexity FROM (SELECT doc_id, (doc_id % 97) / 97.0 AS a, (doc_id % 31) / 310.0 AS b FROM documents)")
def complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("doc_id") % 97 / 97.0, F.col("doc_id") % 31 / 310.0
    heads = {"creativity_scope": a, "reasoning": a, "constraint_ct": b, "domain_knowledge": b, "contextual_knowledge": a, "number_of_few_shots": b}
    return table(spark, sf_dir, "documents").select("doc_id", models.prompt_complexity(heads).alias("complexity"))


@register("model_p06_safety", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'safe' WHEN doc_id % 3 = 1 THEN 'O' || (doc_id % 13)::varchar ELSE 'unknown' END AS label FROM documents")
def safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("doc_id") % 3
    raw = F.when(third == 0, F.lit("safe")).when(third == 1, F.concat(F.lit("unsafe\nO"), (F.col("doc_id") % 13).cast("string"))).otherwise(F.lit("unsafe"))
    return table(spark, sf_dir, "documents").select("doc_id", models.safety_label(raw).alias("label"))


@register("model_p07_embedding")
def embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", models.hashed_embedding(16)(F.col("text")).alias("embedding"))


@register("model_p08_clean_up", "SELECT doc_id, '<' || text || '>' AS cleaned_text FROM documents WHERE n_chars < 0.8 * 4096")
def clean_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    out = models.clean_up(docs, lambda: lambda ts: [f"<{t}>" for t in ts], "n_chars", 4096)
    return out.select("doc_id", F.when(F.col("text").isNotNull(), F.col("cleaned_text")).alias("cleaned_text"))


@register("model_p09_prompt", "SELECT doc_id, 'Rewrite: ' || coalesce(text, '') || ' [' || coalesce(lang, '') || ']' AS prompt FROM documents")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", models.prompt("Rewrite: {text} [{lang}]", text=F.col("text"), lang=F.col("lang")).alias("prompt"))


@register("m11_diverse_questions")
def diverse_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.concat(F.lit("Here are the questions and answers based on the provided text:\n- Question: what? Answer: "), F.coalesce("source", F.lit("")), F.lit("\n- Question: why?\nAnswer: so."))
    return table(spark, sf_dir, "documents").select("doc_id", M.diverse_questions()(F.col("text"), answer).alias("text"))


@register("model_p09_synthesis", "SELECT doc_id, 'Say it in other words: ' || text || ']' AS generated FROM documents WHERE text IS NOT NULL")
def synthesis(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import media

    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "text")
    return media.synthesise(docs, "Say it in other words: {document}", lambda: lambda ts: [f"[{t}]" for t in ts], after=lambda c: F.regexp_replace(c, r"^\[", "")).select("doc_id", "generated")


@register("model_p09_questions", "SELECT 'Ask in ' || ['English', 'German', 'Thai'][i % 3 + 1] AS text FROM range(300) AS t(i)")
def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import media

    return media.multilingual_questions(spark, "Ask in {language}", ["English", "German", "Thai"], 300, lambda: lambda ts: [f"**{t}**" for t in ts])


# --- sources and sinks ---------------------------------------------------------------------------


@register("w03_jsonl_round_trip", "SELECT doc_id, lang, text FROM documents")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "jsonl")
    sinks.write_jsonl(table(spark, sf_dir, "documents"), path, "overwrite", ["doc_id", "lang", "text"])
    return files.read_jsonl(spark, path, ["doc_id", "lang", "text"], "doc_id long, lang string, text string")


@register("w04_parquet_round_trip", "SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "parquet")
    sinks.write_parquet(table(spark, sf_dir, "documents").where("lang IS NOT NULL AND trim(lang) <> ''"), path, "overwrite", ["doc_id", "lang"], partition_by=["lang"])
    return files.read_parquet(spark, path, ["doc_id", "lang"]).where("lang = 'en'")


@register("w05_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sinks.write_token_files(table(spark, sf_dir, "documents").where("text IS NOT NULL"), _folder(spark, "tokens"), tokenizer(), 50_257, end_of_document=50_256)
    return spark.createDataFrame([(sum(n for _, n in made),)], "documents long")


@register("w06_sample_archives", "SELECT sample_id, position, trim(text_content) AS text_content FROM (SELECT sample_id, position, max(text_content) AS text_content FROM interleaved WHERE modality = 'text' GROUP BY ALL) WHERE text_content IS NOT NULL")
def sample_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "samples")
    rows = table(spark, sf_dir, "interleaved").groupBy("sample_id", "position", "modality", "content_type").agg(F.max("text_content").alias("text_content"), F.first("binary_content", ignorenulls=True).alias("binary_content"))
    sinks.write_sample_archives(rows, path, 500)
    return archives.read_sample_archives(spark, path).where("modality = 'text'").select("sample_id", "position", F.trim("text_content").alias("text_content"))


@register("w11_split_by_bytes", "SELECT count(*) AS n FROM documents")
def split_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "split")
    sinks.split_by_bytes(table(spark, sf_dir, "documents"), path, 200_000)
    return files.read_parquet(spark, path).agg(F.count("*").alias("n"))


@register("w12_csv_round_trip", "SELECT doc_id, source, n_chars FROM documents")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "documents"), path, "overwrite", ["doc_id", "source", "n_chars"])
    return spark.read.option("header", "true").schema("doc_id long, source string, n_chars long").csv(path)


@register("s18_read_interleaved", "SELECT sample_id, position, modality FROM interleaved")
def read_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_interleaved(spark, f"{sf_dir}/interleaved.parquet").select("sample_id", "position", "modality")


@register("s01_file_groups")
def file_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.list_files(sf_dir, [".parquet"])
    return spark.createDataFrame([(i, len(g)) for i, g in enumerate(files.group_files(found, most_bytes=10_000_000))], "group int, files int")


@register("s07_url_table", "SELECT DISTINCT url FROM web_pages WHERE url IS NOT NULL")
def url_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.url_table(spark, table(spark, sf_dir, "web_pages"))


def _page_of(url: str) -> bytes:
    return f"<html><body><p>The page at {url} stands alone.</p></body></html>".encode()


def _page_records(path: str, content: bytes):
    yield os.path.basename(path), content


@register("s10_download_extract", "SELECT DISTINCT 'The page at ' || url || ' stands alone.' AS text FROM web_pages WHERE url IS NOT NULL")
def download_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = archives.download_extract(spark, table(spark, sf_dir, "web_pages"), _page_of, _folder(spark, "download"), _page_records, "file string, content binary", lambda df: X.extract_content(df, "content"))
    return made.select("text")


@register("s11_snapshots")
def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = [f"CC-MAIN-{y}-{w:02d}" for y in (2022, 2023, 2024) for w in (5, 14, 23, 40, 50)]
    names = archives.main_snapshots(known, "2022-20", "2024-10")
    urls = archives.paths_file_urls(names, "https://data.commoncrawl.org") + archives.paths_file_urls(archives.news_months("2023-11", "2024-02"), "https://data.commoncrawl.org", news=True)
    return archives.url_table(spark, urls)


def _warc_record(i: int, url: str, text: str) -> bytes:
    """A compressed response, numbered within its file."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + text.encode()
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{i:08d}>\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(body)}\r\n\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n")


def _warc(pages: list[tuple[str, str]]) -> bytes:
    """A compressed WARC file of responses."""
    return b"".join(_warc_record(i, url, text) for i, (url, text) in enumerate(pages))


def _write_warcs(spark: SparkSession, sf_dir: str, folder: str, most_bytes: int = 1 << 25) -> None:
    """The pages as WARC files, one or more per partition: a file is full at ``most_bytes``.  A file is written
    under a hidden name and renamed."""

    def write(parts):
        from pyspark import TaskContext

        at, pages, k = TaskContext.get(), (r for p in parts for r in zip(p["url"], p["html"])), 0
        temporary = os.path.join(folder, f".{at.partitionId():05d}-{at.taskAttemptId()}")
        page = next(pages, None)
        while page:
            with open(temporary, "wb") as f:
                i = 0
                while page and f.tell() < most_bytes:
                    f.write(_warc_record(i, *page))
                    i, page = i + 1, next(pages, None)
            os.replace(temporary, os.path.join(folder, f"{at.partitionId():05d}-{k:03d}.warc.gz"))
            k += 1
        yield from ()

    # so many parts as the session shuffles into, merged by their size; in order, so that a task that is run
    # again writes the same files
    pages = _html(spark, sf_dir).where("url IS NOT NULL").repartition("page_id").sortWithinPartitions("page_id")
    pages.select("url", "html").mapInPandas(write, "x int").count()


@register("s14_warc", "SELECT url FROM web_pages WHERE url IS NOT NULL AND text IS NOT NULL")
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "warc")
    _write_warcs(spark, sf_dir, folder)
    return archives.read_warc(spark, folder).select("url")


@register("s15_crawl_extract")
def crawl_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "crawl")
    _write_warcs(spark, sf_dir, folder)
    pages = archives.read_warc(spark, folder)
    found = pages.withColumn("x", X.html_text("blocks")(F.decode("content", "UTF-8")))
    return found.select("url", "warc_id", "source_id", "x.language", "x.text").where("text IS NOT NULL")


@register("s16_wiki_dump", "SELECT doc_id::varchar AS id FROM documents WHERE regexp_matches(text, '\\S') AND doc_id % 5 <> 0")
def wiki_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "wiki")
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike(r"\S"))
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), ">", "&gt;"), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}]", " ")
    page = F.concat(F.lit("<page><title>T "), F.col("doc_id"), F.lit("</title><ns>"), F.when(F.col("doc_id") % 5 == 0, "1").otherwise("0"), F.lit("</ns><id>"), F.col("doc_id"), F.lit("</id><revision><text>"), safe, F.lit("</text></revision></page>"))

    def write(parts):
        from pyspark import TaskContext

        path = os.path.join(folder, f"{TaskContext.get().partitionId():05d}.xml")
        with open(path + ".tmp", "w", encoding="utf-8") as f:
            f.write("<mediawiki>\n" + "\n".join(x for p in parts for x in p["p"]) + "\n</mediawiki>\n")
        os.replace(path + ".tmp", path)
        yield from ()

    docs.select(page.alias("p")).mapInPandas(write, "x int").count()
    return archives.read_wiki_dump(spark, folder).select("id")


@register("s20_manifest", "SELECT audio_filepath, audio_sample_rate, round(duration, 6) AS duration, len(segments)::int AS n FROM manifest_a")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "manifest")
    sinks.write_manifest(table(spark, sf_dir, "manifest_a"), path)
    return files.read_manifest(spark, path).select("audio_filepath", "audio_sample_rate", F.round("duration", 6).alias("duration"), F.when(F.col("segments").isNotNull(), F.size("segments")).alias("n"))


@register("s27_index_lookup", "SELECT doc_id, url FROM documents WHERE url IN (SELECT url FROM documents WHERE lang IN ('en', 'de'))")
def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The addresses of documents in two languages, looked up in an index of all documents' addresses."""
    from ..operators.joins import index_lookup as find

    path, docs = _folder(spark, "index"), table(spark, sf_dir, "documents")
    docs.select("doc_id", "url").withColumns({"crawl": F.lit("CC-MAIN-2024-10"), "subset": F.lit("warc")}).write.mode("overwrite").partitionBy("crawl", "subset").parquet(path)
    return find(spark.read.parquet(path), docs.where("lang IN ('en', 'de')"), "url", ["CC-MAIN-2024-10"]).select("doc_id", "url")


@register("pipeline_spec", f"SELECT doc_id, lang FROM documents WHERE coalesce(len({DW}) BETWEEN 50 AND 100000, false) AND coalesce(1 - len(regexp_extract_all(text, '[a-zA-Z0-9\\n?!,.]'))::double / nullif(length(text), 0) <= 0.25, false)")
def spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = {"name": "small cascade", "field": "text", "stages": [{"stage": "score_filter", "rules": {"rule": "word_count", "low": 50}, "text_col": "${field}"}, {"stage": "score_filter", "rules": [{"rule": "non_alphanumeric", "limit": 0.25}], "text_col": "${field}"}, {"stage": "select_present", "columns": ["doc_id", "lang"]}]}
    return pipeline.from_spec(json.dumps(chain)).run(table(spark, sf_dir, "documents"))
