"""Sources, sinks, extraction, pipelines and streams."""

import gzip
import io
import json
import tarfile
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltline.functions import extract as X
from siltline.functions.scores import word_count
from siltline.plans import pipeline as P
from siltline.plans.demo_text import _html, _warc, _write_warcs, crawl_extract
from siltline.sources import archives as A
from siltline.sources import files, sinks
from siltline.streaming import streams


def test_listing_and_groups(tmp_path):
    for name, size in [("a.jsonl", 10), ("b.json", 30), ("c.parquet", 5), ("d.txt", 1), ("sub/e.jsonl", 20)]:
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"x" * size)
    deep = files.list_files(str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in deep] == ["a.jsonl", "b.json", "c.parquet", "e.jsonl"]
    assert len(files.list_files([str(tmp_path)])) == 3 and len(files.list_files(str(tmp_path), limit=2)) == 2
    assert [len(g) for g in files.group_files(deep, per_group=3)] == [3, 1] and len(files.group_files(deep)) == 4
    by_size = files.group_files(deep, most_bytes=36)
    assert [[f.rsplit("/", 1)[1] for f in g] for g in by_size] == [["c.parquet", "a.jsonl", "e.jsonl"], ["b.json"]]
    with pytest.raises(ValueError):
        files.group_files(deep, 2, 3)
    (tmp_path / "list.json").write_text(json.dumps(["a.jsonl", "d.txt"]))
    assert files.listed_files(str(tmp_path / "list.json"), "/r") == ["/r/a.jsonl"]


def test_jsonl_and_modes(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "é", None), (2, None, 3.0)], "id long, text string, x double")
    sinks.write_jsonl(df, path, "error")
    assert '"x":null' in "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    assert files.read_jsonl(spark, path, ["id", "text"], "id long, text string, x double").exceptAll(df.select("id", "text")).count() == 0
    sinks.write_jsonl(df, path)
    assert files.read_jsonl(spark, path).count() == 4
    sinks.write_jsonl(df, path, "overwrite")
    assert files.read_jsonl(spark, path, file_col="f").where("f LIKE 'part%'").count() == 2
    with pytest.raises(Exception):
        sinks.write_jsonl(df, path, "error")
    with pytest.raises(ValueError):
        sinks.write_parquet(df, path, "other")
    with pytest.raises(ValueError):
        files.read_jsonl(spark, path, ["nothing"])


def test_pruning_reaches_the_scan(spark, data):
    df = files.read_parquet(spark, f"{data}/documents.parquet", ["doc_id", "lang"]).where("lang = 'en'").select("doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan and "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_token_files(spark, tmp_path):
    texts = ["a bb ccc", "d", ""]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").coalesce(1)
    load = lambda: lambda ts: [[len(w) for w in t.split()] for t in ts]
    made = sinks.write_token_files(df, str(tmp_path / "t"), load, 100, end_of_document=99)
    docs = sinks.read_token_file(made[0][0])
    assert [d.tolist() for d in docs] == [[1, 2, 3, 99], [1, 99], [99]] and docs[0].dtype == np.uint16
    big = sinks.write_token_files(df, str(tmp_path / "u"), load, 100_000)
    assert sinks.read_token_file(big[0][0])[0].dtype == np.int32


def test_sample_archives(spark, tmp_path):
    rows = [("s1", -1, "metadata", "application/json", None, None), ("s1", 0, "text", "text/plain", "hé", None), ("s1", 2, "image", "image/png", None, bytearray(b"png")), ("s2", 0, "image", "image/tiff", None, bytearray(b"tif")), ("s2", 1, "text", "text/plain", "b", None)]
    df = spark.createDataFrame(rows, "sample_id string, position int, modality string, content_type string, text_content string, binary_content binary")
    made = sinks.write_sample_archives(df, str(tmp_path / "a"), 1)
    assert sum(n for _, n in made) == 2
    back = A.read_sample_archives(spark, str(tmp_path / "a"), with_bytes=True)
    got = sorted((r["sample_id"], r["position"], r["modality"], r["text_content"], r["binary_content"] and bytes(r["binary_content"])) for r in back.collect())
    assert got == [("s1", -1, "metadata", None, None), ("s1", 0, "text", "hé", None), ("s1", 2, "image", None, b"png"), ("s2", -1, "metadata", None, None), ("s2", 0, "image", None, b"tif"), ("s2", 1, "text", "b", None)]
    from siltline.operators import interleaved as I

    lazy = I.align(A.read_sample_archives(spark, str(tmp_path / "a")))
    refs = {(r["sample_id"], r["position"]): json.loads(r["source_ref"]) for r in lazy.where("modality = 'image'").collect()}
    r = refs[("s1", 2)]
    with open(r["path"].removeprefix("file:"), "rb") as f:
        f.seek(r["byte_offset"])
        assert f.read(r["byte_size"]) == b"png"
    assert refs[("s2", 0)]["frame_index"] == 0


def test_image_archives(spark, tmp_path):
    df = spark.createDataFrame([("i1", bytearray(b"1"), 0.5), ("i2", bytearray(b"2"), 0.6)], "image_id string, content binary, score double")
    assert sum(n for _, n in sinks.write_image_archives(df, str(tmp_path / "i"), 1)) == 2
    assert sorted((r["image_id"], bytes(r["content"])) for r in A.read_image_archives(spark, str(tmp_path / "i")).collect()) == [("i1", b"1"), ("i2", b"2")]


def test_warc_of_many_records():
    """The time grows with the file: copying the rest of it for each record takes minutes here."""
    began = time.process_time()
    data = _warc([(f"http://{i}", f"<p>{i}</p>") for i in range(60_000)])
    assert [h["warc-target-uri"] for h, _ in A.warc_records(data)] == [f"http://{i}" for i in range(60_000)]
    assert time.process_time() - began < 20


def test_warc_members(spark, tmp_path):
    """Records over several members, several in one, padding between members, and an error after some."""
    pages = [(f"http://{i}", f"<p>{i}</p>" * 50 * i) for i in range(8)]
    whole = list(A.warc_records(gzip.decompress(_warc(pages))))
    assert [A.http_body(b).decode() for _, b in whole] == [t for _, t in pages]
    plain = gzip.decompress(_warc(pages))
    for size in (1, 7, 100, 1000, len(plain)):
        pieces = [gzip.compress(plain[i : i + size]) for i in range(0, len(plain), size)]
        for between in (b"", b"\0" * 600):
            assert list(A.warc_records(between.join(pieces))) == whole
    (tmp_path / "cut.warc.gz").write_bytes(_warc(pages)[:-3])
    (tmp_path / "wrong.warc.gz").write_bytes(_warc(pages[:2]) + b"no member")
    got = [(r["source_id"], r["url"]) for r in A.read_warc(spark, str(tmp_path)).collect()]
    assert sorted(got) == [("cut.warc.gz", u) for u, _ in pages[:-1]] + [("wrong.warc.gz", u) for u, _ in pages[:2]]


def test_warc_files(spark, data, tmp_path):
    """Every page stands in one of the files, however many there are of a partition."""
    _write_warcs(spark, data, str(tmp_path), most_bytes=3000)
    names = {p.name for p in tmp_path.iterdir()}
    want = spark.read.parquet(f"{data}/web_pages.parquet").where("url IS NOT NULL AND text IS NOT NULL")
    got = A.read_warc(spark, str(tmp_path)).select("url", "source_id").collect()
    assert sorted(r["url"] for r in got) == sorted(r["url"] for r in want.select("url").collect())
    assert {r["source_id"] for r in got} == {n for n in names if n.endswith(".gz")} and any(n.endswith("-001.warc.gz") for n in names)


def test_crawl_is_extracted_once(spark, data):
    """A condition on the text doesn't evaluate the extraction twice, and pages are parsed once for both
    language and text; the result is that of the functions on each page."""
    found = crawl_extract(spark, data)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    want = []
    for r in _html(spark, data).where("url IS NOT NULL").collect():
        language = X.guess_language(" ".join(b.text for b in X.html_blocks(r["html"])))
        texts = X.block_texts(r["html"], frozenset(X.STOP_WORDS[language])) if language else []
        assert texts == (X.block_texts(X.html_blocks(r["html"]), frozenset(X.STOP_WORDS[language])) if language else [])
        want += [(r["url"], language, "\n\n".join(texts))] if texts else []
    assert sorted((r["url"], r["language"], r["text"]) for r in found.collect()) == sorted(want) and want


def test_language_by_density():
    """One count of the words gives each language the share that counting it alone gives."""
    for text in (GOOD, "The, the! der die und von; los las", "el la de", "", " ", "x y z", "l'eau de la (le) d'un \"et\" les"):
        shares = {k: X.stop_density(text, frozenset(v)) for k, v in X.STOP_WORDS.items()}
        best = max(shares, key=shares.get)
        assert X.guess_language(text) == (best if shares[best] >= 0.1 else None)


def test_records_go_on_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "BATCH_ROWS", 3)
    (tmp_path / "x").write_bytes(b"abcdefgh")
    rows = lambda path, content: ((chr(c),) for c in content)
    df = files.read_binary(spark, str(tmp_path))
    assert [r[0] for r in files.iterate_files(df, rows, "c string").collect()] == list("abcdefgh")
    assert [r[0] for r in files.iterate_files(df, rows, "c string", 4).collect()] == list("abcd")


def test_warc(spark, tmp_path):
    data = _warc([("http://a", "<p>one</p>"), ("http://b", "two")])
    (tmp_path / "x.warc.gz").write_bytes(data)
    (tmp_path / "broken.warc.gz").write_bytes(b"\x1f\x8bnonsense")
    got = A.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r["url"], bytes(r["content"]), r["source_id"]) for r in got) == [("http://a", b"<p>one</p>", "x.warc.gz"), ("http://b", b"two", "x.warc.gz")]
    assert A.read_warc(spark, str(tmp_path), record_limit=1).count() == 1
    first = len(_warc([("http://a", "<p>one</p>")]))
    refs = spark.createDataFrame([(str(tmp_path / "x.warc.gz"), 0, first), (str(tmp_path / "none"), 0, 5)], "warc_filename string, warc_record_offset long, warc_record_length long")
    assert [bytes(r["content"]) for r in A.read_warc_ranges(refs, A.local_range).collect()] == [b"<p>one</p>"]
    assert A.read_warc_ranges(refs, A.local_range, drop_failed=False).count() == 2


def test_snapshots():
    known = ["CC-MAIN-2023-06", "CC-MAIN-2023-14", "CC-MAIN-2024-10", "other"]
    assert A.main_snapshots(known, "2023-07", "2024-20") == ["CC-MAIN-2024-10", "CC-MAIN-2023-14"]
    assert A.news_months("2023-11", "2024-01") == ["2024-01", "2023-12", "2023-11"]
    for bad in (lambda: A.news_months("2016-01", "2017-01"), lambda: A.main_snapshots(known, "2024-10", "2023-10"), lambda: A.week("2023-1")):
        with pytest.raises(ValueError):
            bad()
    assert A.paths_in(gzip.compress(b"x/1\nx/2\n"), "r") == ["r/x/1", "r/x/2"]


def test_papers(spark, tmp_path):
    def tar(members):
        f = io.BytesIO()
        with tarfile.open(fileobj=f, mode="w") as t:
            for name, body in members:
                info = tarfile.TarInfo(name)
                info.size = len(body)
                t.addfile(info, io.BytesIO(body))
        return f.getvalue()

    paper = gzip.compress(tar([("main.tex", b"\\section{A} text"), ("fig.png", b"x")]))
    (tmp_path / "p.tar").write_bytes(tar([("2301/2301.00001.gz", paper), ("2301/hep-th9901001.gz", gzip.compress(b"\\documentclass{x}\\section{B} one")), ("2301/x.pdf", b"plain")]))
    assert sorted((r["id"], r["files"]) for r in A.read_papers(spark, str(tmp_path)).collect()) == [("2301.00001", ["\\section{A} text"]), ("hep-th/9901001", ["\\documentclass{x}\\section{B} one"])]


def test_download(spark, tmp_path):
    def fetch(url):
        if "bad" in url:
            raise OSError("no")
        return url.encode()

    urls = A.url_table(spark, ["http://x/a", "http://x/bad", "http://x/b"], limit=3)
    assert sorted(r["url"] for r in A.download(urls, fetch, str(tmp_path / "d")).collect()) == ["http://x/a", "http://x/b"]
    assert sorted(p.read_bytes() for p in (tmp_path / "d").glob("x-*") if not p.name.endswith("tmp")) == [b"http://x/a", b"http://x/b"]


GOOD = "The people of the town have been in the habit of walking to the harbour in the evening, and this is what they have told us about it for many years. " * 2


def test_html():
    page = f"<html><head><style>x</style></head><body><div><a href=x>Home of the site</a></div><h1>The title of the page</h1><p>{GOOD}</p><p>short of it</p><p>{GOOD}</p><footer><a>About us and the others</a></footer></body></html>"
    stop = frozenset(X.STOP_WORDS["en"])
    assert X.block_texts(page, stop) == ["The title of the page", GOOD.strip(), "short of it", GOOD.strip()]
    assert X.dense_blocks(f"<p>{GOOD}</p><p>Cheap offers today</p>", stop) == [GOOD.strip()]
    assert X.largest_text("<p>tiny</p>", stop) is None
    assert X.block_texts("<p>字</p>", stop, spaced=False) == ["字"] and X.block_texts("", stop) == []
    assert X.guess_language(GOOD) == "en" and X.guess_language("xyz") is None
    assert X.decode_html("é".encode()) == "é" and X.decode_html("é".encode("latin-1")) == "é" and X.decode_html(None) is None


def test_wiki_latex_notebook_layout():
    wiki = "{{Box|x={{y}}}}'''Bold''' text<ref>no</ref> with [[Link|a label]] and [[Other]].\n== Part ==\n[[File:a.png|thumb|[[x]]]]more [[Category:Things]] __TOC__\n{| class=x\n|}"
    assert X.wiki_text(wiki) == "Bold text with a label and Other.\n\nPart\nmore Things"
    assert X.wiki_text("") is None and X.wiki_text("[[open") == "[[open"
    tex = "\\newcommand{\\me}{value}\n\\title{x}\n% c\n\\section{One}\n% gone\nUse \\me and \\mean. % tail\n\\begin{thebibliography}{9} refs"
    assert X.latex_text(tex) == "\\section{One}\nUse value and \\mean."
    assert X.latex_text("no section") is None and X.latex_text(None) is None
    book = json.dumps({"cells": [{"source": ["a\n", "b"]}, {"source": "c"}], "nbformat": 4})
    assert X.notebook_text(book) == "a\nb\n\nc" and X.notebook_text("x") is None
    assert X.content_text(book.encode(), url="x.ipynb") == ("notebook", "a\nb\n\nc") and X.content_text(b"<html><p>a</p><p>b</p>")[1] == "a\n\nb" and X.content_text(b"plain") == ("text", "plain")
    raw = "<x_0.1><y_0.1>Top<x_0.9><y_0.2><class_Title><x_0.1><y_0.8>Low<x_0.9><y_0.9><class_Text><x_0.1><y_0.75><x_0.9><y_0.79><class_Picture><x_0.1><y_0.1>Cap<x_0.2><y_0.2><class_Caption>"
    assert [e["class"] for e in X.reading_order(X.layout_elements(raw))] == ["Title", "Text", "Picture", "Caption"]
    assert X.layout_elements("<b>x") == [{"class": "Text", "text": "x", "bbox": None}] and X.layout_elements(None) == []


def test_pipeline(spark, tmp_path):
    df = spark.createDataFrame([("a b c",), ("a",)], "text string")
    p = P.Pipeline("p", [P.Step("count", lambda d, low: d.where(F.size(F.split("text", " ")) >= low), {"low": 2}, needs=("text",))])
    assert p.run(df).count() == 1 and p.with_({"count": {"low": 1}}).run(df).count() == 2 and "count" in p.describe()
    with pytest.raises(ValueError):
        p.run(df.withColumnRenamed("text", "x"))
    with pytest.raises(ValueError):
        P.Pipeline("empty").run(df)
    with pytest.raises(KeyError):
        p.with_({"other": {}})
    with pytest.raises(KeyError):
        P.stage_named("other")
    with pytest.raises(ValueError):
        P.from_spec({"stages": [], "workflow": []})
    out, seen = p.run_measured(df)
    assert out.count() == 1 and seen["count"].get["rows"] == 1
    source = str(tmp_path / "in")
    sinks.write_jsonl(df, source)
    spec = {"input": {"path": source}, "stages": [{"stage": "score_filter", "rules": {"rule": "word_count", "low": 2}}], "output": {"path": str(tmp_path / "o"), "mode": "overwrite"}}
    P.run_spec(spark, json.dumps(spec))
    assert files.read_jsonl(spark, str(tmp_path / "o")).count() == 1
    assert P.run_spec(spark, {**spec, "output": None} if False else {k: v for k, v in spec.items() if k != "output"}).count() == 1


def test_streams(spark, tmp_path, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    source = str(tmp_path / "s")
    docs.repartition(3).write.parquet(source)
    from siltline.operators.score_filter import score_filter

    stream = streams.curate_stream(streams.read_stream(spark, source, docs.schema), lambda d: score_filter(d, word_count(), score_cols="n"))
    streams.run_once(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == score_filter(docs, word_count()).count()
    streams.run_once(streams.curate_stream(streams.read_stream(spark, source, docs.schema), lambda d: score_filter(d, word_count(), score_cols="n")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == score_filter(docs, word_count()).count()
    events = spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    assert streams.windowed_counts(events, "ts", "1 hour", ["event_type"]).agg(F.sum("n")).first()[0] == events.count()
    assert streams.sessions(events, "ts", "30 minutes", ["user_id"]).agg(F.sum("n")).first()[0] == events.count()


def test_entry_and_queries(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 100
