"""Queries that once left rows out, on small tables against brute force."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from siltline.functions import extract as X
from siltline.functions import models
from siltline.functions.metrics import word_distance
from siltline.plans import demo, demo_text


def test_interval_overlaps_of_every_user(spark, tmp_path):
    began = datetime.datetime(2024, 1, 1)
    rows = [(i, "click" if i % 3 else "view", began + datetime.timedelta(seconds=i * 17 % 1000), i * 7) for i in range(60)]
    spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    minute = datetime.timedelta(seconds=60)
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and abs(a[2] - b[2]) < minute}
    got = [tuple(r) for r in demo.queries()["j06_interval_overlaps"](spark, str(tmp_path)).collect()]
    assert set(got) == want and len(got) == len(want) and any(rows[a][3] >= 20 for a, _ in want)


def test_cer_of_every_script(spark, tmp_path):
    texts = ["Plain Text", "ÉTÉ à Nice", "Ночной Сбор", "日本語", "ＡＢ 😀 Cd", "straße", "", None]
    segments = [(t, float(i), i + 0.5, "a", (8000,)) for i, t in enumerate(texts)]
    schema = "audio_filepath string, segments array<struct<text string, start double, end double, speaker string, metrics struct<bandwidth int>>>"
    spark.createDataFrame([("x.wav", segments)], schema).write.parquet(f"{tmp_path}/manifest_a.parquet")
    got = {r["start"]: r["cer"] for r in demo.queries()["e02_cer"](spark, str(tmp_path)).collect()}
    # a list of characters is compared as word lists are
    want = {float(i): pytest.approx(word_distance(list(t), list(t.lower())) * 100 / len(t), abs=1e-6) if t else None for i, t in enumerate(texts) if t is not None}
    assert got == want and got[2.0] > 0


def test_notebook_with_large_metadata_and_no_address(spark):
    book = {"metadata": {"widgets": {"state": "x" * 300_000}}, "nbformat": 4, "nbformat_minor": 5, "cells": [{"cell_type": "markdown", "source": ["a\n", "b"]}, {"cell_type": "code", "source": "c"}]}
    other = {"pad": "x" * 300_000, "note": {"cells": [], "nbformat": 4}}
    rows = [(1, json.dumps(book).encode()), (2, json.dumps(other).encode()), (3, b'{"cells" and "nbformat" in broken JSON')]
    got = {r["i"]: (r["kind"], r["text"]) for r in X.extract_content(spark.createDataFrame(rows, "i int, content binary"), "content").collect()}
    assert got == {1: ("notebook", "a\nb\n\nc"), 2: ("text", rows[1][1].decode()), 3: ("text", rows[2][1].decode())}


def test_tokenizer_cuts_only_on_request(spark, tmp_path):
    texts = ["word " * 3000, "a few words", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    ids = demo_text.tokenizer()()
    whole = {i: ids([t])[0] for i, t in enumerate(texts) if t}
    got = {r["doc_id"]: r["n"] for r in demo.queries()["model_p01_tokenize"](spark, str(tmp_path)).collect()}
    assert {i: got[i] for i in whole} == {i: len(v) for i, v in whole.items()} and got[0] >= 3000
    cut = df.select(models.tokenize(demo_text.tokenizer(), most_chars=2000)(F.col("text")).alias("c"), models.tokenize(demo_text.tokenizer(), most_tokens=128)(F.col("text")).alias("t")).where("doc_id = 0").first()
    assert cut["c"] == ids([texts[0][:2000]])[0] and cut["t"] == whole[0][:128]
