"""Windows, joins, metrics and interleaved rows."""

import io
import json
import wave

import pytest
from pyspark.sql import functions as F

from siltline.functions import metrics as E
from siltline.functions import models
from siltline.operators import interleaved as I
from siltline.operators import joins as J
from siltline.operators import windows as W


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("n,want", [(3, []), (4, [(0, 4)]), (128, [(0, 128)]), (191, [(0, 191)]), (192, [(0, 128), (128, 192)]), (300, [(0, 128), (128, 300)])])
def test_frame_windows(spark, n, want):
    assert [tuple(r) for r in one(spark, W.frame_windows, n, "long")] == want


@pytest.mark.parametrize("d,want", [(0.0, []), (5.0, [(0.0, 5.0)]), (12.0, [(0.0, 10.0), (5.0, 12.0), (10.0, 12.0)])])
def test_stride_windows(spark, d, want):
    assert [tuple(r) for r in one(spark, lambda x: W.stride_windows(x, 10.0, 5.0, 1.0), d, "double")] == want


def test_scenes(spark):
    rows = [("a", i, c) for i, c in enumerate([0, 0, 1, 1, 0, 0, 0, 1, 0])] + [("b", i, 0) for i in range(5)] + [("c", 0, 1), ("c", 1, 0), ("c", 2, 1)]
    df = spark.createDataFrame(rows, "v string, f int, t int")
    got = sorted(map(tuple, W.scenes(df, "v", "f", "t").select("v", "start", "end").collect()))
    assert [g for g in got if g[0] == "a"][:2] == [("a", 0, 2), ("a", 4, 7)] and ("b", 0, 5) in got and ("c", 1, 2) in got
    s = spark.createDataFrame([(0, 25), (0, 3)], "start int, end int")
    assert sorted(map(tuple, W.fit_scenes(s, least=5, most=10, mode="stride").collect())) == [(0, 10), (10, 20), (20, 25)]
    assert sorted(map(tuple, W.fit_scenes(s, most=10, crop=1).collect())) == [(1, 2), (1, 9)]
    with pytest.raises(ValueError):
        W.fit_scenes(s, mode="x")


def seg(a, b, who="a", width=8000, text="one two three four"):
    return {"text": text, "start": float(a), "end": float(b), "speaker": who, "bandwidth": width}


def test_conversation_windows():
    segments = [seg(0, 5), seg(5, 10, "b"), seg(10, 14, "a", 4000), seg(14, 20), seg(20, 25, "b"), seg(25, 60, "b")]
    found, lost = W.build_windows(segments, 16000, target=10.0, max_speakers=2)
    assert [(w["segments"][0]["start"], w["segments"][-1]["end"]) for w in found] == [(0.0, 10.0), (14.0, 25.0)]
    assert found[0]["speaker_durations"] == [5.0, 5.0, 0.0, 0.0, 0.0] and (lost["lost_bw"], lost["dur_lost_bw"]) == (1, 4.0)
    # 5-10 is stopped by the narrow segment; 20-25 and 25-60 are cut without words, so they end where they begin
    assert (lost["lost_win"], lost["dur_lost_win"], lost["lost_next_seg_bm"], lost["dur_lost_next_seg_bm"], lost["lost_no_spkr"], lost["truncations"]) == (3, 45.0, 1, 5.0, 0, 2)
    assert lost["total_segments"] == 6 and lost["total_dur"] == 60.0
    assert W.build_windows(segments, 8000)[1]["lost_sr"] == 6 and W.build_windows(segments, None)[1]["dur_lost_sr"] == 60.0 and W.build_windows([], 16000)[0] == []
    # a segment without speaker counts for none, so one speaker is left
    found, lost = W.build_windows([seg(0, 5, None), seg(5, 10)], 16000, target=10.0)
    assert found == [] and lost["lost_spk"] == 1 and lost["lost_win"] == 1
    # one that says it has none stops the window
    found, lost = W.build_windows([seg(0, 5), seg(5, 10, "no-speaker"), seg(10, 20)], 16000, target=10.0)
    assert found == [] and lost["lost_no_spkr"] == 2 and lost["lost_win"] == 3


def test_window_cut_at_words():
    words = [{"word": w, "start": 6.0 + 2 * i, "end": 8.0 + 2 * i} for i, w in enumerate("one two three four five six seven".split())]
    cut, n = W.build_windows([seg(0, 6), {**seg(6, 20, "b"), "words": words}], 16000, target=10.0)
    assert cut[0]["segments"][-1]["end"] == 10.0 and cut[0]["segments"][-1]["text"] == "one two" and n["truncations"] == 2
    assert W.build_windows([seg(0, 6), {**seg(6, 20, "b"), "words": words}], 16000, target=10.0, truncate=False)[1]["truncations"] == 0


def test_windows_against_the_rule_step_by_step():
    import random

    rng = random.Random(7)
    for _ in range(300):
        at, segments = 0.0, []
        for _ in range(rng.randint(0, 14)):
            at += rng.random() * 3
            segments.append(seg(round(at, 2), round(at + rng.random() * 6, 2), rng.choice(["a", "b", "c", None, "no-speaker"][: rng.choice([2, 3, 4, 5])]), rng.choice([8000, 8000, 8000, 4000])))
        segments.sort(key=lambda s: (s["start"], s["end"]))
        most, want, lost = rng.randint(1, 3), [], {"win": 0, "spk": 0, "no_spkr": 0, "next_seg_bm": 0, "bw": 0}
        for i, s in enumerate(segments):
            if s["bandwidth"] < 8000:
                lost["bw"] += 1
                continue
            n, last, stop = 0, s["end"], len(segments) - 1
            for j in range(i, len(segments)):
                who = {x["speaker"] for x in segments[i : j + 1] if x["speaker"]}
                late = segments[j]["end"] - s["start"] > 8 * (1 + 0.25)
                if segments[j]["bandwidth"] < 8000 or len(who) > most or "no-speaker" in who or late and segments[j]["start"] >= s["start"] + 10:
                    stop = j
                    break
                n, last = n + 1, segments[j]["start"] if late else segments[j]["end"]
                if late:
                    stop = j
                    break
            if not 6 <= last - s["start"] <= 10 or n < 2:
                lost["win"] += 1
                lost["no_spkr"] += segments[stop]["speaker"] in (None, "no-speaker")
                lost["next_seg_bm"] += segments[stop]["speaker"] not in (None, "no-speaker") and segments[stop]["bandwidth"] < 8000
            elif len({x["speaker"] for x in segments[i : i + n] if x["speaker"]}) < 1:
                lost["spk"] += 1
            else:
                want.append((i, n))
        found, stats = W.build_windows(segments, 16000, target=8.0, tolerance=0.25, min_speakers=1, max_speakers=most)
        assert [(segments.index(next(x for x in segments if x["start"] == w["segments"][0]["start"] and x["text"] is w["segments"][0]["text"] and x == w["segments"][0] or x["start"] == w["segments"][0]["start"])), len(w["segments"])) for w in found] == want
        assert {k: stats[f"lost_{k}"] for k in lost} == lost


def test_overlaps():
    assert W.without_overlaps([(0, 10), (5, 17), (20, 30)], 0.5, 10) == [0, 2]
    assert W.without_overlaps([(0, 10), (9.5, 20)], 0.5, 10) == [0, 1]
    assert W.without_overlaps([(0, 10), (9.5, 20)], 0.0, 10.5) == [1]
    assert W.without_overlaps([], 0.5, 10) == [] and W.overlap_share((0, 0), (0, 1)) == 0.0


def test_window_columns(spark, data):
    m = W.filter_overlaps(W.conversation_windows(spark.read.parquet(f"{data}/manifest_a.parquet"), target=30.0), percent=50, target=30.0)
    for r in m.select("windows", "filtered_windows", "filtered_dur").collect():
        assert len(r["filtered_windows"]) <= len(r["windows"])
        assert r["filtered_dur"] == pytest.approx(sum(w["segments"][-1]["end"] - w["segments"][0]["start"] for w in r["filtered_windows"]))


def test_speakers_frames_and_shares(spark):
    kind = "array<struct<speaker:string,start:double,end:double>>"
    assert one(spark, W.speaker_durations, [("a", 0.0, 1.0), ("b", 1.0, 3.0), ("a", 3.0, 4.5), (None, 0.0, 1.0)], kind) == {"a": 2.5, "b": 2.0}
    assert one(spark, W.pick_frame, [3, 1, 2, 4], "array<int>") == 2 and one(spark, lambda x: W.pick_frame(x, "sequence"), [2, 1], "array<int>") == [1, 2]
    df = spark.createDataFrame([(["x", "y", "z"], [0.2, 0.75, 0.05]), (["x", "y"], [0.95, 0.05])], "l array<string>, p array<double>")
    assert [tuple(r[0]) for r in df.select(W.top_shares(F.col("l"), F.col("p"))).collect()] == [("y", "x"), ("x", "NA")]


def test_interval_join_and_mapping(spark):
    mapping = one(spark, E.concatenation_map, [(1000, 2000), (5000, 5500)], "array<struct<start_ms:long,end_ms:long>>")
    assert [tuple(m) for m in mapping] == [(1000, 2000, 0, 1000), (5000, 5500, 1500, 2000)]
    m = spark.createDataFrame([("f", *r) for r in mapping], "k string, original_start_ms long, original_end_ms long, concat_start_ms long, concat_end_ms long").drop("original_end_ms")
    s = spark.createDataFrame([("f", 100, 300, "in"), ("f", 900, 1600, "two"), ("f", 1100, 1400, "none"), ("f", 1500, 2500, "cut"), ("g", 0, 1, "other")], "k string, start_ms long, end_ms long, n string")
    for width in (100, 700, 100_000):
        assert sorted((r["n"], r["start_ms"], r["end_ms"]) for r in J.map_timestamps(s, m, "k", width).collect()) == [("cut", 5000, 5500), ("in", 1100, 1300)]


def test_nearest(spark):
    got = lambda rate, **o: [tuple(r) for r in one(spark, lambda x: J.sample_nearest(x, rate, **o), [0.0, 1.0, 2.0, 10.0], "array<double>")]
    assert got(0.5) == [(0, 1), (2, 3), (3, 2)]
    assert got(0.1) == [(0, 1), (3, 1)]
    assert got(0.5, dedup=False) == [(0, 1), (2, 1), (2, 1), (2, 1), (3, 1), (3, 1)] or len(got(0.5, dedup=False)) == 6
    with pytest.raises(ValueError):
        J.sample_nearest(F.lit(1), 0)


def test_as_of(spark):
    left = spark.createDataFrame([(1, "k", 5), (2, "k", 1), (3, "x", 5)], "id int, key string, t int")
    right = spark.createDataFrame([("k", 2, "a"), ("k", 5, "b"), ("k", 6, "c")], "key string, u int, v string")
    assert sorted((r["id"], r["v"]) for r in J.as_of(left, right, "key", "t", "u").collect()) == [(1, "b"), (2, None), (3, None)]


def test_metrics(spark):
    df = spark.createDataFrame([("a b c", "a x c d", 2.0), ("", "a", 0.0), (None, "a", 1.0)], "r string, h string, s double")
    rows = df.select(E.wer()(F.col("r"), F.col("h")), E.cer(F.col("r"), F.col("h")), E.word_rate(F.col("r"), F.col("s")), E.char_rate(F.col("r"), F.col("s"))).collect()
    assert rows[0][0] == 66.67 and rows[0][1] == pytest.approx(60.0) and rows[0][2:] == (1.5, 2.5)
    assert rows[1][0] is None and rows[1][1] is None and rows[2][0] is None
    f = io.BytesIO()
    with wave.open(f, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes(b"\0\0" * 4000)
    assert E.wav_seconds(f.getvalue()) == 0.5 and E.wav_seconds(b"x") == -1.0 and E.wav_seconds(None) == -1.0
    line = spark.range(1).select(E.rttm(F.lit("f"), F.lit(1.0), F.lit(2.5), F.lit("a")), E.rttm(F.lit("f"), F.lit(1.0), F.lit(1.0), F.lit("a"))).first()
    assert tuple(line) == ("SPEAKER f 1 1.000 1.500 <NA> <NA> a <NA> <NA>", None)


ROWS = [("s", -1, "metadata", None), ("s", 0, "text", "keep"), ("s", 1, "image", None), ("s", 3, "text", "drop"), ("s", 5, "text", "keep"), ("t", -1, "metadata", None), ("t", 0, "text", "drop"), ("u", 0, "table", "x"), ("v", -3, "text", "keep")]


def test_keep_content(spark):
    df = spark.createDataFrame(ROWS, "sample_id string, position int, modality string, text_content string")
    got = sorted((r["sample_id"], r["position"], r["modality"]) for r in I.keep_content(df, (F.col("modality") == "image") | (F.col("text_content") == "keep")).collect())
    assert got == [("s", -1, "metadata"), ("s", 0, "text"), ("s", 1, "image"), ("s", 2, "text")]


def test_align_policy_and_bytes(spark, tmp_path):
    path = tmp_path / "blob"
    path.write_bytes(b"0123456789")
    ref = lambda **k: json.dumps({"path": str(path), **k})
    rows = [("s", 0, "image", ref(byte_offset=2, byte_size=3)), ("s", 1, "image", ref(byte_offset=8, byte_size=5)), ("t", 0, "image", ref()), ("u", 0, "image", None), ("v", 0, "text", None), ("s", 2, "image", ref(byte_offset=2, byte_size=3))]
    df = I.align(spark.createDataFrame(rows, "sample_id string, position int, modality string, source_ref string").withColumn("extra", F.lit(1)))
    assert df.columns == [*I.SCHEMA.names, "extra"]
    got = {(r["sample_id"], r["position"]): (r["binary_content"] and bytes(r["binary_content"]), r["materialize_error"]) for r in I.materialise(df).collect()}
    assert got[("s", 0)] == (b"234", None) == got[("s", 2)] and got[("s", 1)][0] is None and "short read" in got[("s", 1)][1]
    assert got[("t", 0)] == (b"0123456789", None) and got[("u", 0)] == (None, "no source") and got[("v", 0)] == (None, None)
    done = I.materialise(df)
    with pytest.raises(RuntimeError):
        I.apply_error_policy(done, "error")
    assert I.apply_error_policy(done, "drop_row").count() == 4 and I.apply_error_policy(done, "drop_sample").count() == 2 and I.apply_error_policy(done, "warn").count() == 6
    with pytest.raises(ValueError):
        I.apply_error_policy(done, "x")


def test_image_filters(spark):
    df = spark.createDataFrame([("s", 0, "image", bytearray(b"abc")), ("s", 1, "image", None), ("s", 2, "text", None), ("t", 0, "image", bytearray(b"abcdef"))], "sample_id string, position int, modality string, binary_content binary")
    got = sorted((r["sample_id"], r["position"], r["modality"]) for r in I.image_filter(df, lambda c: float(len(c)), 2, 4).collect())
    assert got == [("s", 0, "image"), ("s", 1, "text")]


def test_bins(spark):
    df = spark.createDataFrame([(f"g{i // 2:02d}", 30) for i in range(20)], "g string, n long")
    bins = {}
    for r in I.bins_by_bytes(df, "g", "n", 130).collect():
        bins.setdefault(r["bin"], []).append(r["g"])
    assert all(len(v) * 30 <= 130 for v in bins.values()) and sum(map(len, bins.values())) == 20
    assert all(len({b for b, v in bins.items() if g in v}) == 1 for g in {f"g{i:02d}" for i in range(10)})


def test_model_rules(spark):
    df = spark.createDataFrame([(2.5,), (7.0,), (-1.0,)], "x double")
    assert [tuple(r[0]) for r in df.select(models.education_score(F.col("x"))).collect()] == [(2.5, 2, "high_quality"), (5.0, 5, "high_quality"), (0.0, 0, "low_quality")]
    raw = spark.createDataFrame([("safe",), ("unsafe\nO3",), ("unsafe",), ("what",)], "r string")
    assert [r[0] for r in raw.select(models.safety_label(F.col("r"))).collect()] == ["safe", "O3", "unknown", "unknown"]
    p = spark.createDataFrame([([0.1, 0.7, 0.2],), ([0.5, 0.5, 0.0],)], "p array<double>")
    assert [r["label"] for r in models.classify(p, F.col("p"), ["a", "b", "c"]).collect()] == ["b", "a"]
    assert models.classify(p, F.col("p"), ["a", "b", "c"], keep=["a"]).count() == 1
    k = spark.createDataFrame([(0.5,), (None,), (0.1,)], "s double")
    assert [r[0] for r in k.select(models.threshold_keep(F.col("s"), 0.3)).collect()] == [True, False, False]
    assert [r[0] for r in k.select(models.threshold_keep(F.col("s"), 0.0, missing=-1.0)).collect()] == [True, False, True]


def test_scorer_and_client(spark):
    df = spark.createDataFrame([("bbb",), (None,), ("a",)], "t string").coalesce(1)
    scorer = models.batched_scorer(lambda: lambda xs: [len(x) for x in xs], "int", batch=1)
    assert [r[0] for r in df.select(scorer(F.col("t"))).collect()] == [3, None, 1]
    calls = []

    def flaky(t):
        calls.append(t)
        if len(calls) < 3:
            raise OSError
        return t.upper()

    assert models.Client(flaky, retries=3, wait=0.0)(["a"]) == ["A"] and len(calls) == 3
    with pytest.raises(ZeroDivisionError):
        models.Client(lambda t: 1 / 0, retries=1, wait=0.0)(["a"])
