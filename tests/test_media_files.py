"""Images, video headers, clips, words of languages without blanks, and composites."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltline.functions import images, segment
from siltline.operators import media
from siltline.plans import pipeline
from siltline.sources import archives


def png(pixels, how):
    """A PNG file whose rows are filtered by ``how``."""
    h, w = pixels.shape[:2]
    flat = pixels.reshape(h, -1).astype(int)
    n = 1 if pixels.ndim == 2 else pixels.shape[2]
    raw = b""
    for y in range(h):
        up = flat[y - 1] if y else np.zeros_like(flat[0])
        left, corner = (np.concatenate([np.zeros(n, int), r[:-n]]) for r in (flat[y], up))
        guess = left + up - corner
        near = np.where((abs(guess - left) <= abs(guess - up)) & (abs(guess - left) <= abs(guess - corner)), left, np.where(abs(guess - up) <= abs(guess - corner), up, corner))
        raw += bytes([how]) + ((flat[y] - [0 * left, left, up, (left + up) // 2, near][how]) % 256).astype(np.uint8).tobytes()
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[n], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("how", range(5))
@pytest.mark.parametrize("channels", [1, 3, 4])
def test_png_round_trip(how, channels):
    pixels = np.random.default_rng(how).integers(0, 256, (9, 7) if channels == 1 else (9, 7, channels)).astype(np.uint8)
    data = png(pixels, how)
    assert images.image_size(data) == (7, 9)
    assert (images.decode(data) == (pixels if channels == 1 else pixels[:, :, :3])).all()


def test_other_images():
    p = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    bmp = b"BM" + struct.pack("<IHHI", 0, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 4, 2, 1, 24, 0, 0, 0, 0, 0, 0) + p[::-1, :, ::-1].tobytes()
    assert images.image_size(bmp) == (4, 2) and (images.decode(bmp) == p).all()
    pnm = b"P6\n4 2\n255\n" + p.tobytes()
    assert images.image_size(pnm) == (4, 2) and (images.decode(pnm) == p).all()
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 30, 40) + b"\x01\x01\x11\x00"
    assert images.image_size(jpeg) == (40, 30) and images.decode(jpeg) is None and images.decode(jpeg, lambda c: np.ones((30, 40))).shape == (30, 40)
    for bad in (None, b"", b"P5\n", b"\x89PNG\r\n\x1a\nxx", b"GIF8", b"no image"):
        assert images.decode(bad) is None
    assert images.image_size(None) is None and images.image_size(b"GIF89a" + struct.pack("<HH", 3, 4)) == (3, 4)


def test_sharpness():
    flat, board = np.full((10, 10), 7, np.uint8), (np.indices((10, 10)).sum(0) % 2 * 255).astype(np.uint8)
    assert images.sharpness(flat) == 0.0 and images.sharpness(board) > 1e5 and images.sharpness(np.zeros((1, 5))) == 0.0
    assert images.sharpness(np.stack([board] * 3, 2)) == pytest.approx(images.sharpness(board))


def test_code_share():
    unit, n = 4, 21
    code = np.random.default_rng(1).integers(0, 2, (n, n))
    mark = np.ones((7, 7), int)
    mark[1:6, 1:6] = 0
    mark[2:5, 2:5] = 1
    for y, x in ((0, 0), (0, 14), (14, 0)):
        code[max(0, y - 1) : y + 8, max(0, x - 1) : x + 8] = 0
        code[y : y + 7, x : x + 7] = mark
    page = np.full((200, 200), 255)
    page[20 : 20 + n * unit, 30 : 30 + n * unit] = 255 - 255 * np.kron(code, np.ones((unit, unit), int))
    assert images.code_share(page) == pytest.approx((n * unit) ** 2 / 200**2, rel=0.1)
    assert images.code_share(np.full((50, 50), 3)) == 0.0 and images.code_share(np.random.default_rng(2).integers(0, 256, (60, 60))) == 0.0


def box(name, *parts):
    data = b"".join(parts)
    return struct.pack(">I4s", 8 + len(data), name) + data


def test_video_header(spark):
    mvhd = box(b"mvhd", bytes(12), struct.pack(">II", 1000, 5000), bytes(80))
    mdhd = box(b"mdhd", bytes(12), struct.pack(">II", 600, 3000), bytes(4))
    hdlr = box(b"hdlr", bytes(8), b"vide", bytes(12))
    stsd = box(b"stsd", bytes(8), bytes(4), b"avc1", bytes(24), struct.pack(">HH", 640, 360), bytes(40))
    stts = box(b"stts", bytes(4), struct.pack(">III", 1, 125, 24))
    data = box(b"ftyp", b"isom") + box(b"moov", mvhd, box(b"trak", box(b"mdia", mdhd, hdlr, box(b"minf", box(b"stbl", stsd, stts)))))
    assert media.video_header(data) == {"seconds": 5.0, "width": 640, "height": 360, "frame_rate": 25.0, "codec": "avc1"}
    assert media.video_header(b"nothing") is None and media.video_header(None) is None
    got = spark.createDataFrame([(bytearray(data),), (None,), (bytearray(b"xx"),)], "c binary").select(media.video_metadata(F.col("c")).alias("m")).collect()
    assert [r["m"]["width"] for r in got] == [640, None, None] and got[0]["m"]["codec"] == "avc1"


def test_clips(spark, tmp_path):
    rows = [("a", "v1", bytearray(b"xy"), True, 2.0, [1.0, 2.0]), ("b", "v1", bytearray(b"z"), None, 3.0, None), ("c", "v2", None, False, 1.0, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "clip_id string, video string, mp4 binary, passed boolean, duration double, e array<double>")
    stats = {r["video"]: r for r in media.write_clips(df, str(tmp_path), embedding_col="e").collect()}
    assert (stats["v1"]["num_passed"], stats["v1"]["num_transcoded"], stats["v1"]["num_with_embeddings"], stats["v1"]["total_clip_duration"], stats["v1"]["max_clip_duration"]) == (1, 2, 1, 5.0, 3.0)
    assert [bytes(r["bytes"]) for r in spark.read.parquet(f"{tmp_path}/clips").collect()] == [b"xy"] and spark.read.parquet(f"{tmp_path}/filtered_clips").count() == 1
    assert spark.read.parquet(f"{tmp_path}/embeddings").count() == 1 and spark.read.json(f"{tmp_path}/metas").count() == 3
    both = media.combine_stats(media.clip_stats(df, ["video"]))
    assert both.first()["max_clip_duration"] == 3.0 and media.clip_stats(df.limit(0)).first()["total_clip_duration"] == 0.0


def test_words_without_blanks(spark):
    words = frozenset("我们 今天 天气 很好 好 去 公园 北京 大学 北京大学".split())
    assert segment.split_words("我们今天去北京大学，天气很好。OK 42", words) == ["我们", "今天", "去", "北京大学", "天气", "很好", "OK", "42"]
    assert segment.split_words("字", frozenset()) == ["字"] and segment.split_words(None) == [] and segment.split_words("a-b c_d") == ["a", "b", "c_d"]
    thai = frozenset(["ที่", "นี่", "บ้าน"])
    assert segment.split_words("ที่นี่บ้าน", thai) == ["ที่", "นี่", "บ้าน"] and segment.is_dense("th") and not segment.is_dense("en")
    df = spark.createDataFrame([("我们在北京",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(segment.stop_word_density("zh", words)(F.col("t"))).collect()]
    assert got == [pytest.approx(2 / 3), None, None]
    texts = [f"今天天气{x}好，我们去公园{y}。" for x in "很真不太" for y in "玩吧了看"]
    found = segment.lexicon_of(spark.createDataFrame([(t,) for t in texts], "text string"), share=0.5)
    assert {"今天", "天气", "我们", "公园"} <= found and "气很" not in found


def test_documents_and_generated_text(spark):
    df = spark.createDataFrame([("a", {"k": 1}, "x"), ("b", None, None)], "id string, m map<string,int>, t string")
    assert [tuple(r) for r in media.to_documents(df, ["id", "m", "t"], text_col="t").collect()] == [("a", '{"k":1}', "x"), ("b", None, None)]
    made = media.synthesise(df, "Say {document}", lambda: lambda ts: ["" if t.endswith(" ") else f"**{t}**" for t in ts], text_col="t", system="Be kind", drop_empty=True)
    assert [r["generated"] for r in made.collect()] == ["**Be kind\n\nSay x**"]


def test_specification_in_yaml(spark):
    pytest.importorskip("yaml")
    text = "name: small\nfield: text\nstages:\n  - stage: score_filter\n    rules: {rule: word_count, low: 2}\n    text_col: ${field}\n"
    assert pipeline.from_spec(text).run(spark.createDataFrame([("a b c",), ("a",)], "text string")).count() == 1
    with pytest.raises(ValueError):
        pipeline.from_spec("name: x\nworkflow: y\n")


def test_download_extract_limits(spark, tmp_path):
    records = lambda path, content: ((path[-1], i) for i in range(len(content)))
    made = archives.download_extract(spark, ["http://x/a", "http://x/bb", "http://x/fails"], lambda u: {"a": b"1", "bb": b"22"}[u[9:]], str(tmp_path), records, "file string, n long", record_limit=1)
    assert sorted(tuple(r) for r in made.collect()) == [("a", 0), ("b", 0)]


def test_edit_distances(spark):
    import random

    from siltline.functions import metrics

    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            left, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
        assert metrics.word_distance(a, b) == row[len(b)]
    long = [str(i % 97) for i in range(3000)]
    assert metrics.word_distance(long, long[5:]) == 5 and metrics.word_distance(long, []) == 3000
    # characters are counted, not bytes
    df = spark.createDataFrame([("Ünïcode", "ünïcode"), ("Привет", "привет"), ("日本語", "日本"), ("", "x"), (None, "x")], "r string, h string")
    got = [r[0] for r in df.select(metrics.cer(F.col("r"), F.col("h"))).collect()]
    assert got == [pytest.approx(100 / 7), pytest.approx(100 / 6), pytest.approx(100 / 3), None, None]
