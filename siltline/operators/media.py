"""Filters of images by their pixels, clips and their statistics, batches as documents, and generated text."""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import images
from ..functions.expr import deferred
from ..functions.models import generate, prompt
from .interleaved import keep_content

# --- images --------------------------------------------------------------------------------------


def pixel_filter(df: DataFrame, keep: Callable[[Column], Column], content_col: str = "binary_content", decoder: images.Decoder | None = None) -> DataFrame:
    """Image rows whose measures pass; a missing or unreadable image goes, other rows stay."""
    measured = df.withColumn("__image", F.when(F.col("modality") == "image", images.measures(decoder)(F.col(content_col))))
    return keep_content(measured, (F.col("modality") != "image") | F.coalesce(keep(F.col("__image")), F.lit(False))).drop("__image")


def aspect_ratio_filter(df: DataFrame, low: float = 1.0, high: float = 2.0, **options) -> DataFrame:
    """Images whose width is ``low`` to ``high`` times their height."""
    return pixel_filter(df, lambda m: (m["width"] / m["height"]).between(low, high), **options)


def blur_filter(df: DataFrame, least: float = 100.0, **options) -> DataFrame:
    """Images that are sharp enough."""
    return pixel_filter(df, lambda m: m["sharpness"] >= least, **options)


def code_filter(df: DataFrame, most: float = 0.05, **options) -> DataFrame:
    """Images of which two-dimensional codes take up less than ``most``."""
    return pixel_filter(df, lambda m: m["code_share"] < most, **options)


# --- video ---------------------------------------------------------------------------------------


def _boxes(data: bytes, at: int, end: int):
    """(name, begin, end) of the boxes in a part of an MP4 file."""
    while at + 8 <= end:
        size, name = struct.unpack(">I4s", data[at : at + 8])
        head = 8
        if size == 1:
            size, head = struct.unpack(">Q", data[at + 8 : at + 16])[0], 16
        elif size == 0:
            size = end - at
        if size < head:
            return
        yield name, at + head, min(at + size, end)
        at += size


def video_header(data: bytes | None) -> dict | None:
    """Seconds, width, height, frames a second and codec of an MP4 file; None if there is no such header."""
    found: dict = {"seconds": None, "width": None, "height": None, "frame_rate": None, "codec": None}
    track: dict = {}

    def walk(at: int, end: int) -> None:
        for name, a, z in _boxes(data, at, end):
            if name in (b"moov", b"trak", b"mdia", b"minf", b"stbl"):
                if name == b"trak":
                    track.clear()
                walk(a, z)
            elif name == b"mvhd":
                long = data[a] == 1
                scale, length = struct.unpack(">IQ" if long else ">II", data[a + (20 if long else 12) : a + (32 if long else 20)])
                found["seconds"] = length / scale if scale else None
            elif name == b"mdhd":
                long = data[a] == 1
                track["scale"], track["length"] = struct.unpack(">IQ" if long else ">II", data[a + (20 if long else 12) : a + (32 if long else 20)])
            elif name == b"hdlr":
                track["kind"] = data[a + 8 : a + 12]
            elif name == b"stsd" and track.get("kind") == b"vide":
                found["codec"] = data[a + 12 : a + 16].decode("latin-1")
                found["width"], found["height"] = struct.unpack(">HH", data[a + 8 + 32 : a + 8 + 36])
            elif name == b"stts" and track.get("kind") == b"vide" and track.get("length"):
                n = struct.unpack(">I", data[a + 4 : a + 8])[0]
                frames = sum(struct.unpack(">I", data[a + 8 + 8 * i : a + 12 + 8 * i])[0] for i in range(n))
                found["frame_rate"] = frames * track["scale"] / track["length"]

    try:
        walk(0, len(data or b""))
    except (struct.error, IndexError):
        return None
    return found if any(v is not None for v in found.values()) else None


def video_metadata(content: Column) -> Column:
    """The header of a video as a struct, null where there is none."""
    def run(contents: pd.Series) -> pd.DataFrame:
        rows = [video_header(c) or {} for c in contents]
        made = pd.DataFrame(rows, columns=["seconds", "width", "height", "frame_rate", "codec"])
        return made.astype({"seconds": "Float64", "width": "Int64", "height": "Int64", "frame_rate": "Float64", "codec": "object"}).where(made.notna(), None)

    run.__annotations__ = {"contents": pd.Series, "return": pd.DataFrame}
    return deferred(run, "seconds double, width long, height long, frame_rate double, codec string")(content)


COUNTS = ("filtered_by_motion", "filtered_by_aesthetic", "passed", "transcoded", "with_embeddings", "with_caption", "with_webp")


def clip_stats(clips: DataFrame, by: Sequence[str] = (), flags: Sequence[str] = COUNTS, duration_col: str = "duration") -> DataFrame:
    """Numbers of clips by flag, the seconds of all and of the longest; null flags count as not set."""
    present = [f for f in flags if f in clips.columns]
    counts = [F.coalesce(F.sum(F.col(f).cast("long")), F.lit(0)).alias(f"num_{f}") for f in present]
    seconds = F.coalesce(F.sum(duration_col), F.lit(0.0)).alias("total_clip_duration"), F.coalesce(F.max(duration_col), F.lit(0.0)).alias("max_clip_duration")
    return clips.groupBy(*by).agg(*counts, *seconds)


def combine_stats(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Statistics of several parts as one."""
    return stats.groupBy(*by).agg(*[(F.max(c) if c.startswith("max_") else F.sum(c)).alias(c) for c in stats.columns if c.startswith(("num_", "total_", "max_"))])


def write_clips(clips: DataFrame, folder: str, id_col: str = "clip_id", video_col: str = "video", mp4_col: str = "mp4", preview_col: str | None = None, embedding_col: str | None = None, passed_col: str = "passed", metadata_cols: Sequence[str] = ()) -> DataFrame:
    """Write clips, previews, metadata and embeddings below ``folder``, by Spark's writers only, so that any
    file system it knows will do, and return the statistics of each video.

    ``clips`` and ``filtered_clips`` hold (id, bytes), ``previews`` likewise, ``metas`` a JSON line a clip with
    the hash of its bytes, ``embeddings`` (id, embedding), ``videos`` a JSON line a video with its statistics."""
    passed = F.coalesce(F.col(passed_col), F.lit(False))
    some = clips.where(F.col(mp4_col).isNotNull())
    for name, part in (("clips", some.where(passed)), ("filtered_clips", some.where(~passed))):
        part.select(F.col(id_col).alias("id"), F.col(mp4_col).alias("bytes")).write.mode("overwrite").parquet(f"{folder}/{name}")
    if preview_col:
        clips.where(F.col(preview_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(preview_col).alias("bytes")).write.mode("overwrite").parquet(f"{folder}/previews")
    if embedding_col:
        clips.where(passed & F.col(embedding_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(embedding_col).alias("embedding")).write.mode("overwrite").parquet(f"{folder}/embeddings")
    meta = clips.select(F.col(id_col).alias("id"), F.col(video_col).alias("video"), passed.alias("passed"), F.sha2(mp4_col, 256).alias("sha256"), F.length(mp4_col).alias("n_bytes"), *metadata_cols)
    meta.write.mode("overwrite").json(f"{folder}/metas")
    flags = clips.withColumns({"transcoded": F.col(mp4_col).isNotNull(), "with_embeddings": F.col(embedding_col).isNotNull() if embedding_col else F.lit(False), "with_webp": F.col(preview_col).isNotNull() if preview_col else F.lit(False), "passed": passed})
    stats = clip_stats(flags, [video_col])
    stats.write.mode("overwrite").json(f"{folder}/videos")
    return clips.sparkSession.read.schema(stats.schema).json(f"{folder}/videos")


# --- other media as documents --------------------------------------------------------------------


def to_documents(df: DataFrame, fields: Sequence[str], text_col: str | None = None) -> DataFrame:
    """The chosen fields of image or audio rows as documents; a struct or array becomes JSON."""
    plain = lambda c: F.to_json(c) if df.schema[c].dataType.typeName() in ("struct", "array", "map") else F.col(c)
    return df.select(*[plain(c).alias("text" if c == text_col else c) for c in fields])


# --- generated text ------------------------------------------------------------------------------


def synthesise(df: DataFrame, template: str, load: Callable, text_col: str = "text", output_col: str = "generated", system: str = "", after: Callable[[Column], Column] | None = None, drop_empty: bool = False) -> DataFrame:
    """A model's first answer to a template filled with each document ({document}), cleaned by ``after``;
    the system prompt, if any, goes first."""
    asked = prompt((system + "\n\n" if system else "") + template, document=F.col(text_col))
    made = generate(df.withColumn("__prompt", asked), "__prompt", load, output_col).drop("__prompt")
    if after:
        made = made.withColumn(output_col, after(F.col(output_col)))
    return made.where(F.col(output_col) != "") if drop_empty else made


def multilingual_questions(spark: SparkSession, template: str, languages: Sequence[str], samples: int, load: Callable) -> DataFrame:
    """(text): ``samples`` answers to a template with {language}, the languages in turn; bold marks go."""
    names = F.array(*[F.lit(x) for x in languages])
    asked = spark.range(samples).withColumn("language", names[(F.col("id") % len(languages)).cast("int")])
    made = generate(asked.withColumn("__prompt", prompt(template, language=F.col("language"))), "__prompt", load, "text")
    return made.select(F.regexp_replace("text", r"\*", "").alias("text"))
