"""Metrics of transcripts and recordings."""

from __future__ import annotations

import io
import wave

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import deferred, ratio, words


def word_distance(a: list[str], b: list[str]) -> int:
    """Edit distance of word lists, a column of the table at a time as the bits of one number each for
    where it rises and where it falls (the bit-vector algorithm of Myers and Hyyro)."""
    if not a or not b:
        return len(a) or len(b)
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    every, top, distance = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    rises, falls = every, 0
    for y in b:
        same = places.get(y, 0)
        down = (((same & rises) + rises) ^ rises) | same | falls
        right = falls | (every & ~(down | rises))
        level = rises & down
        distance += bool(right & top) - bool(level & top)
        right = (right << 1 | 1) & every
        rises, falls = ((level << 1) | (every & ~(down | right))) & every, right & down
    return distance


def _pairs(one, kind: str):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else one(x, y) for x, y in zip(a, b)], dtype="float64")

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return deferred(run, kind)


def wer(rounded: bool = True):
    """Word error rate in percent of the reference's words; null without any."""

    def one(ref: str, hyp: str) -> float | None:
        r = ref.split()
        value = word_distance(r, hyp.split()) / len(r) * 100 if r else None
        return round(value, 2) if rounded and value is not None else value

    return _pairs(one, "double")


def cer(ref: Column, hyp: Column) -> Column:
    """Character error rate in percent, unrounded."""
    return ratio(F.levenshtein(ref, hyp) * 100, F.length(ref))


def char_rate(text: Column, seconds: Column) -> Column:
    return ratio(F.length(text), seconds)


def word_rate(text: Column, seconds: Column) -> Column:
    return ratio(F.size(words(text)), seconds)


def wav_seconds(content: bytes | None) -> float:
    """Length of a WAV file, -1 if it cannot be read."""
    try:
        with wave.open(io.BytesIO(content or b"")) as w:
            return w.getnframes() / w.getframerate()
    except (wave.Error, EOFError, ZeroDivisionError):
        return -1.0


def audio_duration():
    def run(content: pd.Series) -> pd.Series:
        return content.map(wav_seconds, na_action=None).astype("float64")

    run.__annotations__ = {"content": pd.Series, "return": pd.Series}
    return deferred(run, "double")


def concatenation_map(segments: Column, silence_ms: int = 500) -> Column:
    """Places of segments (start_ms, end_ms) when they are put one after another with silence between:
    an array of (original_start_ms, original_end_ms, concat_start_ms, concat_end_ms)."""
    ordered = F.array_sort(segments)
    kind = "array<struct<original_start_ms:bigint,original_end_ms:bigint,concat_start_ms:bigint,concat_end_ms:bigint>>"

    def step(acc: Column, s: Column) -> Column:
        at = F.when(F.size(acc) == 0, F.lit(0).cast("long")).otherwise(F.element_at(acc, -1)["concat_end_ms"] + silence_ms)
        a, b = s["start_ms"].cast("long"), s["end_ms"].cast("long")
        return F.concat(acc, F.array(F.struct(a.alias("original_start_ms"), b.alias("original_end_ms"), at.alias("concat_start_ms"), (at + b - a).alias("concat_end_ms")))).cast(kind)

    return F.aggregate(ordered, F.array().cast(kind), step)


def rttm(recording: Column, start: Column, end: Column, speaker: Column) -> Column:
    """One diarisation line per segment of positive length."""
    line = F.format_string("SPEAKER %s 1 %.3f %.3f <NA> <NA> %s <NA> <NA>", recording, start.cast("double"), (end - start).cast("double"), speaker)
    return F.when(end > start, line)
