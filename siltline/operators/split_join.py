"""Splitting documents into segments and joining segments into documents."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_documents(df: DataFrame, separator: str, text_col: str = "text", segment_col: str = "segment_id") -> DataFrame:
    """A row per segment with its 0-based number.  A separator of one character is literal, a longer
    one a pattern; a null text gives one null segment."""
    pattern = re.escape(separator) if len(separator) == 1 else separator
    others = [c for c in df.columns if c not in (text_col, segment_col)]
    parts = df.select(*others, F.posexplode_outer(F.split(F.col(text_col), pattern, -1)).alias("__at", "__part"))
    named = parts.select(*others, F.col("__part").alias(text_col), F.coalesce("__at", F.lit(0)).alias(segment_col))
    return named.select(*[c for c in df.columns if c != segment_col], segment_col)


def join_segments(df: DataFrame, id_col: str = "id", segment_col: str = "segment_id", text_col: str = "text", separator: str = "\n\n", max_length: int | None = None, length_col: str | None = None, drop_segment: bool = True) -> DataFrame:
    """One row per id with its segments in order; other columns keep their first value that is not null.
    A null text counts as an empty segment; rows without an id go.

    With ``max_length`` segments are joined while the lengths in ``length_col`` and the separators stay
    within it, and each piece is a row with a new number.  The pieces are folded from the sorted segments
    of one document inside the aggregation; only a document is ever in one place."""
    rows = df.where(F.col(id_col).isNotNull())
    others = [c for c in df.columns if c not in (id_col, segment_col, text_col, length_col)]
    first = [F.first(c, ignorenulls=True).alias(c) for c in others]
    length = F.col(length_col) if length_col else F.length(F.coalesce(F.col(text_col), F.lit("")))
    item = F.struct(F.col(segment_col).alias("seg"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), length.cast("long").alias("n"))
    grouped = rows.groupBy(id_col).agg(F.array_sort(F.collect_list(item)).alias("__items"), *first)
    if max_length is None:
        out = grouped.withColumn(text_col, F.array_join(F.transform("__items", lambda x: x["text"]), separator))
        if not drop_segment:
            out = out.withColumn(segment_col, F.col("__items")[0]["seg"])
        return out.select(*[c for c in df.columns if c in out.columns and c != "__items"])
    kind = "array<struct<texts:array<string>,n:bigint>>"

    def step(acc, x):
        last = F.element_at(acc, -1)
        size = last["n"] + x["n"] + len(separator)
        fits = (F.size(acc) > 0) & (size <= max_length)
        grown = F.struct(F.concat(last["texts"], F.array(x["text"])).alias("texts"), size.alias("n"))
        fresh = F.struct(F.array(x["text"]).alias("texts"), x["n"].alias("n"))
        return F.when(fits, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(acc, F.array(fresh))).cast(kind)

    pieces = grouped.withColumn("__pieces", F.aggregate("__items", F.array().cast(kind), step))
    flat = pieces.select(id_col, *others, F.posexplode("__pieces").alias(segment_col, "__piece"))
    out = flat.withColumn(text_col, F.array_join("__piece.texts", separator))
    if length_col:
        out = out.withColumn(length_col, F.col("__piece.n"))
    return out.select(*[c for c in df.columns if c in out.columns])


def merge_chunks(df: DataFrame, group_cols: Sequence[str] = ("url",), chunk_col: str = "chunk_id", text_col: str = "cleaned_text", raw_col: str = "text", token_cols: Sequence[str] = (), marker: str | None = None, most_chars: int = 900_000, separator: str = "\n") -> DataFrame:
    """Chunks of a page back into one text: one row per chunk number, without marker, empty and null
    chunks, joined in order; token counts are summed, other columns keep their first value, and texts
    that are empty or too long go."""
    once = df.dropDuplicates([*group_cols, chunk_col])
    good = once.where(F.col(text_col).isNotNull() & (F.trim(text_col) != ""))
    if marker is not None:
        good = good.where(F.trim(text_col) != marker)
    rest = [c for c in df.columns if c not in (*group_cols, chunk_col, text_col, raw_col, *token_cols)]
    ordered = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(chunk_col, F.coalesce(F.col(c), F.lit("")).alias("t")))), lambda x: x["t"]), separator).alias(c)
    texts = [ordered(text_col)] + ([ordered(raw_col)] if raw_col in df.columns and raw_col != text_col else [])
    out = good.groupBy(*group_cols).agg(*texts, *[F.sum(c).alias(c) for c in token_cols], *[F.first(c, ignorenulls=True).alias(c) for c in rest])
    return out.where(F.length(text_col).between(1, most_chars))
