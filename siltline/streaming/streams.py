"""The row-local operators on streams, and event-time aggregation (an extension)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "parquet", files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(kind).load(path)


def run_once(df: DataFrame, path: str, checkpoint: str, kind: str = "parquet", mode: str = "append") -> None:
    """Everything that is there, then stop; another call goes on where this one ended."""
    df.writeStream.format(kind).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()


def curate_stream(df: DataFrame, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A row-local transform (score, filter, modify, split) as it is."""
    return transform(df)


def drop_repeats(df: DataFrame, keys: list[str], time_col: str, within: str = "1 hour") -> DataFrame:
    """First row per key within the watermark; the state is bounded by it."""
    return df.withWatermark(time_col, within).dropDuplicatesWithinWatermark(keys)


def windowed_counts(df: DataFrame, time_col: str, length: str, keys: list[str], late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Rows per key and tumbling or sliding window; later rows than ``late`` are left out."""
    w = F.window(time_col, length, slide) if slide else F.window(time_col, length)
    rows = df.withWatermark(time_col, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"))
    return rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")


def sessions(df: DataFrame, time_col: str, gap: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Rows per key and session, which ends after a gap."""
    rows = df.withWatermark(time_col, late).groupBy(F.session_window(time_col, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return rows.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n")
