"""Files: listing, grouping, JSON lines and Parquet, interleaved tables, manifests."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.interleaved import SCHEMA, align

EXTENSIONS = (".jsonl", ".json", ".parquet")
BATCH_ROWS, BATCH_BYTES = 10_000, 1 << 24


def list_files(paths: str | Sequence[str], extensions: Sequence[str] | None = EXTENSIONS, limit: int | None = None, recursive: bool | None = None) -> list[str]:
    """Files under a root (with its sub-directories) or under each of several paths (without)."""
    deep = isinstance(paths, str) if recursive is None else recursive
    found = []
    for p in [paths] if isinstance(paths, str) else paths:
        if os.path.isfile(p):
            found.append(p)
            continue
        for root, dirs, names in os.walk(p):
            found += [os.path.join(root, n) for n in names]
            if not deep:
                break
    kept = sorted(f for f in found if not extensions or f.endswith(tuple(extensions)))
    return kept[:limit]


def group_files(files: Sequence[str], per_group: int | None = None, most_bytes: int | None = None) -> list[list[str]]:
    """Groups of so many files, or filled in order of size up to so many bytes; one file each by default."""
    if per_group and most_bytes:
        raise ValueError("give a number of files or of bytes, not both")
    if not most_bytes:
        n = per_group or 1
        return [list(files[i : i + n]) for i in range(0, len(files), n)]
    out: list[list[str]] = []
    room = 0
    for f in sorted(files, key=os.path.getsize):
        size = os.path.getsize(f)
        if not out or size > room:
            out.append([])
            room = most_bytes
        out[-1].append(f)
        room -= size
    return out


def listed_files(json_path: str, root: str, extensions: Sequence[str] | None = EXTENSIONS) -> list[str]:
    """Paths below ``root`` named by a JSON list of relative paths."""
    with open(json_path) as f:
        names = json.load(f)
    return [os.path.join(root, n) for n in names if not extensions or n.endswith(tuple(extensions))]


def _chosen(df: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    if fields is None:
        return df
    found = [f for f in fields if f in df.columns]
    if not found:
        raise ValueError(f"none of {', '.join(fields)} is in the files")
    return df.select(*found)


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], fields: Sequence[str] | None = None, schema: T.StructType | str | None = None, file_col: str | None = None) -> DataFrame:
    """JSON lines.  With a schema nothing is read twice; without one it is inferred."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*")
    df = (reader.schema(schema) if schema else reader).json(paths if isinstance(paths, str) else list(paths))
    df = _chosen(df, fields)
    return df.withColumn(file_col, F.col("_metadata.file_name")) if file_col else df


def read_parquet(spark: SparkSession, paths: str | Sequence[str], fields: Sequence[str] | None = None, merge: bool = False) -> DataFrame:
    """Parquet; only the chosen columns are read."""
    return _chosen(spark.read.option("mergeSchema", str(merge).lower()).parquet(*([paths] if isinstance(paths, str) else paths)), fields)


def read_interleaved(spark: SparkSession, paths: str | Sequence[str], fields: Sequence[str] | None = None, overrides: dict[str, str] | None = None) -> DataFrame:
    """Interleaved tables: the core columns always, null where a file lacks one, and the chosen others."""
    df = align(read_parquet(spark, paths, merge=True), overrides)
    return df if fields is None else df.select(*SCHEMA.names, *[f for f in fields if f in df.columns and f not in SCHEMA.names])


MANIFEST = "audio_filepath string, dataset_name string, audio_sample_rate int, duration double, segments array<struct<text:string,start:double,end:double,speaker:string,metrics:struct<bandwidth:int>>>"


def read_manifest(spark: SparkSession, paths: str | Sequence[str], schema: str | None = MANIFEST) -> DataFrame:
    """Audio manifests, one JSON object per line that is not blank."""
    return read_jsonl(spark, paths, schema=schema)


def read_transcript_table(spark: SparkSession, path: str, audio_root: str, columns: Sequence[str] = ("id", "file_name", "raw_text", "text", "_phones", "num_samples", "gender")) -> DataFrame:
    """A tab-separated list of recordings with their transcripts."""
    df = spark.read.csv(path, sep="\t", quote="").toDF(*columns)
    return df.select(F.concat(F.lit(audio_root.rstrip("/") + "/"), "file_name").alias("audio_filepath"), "text")


def read_recordings(spark: SparkSession, root: str, pattern: str = "*.wav", limit: int | None = None) -> DataFrame:
    """Recordings below a root with their bytes."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    df = df.select(F.col("path").alias("audio_filepath"), "length", "content")
    return df.orderBy("audio_filepath").limit(limit) if limit else df


def read_binary(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(paths if isinstance(paths, str) else list(paths))


def iterate_files(df: DataFrame, iterate, schema: str, record_limit: int | None = None, file_col: str | None = None) -> DataFrame:
    """Rows of ``iterate(path, content)``, which yields a tuple per record or None to drop it.  An error
    ends its file only; ``record_limit`` counts kept records per file.  Records go on in batches of at most
    ``BATCH_ROWS``, and of ``BATCH_BYTES`` or a single record, not by the file."""
    names = [f.split()[0] for f in schema.split(", ")] + ([file_col] if file_col else [])

    def kept(path: str, content: bytes) -> Iterator[tuple]:
        n = 0
        try:
            for r in iterate(path, content):
                if r is None:
                    continue
                yield (*r, os.path.basename(path)) if file_col else r
                n += 1
                if record_limit and n >= record_limit:
                    break
        except Exception as e:  # a broken file keeps the records read before
            print(f"{path}: {type(e).__name__}: {e}")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content in zip(part["path"], part["content"]):
                rows, size = [], 0
                for r in kept(path, content):
                    n = sum(len(v) for v in r if isinstance(v, (bytes, str)))
                    if rows and (len(rows) >= BATCH_ROWS or size + n > BATCH_BYTES):
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                    rows.append(r)
                    size += n
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return df.select("path", "content").mapInPandas(run, schema + (f", {file_col} string" if file_col else ""))
