"""Writers."""

from __future__ import annotations

import io
import json
import os
import shutil
import struct
import tarfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.interleaved import align, apply_error_policy, materialise

# ignore keeps what is in the directory and adds to it; it is not Spark's mode of that name.
MODES = {"ignore": "append", "append": "append", "overwrite": "overwrite", "error": "errorifexists"}


def _writer(df: DataFrame, mode: str, fields: Sequence[str] | None, rows_per_file: int | None):
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    w = (df.select(*fields) if fields else df).write.mode(MODES[mode])
    return w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w


def write_jsonl(df: DataFrame, path: str, mode: str = "ignore", fields: Sequence[str] | None = None, rows_per_file: int | None = None, partition_by: Sequence[str] = ()) -> None:
    """JSON lines with explicit nulls."""
    _writer(df, mode, fields, rows_per_file).partitionBy(*partition_by).option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "ignore", fields: Sequence[str] | None = None, rows_per_file: int | None = None, partition_by: Sequence[str] = ()) -> None:
    _writer(df, mode, fields, rows_per_file).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "ignore", fields: Sequence[str] | None = None) -> None:
    _writer(df, mode, fields, None).option("header", "true").csv(path)


def write_manifest(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A manifest as one file of JSON lines; manifests are metadata and small."""
    _writer(df.coalesce(1), mode, None, None).option("ignoreNullFields", "false").json(path)


def write_lines(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    df.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").write.mode(MODES[mode]).text(path)


def split_by_bytes(df: DataFrame, path: str, bytes_per_file: int, kind: str = "parquet", mode: str = "overwrite") -> None:
    """Files of about so many bytes: the average row decides how many rows go into one."""
    sample = df.select(F.length(F.to_json(F.struct("*"))).alias("n")).agg(F.avg("n"), F.count("*")).first()
    rows = max(1, int(bytes_per_file / max(sample[0] or 1.0, 1.0)))
    _writer(df, mode, None, rows).format(kind).save(path)


def _make_room(path: str, mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    if os.path.isdir(path) and os.listdir(path):
        if mode == "error":
            raise FileExistsError(path)
        if mode == "overwrite":
            shutil.rmtree(path)
    os.makedirs(path, exist_ok=True)


def _per_partition(df: DataFrame, path: str, suffix: str, write: Callable[[str, Iterator[pd.DataFrame]], int], mode: str) -> DataFrame:
    """(file, rows) of a file per partition in a shared folder.  A file is written under another name
    and renamed, so a task that is run again leaves one complete file."""
    _make_room(path, mode)
    # a directory that is added to gets names that no earlier run has used
    run_id = uuid.uuid4().hex[:8] if mode in ("ignore", "append") and os.listdir(path) else ""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = f"part-{run_id}{'-' if run_id else ''}{TaskContext.get().partitionId():05d}"
        temporary = os.path.join(path, f".{name}-{TaskContext.get().taskAttemptId()}")
        n = write(temporary, parts)
        for end in suffix.split(","):
            if os.path.exists(temporary + end):
                os.replace(temporary + end, os.path.join(path, name + end))
        if n:
            yield pd.DataFrame([(os.path.join(path, name + suffix.split(",")[0]), n)], columns=["file", "rows"])

    return df.mapInPandas(run, "file string, rows long")


INDEX_MAGIC = b"MMIDIDX\x00\x00"
DTYPE_CODES = {np.dtype(np.int32): 4, np.dtype(np.uint16): 8}


def write_token_files(df: DataFrame, path: str, load: Callable[[], Callable[[list[str]], list[list[int]]]], vocabulary_size: int, text_col: str = "text", end_of_document: int | None = None, mode: str = "overwrite") -> list[tuple[str, int]]:
    """Tokens as ``.bin`` with an ``.idx`` per partition: 16 bits a token if the vocabulary allows, else 32;
    the index holds version, type, counts, lengths, byte offsets and document borders."""
    kind = np.dtype(np.uint16 if vocabulary_size <= 1 << 16 else np.int32)

    def write(name: str, parts: Iterator[pd.DataFrame]) -> int:
        lengths, encode = [], None
        with open(name + ".bin", "wb") as f:
            for part in parts:
                encode = encode or load()
                for ids in encode([t for t in part[text_col] if t is not None]):
                    ids = [*ids, end_of_document] if end_of_document is not None else list(ids)
                    f.write(np.array(ids, kind).tobytes())
                    lengths.append(len(ids))
        if not lengths:
            os.remove(name + ".bin")
            return 0
        sizes = np.array(lengths, np.int32)
        offsets = np.concatenate([[0], np.cumsum(sizes[:-1], dtype=np.int64)]) * kind.itemsize
        with open(name + ".idx", "wb") as f:
            f.write(INDEX_MAGIC + struct.pack("<QBQQ", 1, DTYPE_CODES[kind], len(sizes), len(sizes) + 1))
            f.write(sizes.tobytes() + offsets.astype(np.int64).tobytes() + np.arange(len(sizes) + 1, dtype=np.int64).tobytes())
        return len(lengths)

    done = _per_partition(df.select(text_col), path, ".bin,.idx", write, mode)
    return [(r["file"], r["rows"]) for r in done.collect()]


def read_token_file(path: str) -> list[np.ndarray]:
    """Documents of a pair of token files, for tests and inspection."""
    stem = path.removesuffix(".bin").removesuffix(".idx")
    with open(stem + ".idx", "rb") as f:
        if f.read(9) != INDEX_MAGIC:
            raise ValueError("not a token index")
        _, code, n, _ = struct.unpack("<QBQQ", f.read(25))
        sizes = np.frombuffer(f.read(4 * n), np.int32)
        offsets = np.frombuffer(f.read(8 * n), np.int64)
    kind = next(k for k, v in DTYPE_CODES.items() if v == code)
    data = np.fromfile(stem + ".bin", kind)
    return [data[o // kind.itemsize : o // kind.itemsize + s] for o, s in zip(offsets, sizes)]


def write_interleaved(df: DataFrame, path: str, mode: str = "overwrite", read_bytes: bool = False, on_error: str = "error") -> None:
    """Interleaved Parquet; missing bytes may be read first, then the error policy applies."""
    write_parquet(align(apply_error_policy(materialise(df) if read_bytes else df, on_error)), path, mode)


def write_sample_archives(df: DataFrame, path: str, samples_per_partition: int = 1000, mode: str = "overwrite") -> list[tuple[str, int]]:
    """Samples as tar archives: a JSON with lists of texts and images by position, and the images."""
    kept = df.select("sample_id", "position", "modality", "content_type", "text_content", "binary_content")
    parts = max(1, int(df.select("sample_id").distinct().count() / samples_per_partition))
    ends = {"image/jpeg": ".jpg", "image/png": ".png", "image/tiff": ".tiff", "image/webp": ".webp"}

    def write(name: str, batches: Iterator[pd.DataFrame]) -> int:
        samples: dict[str, list] = {}
        n = 0

        def add(t: tarfile.TarFile, member: str, data: bytes) -> None:
            info = tarfile.TarInfo(member)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))

        def flush(t: tarfile.TarFile, key: str, rows: list) -> None:
            size = max((r[0] for r in rows), default=-1) + 1
            texts, images = [None] * size, [None] * size
            for position, modality, kind, text, data in rows:
                if modality == "text" and position >= 0:
                    texts[position] = text
                elif modality == "image" and position >= 0 and data is not None:
                    images[position] = f"{key}.{position}{ends.get(kind, '.img')}"
                    add(t, images[position], data)
            add(t, f"{key}.json", json.dumps({"sample_id": key, "texts": texts, "images": images}, ensure_ascii=False).encode())

        with tarfile.open(name + ".tar", "w") as t:
            last = None
            for b in batches:
                for r in b.itertuples(index=False):
                    if last is not None and r.sample_id != last:
                        flush(t, last, samples.pop(last))
                        n += 1
                    last = r.sample_id
                    samples.setdefault(r.sample_id, []).append((r.position, r.modality, r.content_type, r.text_content, r.binary_content))
            if last is not None:
                flush(t, last, samples.pop(last))
                n += 1
        if not n:
            os.remove(name + ".tar")
        return n

    placed = kept.repartition(parts, "sample_id").sortWithinPartitions("sample_id", "position")
    return [(r["file"], r["rows"]) for r in _per_partition(placed, path, ".tar", write, mode).collect()]


def write_image_archives(df: DataFrame, path: str, images_per_archive: int = 1000, mode: str = "overwrite") -> list[tuple[str, int]]:
    """Images (image_id, content) as tar archives, each with a Parquet file of the other columns."""
    parts = max(1, -(-df.count() // images_per_archive))

    def write(name: str, batches: Iterator[pd.DataFrame]) -> int:
        rows = []
        with tarfile.open(name + ".tar", "w") as t:
            for b in batches:
                for r in b.to_dict("records"):
                    info = tarfile.TarInfo(f"{r['image_id']}.jpg")
                    data = r.pop("content") or b""
                    info.size = len(data)
                    t.addfile(info, io.BytesIO(data))
                    rows.append(r)
        if rows:
            pd.DataFrame(rows).to_parquet(name + ".parquet")
        else:
            os.remove(name + ".tar")
        return len(rows)

    return [(r["file"], r["rows"]) for r in _per_partition(df.repartition(parts), path, ".tar,.parquet", write, mode).collect()]
