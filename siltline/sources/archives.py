"""Crawl, encyclopedia, preprint and sample archives."""

from __future__ import annotations

import bz2
import datetime
import gzip
import io
import json
import os
import re
import tarfile
import zlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import iterate_files, read_binary

# --- addresses -----------------------------------------------------------------------------------


def url_table(spark: SparkSession, urls: Sequence[str] | DataFrame, limit: int | None = None) -> DataFrame:
    """A row per address, spread over as many partitions as make sense; of a table (column url) each
    address once."""
    if isinstance(urls, DataFrame):
        found = urls.select("url").where("url IS NOT NULL").distinct()
        return found if limit is None else found.orderBy("url").limit(limit)
    chosen = list(urls)[:limit]
    return spark.createDataFrame([(u,) for u in chosen], "url string").repartition(max(1, min(len(chosen), 1000)))


def week(text: str) -> datetime.date:
    """Monday of an ISO week YYYY-WW."""
    m = re.fullmatch(r"(\d{4})-(\d{2})", text)
    if not m or not 1 <= int(m[2]) <= 53:
        raise ValueError(f"{text} is not YYYY-WW")
    return datetime.date.fromisocalendar(int(m[1]), int(m[2]), 1)


def main_snapshots(available: Sequence[str], start: str, end: str, prefix: str = "CC-MAIN-") -> list[str]:
    """Names of the snapshots from week ``start`` to week ``end``, newest first."""
    a, b = week(start), week(end)
    if a > b:
        raise ValueError("start is after end")
    dated = [(week(n.removeprefix(prefix)), n) for n in available if re.fullmatch(re.escape(prefix) + r"\d{4}-\d{2}", n)]
    return [n for d, n in sorted(dated, reverse=True) if a <= d <= b]


def news_months(start: str, end: str, first: str = "2016-08") -> list[str]:
    """Months YYYY-MM from start to end, newest first; none before ``first``."""
    number = lambda t: int(t[:4]) * 12 + int(t[5:7]) - 1
    for t in (start, end):
        if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", t):
            raise ValueError(f"{t} is not YYYY-MM")
    if number(start) < number(first):
        raise ValueError(f"there is nothing before {first}")
    if number(start) > number(end):
        raise ValueError("start is after end")
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(number(end), number(start) - 1, -1)]


def paths_file_urls(names: Sequence[str], root: str, news: bool = False) -> list[str]:
    """Addresses of the lists of files of snapshots or months."""
    return [f"{root}/crawl-data/CC-NEWS/{n.replace('-', '/')}/warc.paths.gz" if news else f"{root}/crawl-data/{n}/warc.paths.gz" for n in names]


def paths_in(content: bytes, root: str) -> list[str]:
    return [f"{root}/{p}" for p in gzip.decompress(content).decode().split("\n") if p]


def dump_urls(status: dict, root: str, language: str, date: str) -> list[str]:
    """Files of an encyclopedia dump that is done, from its status document."""
    job = status["jobs"]["articlesmultistreamdump"]
    if job["status"] != "done":
        raise ValueError(f"the dump of {date} is not done")
    return [f"{root}/{language}wiki/{date}/{n}" for n in job["files"] if "xml" in n]


def download(df: DataFrame, fetch: Callable[[str], bytes], folder: str, url_col: str = "url") -> DataFrame:
    """(url, path) of files fetched into a shared folder.  A file that is there already and not empty is
    kept, a new one gets its name when it is complete, a failed one is left out."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for part in parts:
            rows = []
            for url in part[url_col]:
                path = os.path.join(folder, re.sub(r"[^\w.-]+", "-", url.split("://")[-1]))
                try:
                    if not (os.path.exists(path) and os.path.getsize(path)):
                        with open(path + f".{os.getpid()}.tmp", "wb") as f:
                            f.write(fetch(url))
                        os.replace(f.name, path)
                    rows.append((url, path))
                except Exception as e:
                    print(f"{url}: {type(e).__name__}: {e}")
            yield pd.DataFrame(rows, columns=["url", "path"])

    return df.select(url_col).mapInPandas(run, "url string, path string")


def download_extract(spark: SparkSession, urls: Sequence[str] | DataFrame, fetch: Callable[[str], bytes], folder: str, records: Callable[[str, bytes], Iterator[tuple]], schema: str, extract: Callable[[DataFrame], DataFrame] | None = None, url_limit: int | None = None, record_limit: int | None = None) -> DataFrame:
    """Addresses to documents in one plan: each file is fetched, taken apart into records of ``schema`` and,
    by ``extract``, into text.  A file's records are yielded one by one."""
    fetched = download(url_table(spark, urls, url_limit), fetch, folder)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from itertools import islice

        names = [f.split()[0] for f in schema.split(", ")]
        for part in parts:
            for path in part["path"]:
                with open(path, "rb") as f:
                    content = f.read()
                found = records(path, content)
                yield pd.DataFrame(list(found if record_limit is None else islice(found, record_limit)), columns=names)

    made = fetched.select("path").mapInPandas(run, schema)
    return extract(made) if extract else made


# --- WARC ----------------------------------------------------------------------------------------


def gzip_members(content: bytes, piece: int = 1 << 14) -> Iterator[bytes]:
    """The members of a gzip file one by one, each checked; what follows a member is never copied whole."""
    view, at = memoryview(content), 0
    while at < len(view):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if at >= len(view):
                raise EOFError("the last member is cut off")
            fed = view[at : at + piece]
            parts.append(member.decompress(fed))
            at += len(fed) - len(member.unused_data)
        yield b"".join(parts)
        at = _PADDING.match(content, at).end()


_PADDING = re.compile(rb"\0*")


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a WARC file, compressed or not.  Of a compressed file as many
    members are held as a record takes, and an error in one leaves the records before it."""
    pieces = gzip_members(content) if content[:2] == b"\x1f\x8b" else iter((content,))
    data, at = b"", 0

    def more(least: int) -> bool:
        """Have so many bytes from ``at`` on, which becomes 0, or all there are; tells if any came."""
        nonlocal data, at
        parts = [data[at:]]
        n = len(parts[0])
        while n < least and (p := next(pieces, None)) is not None:
            parts.append(p)
            n += len(p)
        data, at = b"".join(parts), 0
        return len(parts) > 1

    while True:
        begin = data.find(b"WARC/", at)
        end = data.find(b"\r\n\r\n", begin) if begin >= 0 else -1
        if end < 0:
            at = begin if begin >= 0 else max(at, len(data) - 4)
            if not more(2 * max(0, len(data) - at) + 1):
                return
            continue
        lines = data[begin:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = max(0, int(headers.get("content-length", 0)))
        block = end + 4
        if block + size > len(data):
            at, block = begin, block - begin
            more(block + size)
        yield headers, data[block : block + size]
        at = block + size


def http_body(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


def _responses(path: str, content: bytes) -> Iterator[tuple]:
    for headers, block in warc_records(content):
        if headers.get("warc-type") == "response":
            yield headers.get("warc-target-uri"), (headers.get("warc-record-id") or "").strip("<>").removeprefix("urn:uuid:"), os.path.basename(path), http_body(block)


def read_warc(spark: SparkSession, paths: str | Sequence[str], record_limit: int | None = None) -> DataFrame:
    """(url, warc_id, source_id, content) of the responses."""
    return iterate_files(read_binary(spark, paths), _responses, "url string, warc_id string, source_id string, content binary", record_limit)


def read_warc_ranges(df: DataFrame, open_range: Callable[[str, int, int], bytes], file_col: str = "warc_filename", offset_col: str = "warc_record_offset", length_col: str = "warc_record_length", drop_failed: bool = True, threads: int = 16, output_col: str = "content") -> DataFrame:
    """Add the body of the response at a range of a WARC file; ranges of a batch are read side by side."""

    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        from concurrent.futures import ThreadPoolExecutor

        def one(r: tuple) -> bytes | None:
            try:
                for headers, block in warc_records(open_range(r[0], int(r[1]), int(r[2]))):
                    if headers.get("warc-type") == "response":
                        return http_body(block)
            except Exception as e:
                print(f"{r[0]}@{r[1]}: {type(e).__name__}: {e}")
            return None

        with ThreadPoolExecutor(threads) as pool:
            for a, b, c in parts:
                yield pd.Series(list(pool.map(one, zip(a, b, c))), dtype="object")

    run.__annotations__ = {"parts": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    out = df.withColumn(output_col, F.pandas_udf(run, "binary")(file_col, offset_col, length_col))
    return out.dropna(subset=[output_col]) if drop_failed else out


def local_range(path: str, offset: int, length: int) -> bytes:
    with open(path, "rb") as f:
        f.seek(offset)
        return f.read(length)


# --- encyclopedia dumps and preprints ------------------------------------------------------------

PAGE = "ns string, id string, title string, redirect struct<_title:string>, revision struct<text:struct<_VALUE:string>>"


def read_wiki_dump(spark: SparkSession, paths: str | Sequence[str], language: str = "en") -> DataFrame:
    """(title, id, url, language, source_id, raw_content) of articles: main namespace, no redirects, with
    text.  Spark's XML reader splits the files."""
    df = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(paths if isinstance(paths, str) else ",".join(paths))
    kept = df.where("ns = '0' AND redirect IS NULL AND length(revision.text._VALUE) > 0")
    url = F.concat(F.lit(f"https://{language}.wikipedia.org/wiki/"), F.url_encode(F.replace("title", F.lit(" "), F.lit("_"))))
    return kept.select("title", "id", url.alias("url"), F.lit(language).alias("language"), F.col("_metadata.file_name").alias("source_id"), F.col("revision.text._VALUE").alias("raw_content"))


_NEW_ID, _OLD_ID = re.compile(r"(\d{4}\.\d{4,5})"), re.compile(r"([a-z-]+)(\d{7})")


def paper_id(name: str) -> str:
    """Identifier of a paper from the name of its file."""
    base = re.sub(r"\.(gz|tar|tex|pdf)$", "", os.path.basename(name))
    m = _NEW_ID.search(base)
    if m:
        return m[1]
    m = _OLD_ID.fullmatch(base)
    return f"{m[1]}/{m[2]}" if m else base


def tex_files(content: bytes) -> list[str]:
    """The TeX files of a paper's source: a tar of files, or one compressed file."""
    raw = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    try:
        with tarfile.open(fileobj=io.BytesIO(raw)) as t:
            found = [t.extractfile(m).read() for m in t.getmembers() if m.isfile() and m.name.endswith(".tex")]
    except tarfile.ReadError:
        found = [raw]
    return [f.decode("utf-8", "replace") if b"\\" in f else "" for f in found if f]


def _papers(path: str, content: bytes) -> Iterator[tuple]:
    with tarfile.open(fileobj=io.BytesIO(content)) as t:
        for m in t.getmembers():
            if m.isfile():
                files = [f for f in tex_files(t.extractfile(m).read()) if f]
                yield (paper_id(m.name), os.path.basename(path), files) if files else None


def read_papers(spark: SparkSession, paths: str | Sequence[str], record_limit: int | None = None) -> DataFrame:
    """(id, source_id, files) of papers in tar archives."""
    return iterate_files(read_binary(spark, paths, "*.tar"), _papers, "id string, source_id string, files array<string>", record_limit)


# --- sample archives -----------------------------------------------------------------------------

_MIME = {".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".tif": "image/tiff", ".tiff": "image/tiff", ".webp": "image/webp", ".gif": "image/gif", ".img": "application/octet-stream"}


def _samples(with_bytes: bool):
    def iterate(path: str, content: bytes) -> Iterator[tuple]:
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            members = {m.name: m for m in t.getmembers() if m.isfile()}
            for name in sorted(n for n in members if n.endswith(".json")):
                sample = json.loads(t.extractfile(members[name]).read())
                key = sample.get("sample_id") or name[: -len(".json")]
                extra = json.dumps({k: v for k, v in sample.items() if k not in ("texts", "images", "sample_id")}, ensure_ascii=False)
                yield key, -1, "metadata", "application/json", None, None, json.dumps({"path": path, "member": name}), None, extra
                frames: dict[str, int] = {}
                for i, text in enumerate(sample.get("texts") or []):
                    if text is not None:
                        yield key, i, "text", "text/plain", text, None, json.dumps({"path": path, "member": name}), None, None
                for i, image in enumerate(sample.get("images") or []):
                    if image is None:
                        continue
                    m, ext = members.get(image), os.path.splitext(image)[1].lower()
                    frame = None
                    if ext in (".tif", ".tiff"):
                        frame = frames.get(image, 0)
                        frames[image] = frame + 1
                    ref = {"path": path, "member": image, "byte_offset": m and m.offset_data, "byte_size": m and m.size, "frame_index": frame}
                    yield key, i, "image", _MIME.get(ext, "application/octet-stream"), None, t.extractfile(m).read() if m and with_bytes else None, json.dumps(ref), None if m else f"no member {image}", None

    return iterate


def read_sample_archives(spark: SparkSession, paths: str | Sequence[str], with_bytes: bool = False) -> DataFrame:
    """Interleaved rows of tar archives of samples: a metadata row, then texts and images by position;
    ``source_ref`` holds the byte range of each image."""
    kind = "sample_id string, position int, modality string, content_type string, text_content string, binary_content binary, source_ref string, materialize_error string, metadata string"
    return iterate_files(read_binary(spark, paths, "*.tar"), _samples(with_bytes), kind)


def _images(path: str, content: bytes) -> Iterator[tuple]:
    with tarfile.open(fileobj=io.BytesIO(content)) as t:
        for m in t.getmembers():
            if m.isfile() and os.path.splitext(m.name)[1].lower() in _MIME:
                yield os.path.splitext(m.name)[0], f"{path}/{m.name}", t.extractfile(m).read()


def read_image_archives(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(image_id, image_path, content) of tar archives of images."""
    return iterate_files(read_binary(spark, paths, "*.tar"), _images, "image_id string, image_path string, content binary")


def read_dump_bz2(path: str) -> str:
    with bz2.open(path, "rt", encoding="utf-8") as f:
        return f.read()
