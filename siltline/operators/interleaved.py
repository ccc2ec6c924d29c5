"""Interleaved text and images: schema, row rules, filters and byte materialisation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.expr import words

SCHEMA = T.StructType(
    [
        T.StructField("sample_id", T.StringType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("modality", T.StringType(), False),
        T.StructField("content_type", T.StringType()),
        T.StructField("text_content", T.StringType()),
        T.StructField("binary_content", T.BinaryType()),
        T.StructField("source_ref", T.StringType()),
        T.StructField("materialize_error", T.StringType()),
    ]
)
SOURCE_REF = "path string, member string, byte_offset long, byte_size long, frame_index int"


def align(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """The core columns with their types, nulls where one is missing, then all other columns."""
    kinds = {f.name: f.dataType.simpleString() for f in SCHEMA} | (overrides or {})
    core = [(F.col(n) if n in df.columns else F.lit(None)).cast(k).alias(n) for n, k in kinds.items() if n in SCHEMA.names or n in df.columns]
    return df.select(*core, *[c for c in df.columns if c not in kinds])


def valid_rows(df: DataFrame) -> Column:
    """Known modality, metadata at -1, content from 0 on."""
    return (F.col("modality") == "metadata") & (F.col("position") == -1) | F.col("modality").isin("text", "image") & (F.col("position") >= 0)


def keep_content(df: DataFrame, mask: Column) -> DataFrame:
    """Content rows under the mask, numbered again per sample; metadata rows of samples that still have
    content.  A sample is a page, so its window is small."""
    kept = df.where(valid_rows(df) & ((F.col("modality") == "metadata") | F.coalesce(mask, F.lit(False))))
    sample = Window.partitionBy("sample_id")
    counted = kept.withColumn("__content", F.count(F.when(F.col("modality") != "metadata", 1)).over(sample)).where("__content > 0")
    order = sample.orderBy((F.col("modality") == "metadata").cast("int"), "position")
    numbered = counted.withColumn("position", F.when(F.col("modality") == "metadata", F.lit(-1)).otherwise(F.row_number().over(order) - 1))
    return numbered.drop("__content")


def image_to_text_ratio(df: DataFrame, low: float = 0.0, high: float = float("inf")) -> DataFrame:
    """Samples whose images per word are within the limits."""
    sample = Window.partitionBy("sample_id")
    images = F.count(F.when(F.col("modality") == "image", 1)).over(sample)
    n = F.sum(F.when(F.col("modality") == "text", F.size(words(F.coalesce("text_content", F.lit("")))))).over(sample)
    share = images / F.greatest(F.coalesce(n, F.lit(0)), F.lit(1))
    return df.withColumn("__share", share).where(F.col("__share").between(low, high)).drop("__share")


def modality_counts(df: DataFrame) -> DataFrame:
    """Samples and rows per modality."""
    return df.agg(F.countDistinct("sample_id").alias("samples"), *[F.count(F.when(F.col("modality") == m, 1)).alias(m) for m in ("metadata", "text", "image")])


def image_filter(df: DataFrame, score: Callable[[bytes | None], float | None], low: float = float("-inf"), high: float = float("inf")) -> DataFrame:
    """Image rows whose score, by a function of the bytes, is within the limits; without bytes or a score
    they go.  Text rows stay."""

    def run(content: pd.Series) -> pd.Series:
        return pd.Series([None if c is None else score(c) for c in content], dtype="float64")

    run.__annotations__ = {"content": pd.Series, "return": pd.Series}
    s = F.pandas_udf(run, "double")(F.when(F.col("modality") == "image", F.col("binary_content")))
    return keep_content(df.withColumn("__score", s), (F.col("modality") != "image") | F.col("__score").between(low, high)).drop("__score")


def best_text_match(df: DataFrame, similarity: Callable[[Column, Column], Column], image_col: str, text_col: str, least: float = 0.15) -> DataFrame:
    """Image rows whose best text of the sample reaches ``least``; an image without texts goes."""
    texts = df.where("modality = 'text'").select(F.col("sample_id").alias("__s"), F.col(text_col).alias("__t"))
    images = df.where("modality = 'image'").select(F.col("sample_id").alias("__s"), F.col("position").alias("__p"), F.col(image_col).alias("__i"))
    best = images.join(texts, "__s").groupBy("__s", "__p").agg(F.max(similarity(F.col("__i"), F.col("__t"))).alias("__best"))
    joined = df.join(best, (F.col("sample_id") == F.col("__s")) & (F.col("position") == F.col("__p")) & (F.col("modality") == "image"), "left").drop("__s", "__p")
    return keep_content(joined, (F.col("modality") != "image") | (F.col("__best") >= least)).drop("__best")


def locate(df: DataFrame) -> DataFrame:
    """Add ``how`` for image rows: present, range, direct, tar or missing."""
    ref = F.from_json("source_ref", SOURCE_REF)
    how = (
        F.when(F.col("modality") != "image", F.lit("not_image"))
        .when(F.col("binary_content").isNotNull(), F.lit("present"))
        .when(ref["path"].isNull(), F.lit("missing"))
        .when(ref["byte_offset"].isNotNull() & ref["byte_size"].isNotNull(), F.lit("range"))
        .when(ref["member"].isNotNull(), F.lit("tar"))
        .otherwise(F.lit("direct"))
    )
    return df.withColumn("how", how)


def _fetch(ref: dict, opened: dict) -> tuple[bytes | None, str | None]:
    import tarfile

    path = ref["path"]
    try:
        if ref["byte_offset"] is not None and ref["byte_size"] is not None:
            f = opened.get(path) or opened.setdefault(path, open(path, "rb"))
            f.seek(ref["byte_offset"])
            data = f.read(ref["byte_size"])
            return (data, None) if len(data) == ref["byte_size"] else (None, f"short read from {path}")
        if ref["member"]:
            t = opened.get((path, "tar")) or opened.setdefault((path, "tar"), tarfile.open(path))
            return t.extractfile(ref["member"]).read(), None
        f = opened.get(path) or opened.setdefault(path, open(path, "rb"))
        f.seek(0)
        return f.read(), None
    except (OSError, KeyError, tarfile.TarError, AttributeError) as e:
        return None, f"{type(e).__name__}: {e}"


def materialise(df: DataFrame) -> DataFrame:
    """Image rows get their bytes from the source, or an error; each range is read once per task, and
    rows are grouped by path and offset so that a file is read in order."""
    located = locate(df)
    ref = F.from_json("source_ref", SOURCE_REF)
    wanted = located.where("how IN ('range', 'tar', 'direct')").select(ref.alias("r")).distinct().select("r.*")
    wanted = wanted.repartition("path").sortWithinPartitions("path", "byte_offset")

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict = {}
        clean = lambda x: None if pd.isna(x) else x
        try:
            for part in parts:
                got = []
                for r in part.to_dict("records"):
                    r = {k: clean(v) for k, v in r.items()}
                    for k in ("byte_offset", "byte_size"):
                        r[k] = None if r[k] is None else int(r[k])
                    got.append(_fetch(r, opened))
                yield part.assign(bytes_read=[g[0] for g in got], error_read=[g[1] for g in got])
        finally:
            for f in opened.values():
                f.close()

    fetched = wanted.mapInPandas(read, f"{SOURCE_REF}, bytes_read binary, error_read string")
    keyed = located.withColumn("__r", F.when(F.col("how").isin("range", "tar", "direct"), F.to_json(ref)))
    fetched = fetched.select(F.to_json(F.struct("path", "member", "byte_offset", "byte_size", "frame_index")).alias("__r"), "bytes_read", "error_read")
    joined = keyed.join(fetched, "__r", "left")
    done = joined.withColumn("binary_content", F.coalesce("binary_content", "bytes_read"))
    error = F.when(F.col("how") == "missing", F.lit("no source")).otherwise(F.coalesce("error_read", F.col("materialize_error")))
    return done.withColumn("materialize_error", F.when((F.col("modality") == "image") & F.col("binary_content").isNull(), error).otherwise(F.when(F.col("modality") != "image", F.col("materialize_error")))).select(*df.columns)


def apply_error_policy(df: DataFrame, policy: str = "error") -> DataFrame:
    """What becomes of rows with an error: ``error`` raises the first, ``warn`` keeps them, ``drop_row``
    and ``drop_sample`` remove the row or its sample."""
    failed = F.col("materialize_error").isNotNull()
    if policy == "error":
        if first := df.where(failed).select("sample_id", "position", "materialize_error").first():
            raise RuntimeError(f"sample {first[0]} position {first[1]}: {first[2]}")
        return df
    if policy == "warn":
        return df
    if policy == "drop_row":
        return df.where(~failed)
    if policy == "drop_sample":
        return df.join(df.where(failed).select("sample_id").distinct(), "sample_id", "left_anti")
    raise ValueError("policy must be error, warn, drop_row or drop_sample")


def bins_by_bytes(df: DataFrame, group_col: str, bytes_col: str, most: int) -> DataFrame:
    """Add ``bin``: whole groups, in order, packed until a bin would pass ``most`` bytes.  Bins are made
    within ranges of groups, so the running sum never needs one task for all."""
    sizes = df.groupBy(group_col).agg(F.sum(bytes_col).alias("__n"))
    ranged = sizes.repartitionByRange(group_col).sortWithinPartitions(group_col)

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        no, held, base = 0, 0, TaskContext.get().partitionId() << 32
        for part in parts:
            out = []
            for n in part["__n"]:
                if held and held + n > most:
                    no, held = no + 1, 0
                held += n
                out.append(base + no)
            yield part[[group_col]].assign(bin=out)

    kind = df.schema[group_col].dataType.simpleString()
    return df.join(ranged.mapInPandas(pack, f"{group_col} {kind}, bin long"), group_col)
