"""Joins that need more than equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, keys: DataFrame, key: str, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Rows whose key is in ``keys``.  The distinct keys are broadcast if they are few, else shuffled."""
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if wanted.limit(broadcast_rows + 1).count() <= broadcast_rows:
        wanted = F.broadcast(wanted)
    return df.join(wanted, key, "left_semi")


def index_lookup(index: DataFrame, urls: DataFrame, key: str = "url", crawls: list[str] | None = None, subset: str | None = "warc") -> DataFrame:
    """Index rows of the urls; crawl and subset are partition columns, so other directories are not read."""
    if crawls:
        index = index.where(F.col("crawl").isin(*crawls))
    if subset and "subset" in index.columns:
        index = index.where(F.col("subset") == subset)
    return lookup(index, urls, key)


def interval_overlaps(left: DataFrame, right: DataFrame, key: str, left_span: tuple[str, str], right_span: tuple[str, str], bin_width: float) -> DataFrame:
    """Pairs of rows of one key whose half-open intervals overlap.

    Each interval is placed in the bins of ``bin_width`` it touches, the join is on key and bin, so a key
    with many rows is spread over its bins, and a pair counts in the first bin both touch."""
    a0, a1, b0, b1 = *left_span, *right_span
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / bin_width), F.floor(F.col(e) / bin_width)))
    x = left.where(F.col(a1) > F.col(a0)).withColumn("__bin", bins(a0, a1))
    y = right.where(F.col(b1) > F.col(b0)).withColumn("__bin", bins(b0, b1))
    first = F.greatest(F.floor(F.col(a0) / bin_width), F.floor(F.col(b0) / bin_width))
    return x.join(y, [key, "__bin"]).where((F.col(a0) < F.col(b1)) & (F.col(b0) < F.col(a1)) & (F.col("__bin") == first)).drop("__bin")


def map_timestamps(segments: DataFrame, mapping: DataFrame, key: str, bin_width: float = 60_000) -> DataFrame:
    """Times of segments of a concatenation back in the original: columns start_ms and end_ms of the
    segments, concat_start_ms, concat_end_ms and original_start_ms of the mapping.  Segments that touch
    none or several parts go."""
    numbered = segments.withColumn("__seg", F.monotonically_increasing_id())
    pairs = interval_overlaps(numbered, mapping, key, ("start_ms", "end_ms"), ("concat_start_ms", "concat_end_ms"), bin_width)
    one = pairs.groupBy("__seg").agg(F.count("*").alias("__n")).where("__n = 1").select("__seg")
    single = pairs.join(one, "__seg", "left_semi")
    start = F.greatest("start_ms", "concat_start_ms") - F.col("concat_start_ms") + F.col("original_start_ms")
    end = F.least("end_ms", "concat_end_ms") - F.col("concat_start_ms") + F.col("original_start_ms")
    return single.withColumns({"start_ms": start, "end_ms": end}).drop("__seg", "concat_start_ms", "concat_end_ms", "original_start_ms")


def nearest_indices(times: Column, grid: Column) -> Column:
    """For each element of the grid the 0-based position of the nearest time; ties go left, everything
    from the last time on to the last.  Both arrays are sorted."""
    n = F.size(times)

    def near(g: Column) -> Column:
        before = F.size(F.filter(times, lambda t: t < g))
        right = F.least(F.greatest(before, F.lit(1)), n - 1)
        left = right - 1
        closer = F.abs(g - F.get(times, right)) < F.abs(g - F.get(times, left))
        return F.when(g >= F.element_at(times, -1), n - 1).when(n == 1, F.lit(0)).when(closer, right).otherwise(left)

    return F.transform(grid, near)


def sample_nearest(times: Column, rate: float, endpoint: bool = True, dedup: bool = True) -> Column:
    """Positions of the times nearest to a regular grid of ``rate`` per unit, with how often each is hit."""
    if rate <= 0:
        raise ValueError("rate must be positive")
    step = 1.0 / rate
    first, last = times[0].cast("double"), F.element_at(times, -1).cast("double")
    steps = F.ceil((last - first + (step * 0.5 if endpoint else 0.0)) / step).cast("int") - 1
    grid = F.transform(F.sequence(F.lit(0), F.greatest(steps, F.lit(0))), lambda i: first + i * step)
    at = nearest_indices(times, grid)
    ids = F.array_distinct(at) if dedup else at
    made = F.transform(ids, lambda i: F.struct(i.alias("index"), (F.size(F.filter(at, lambda j: j == i)) if dedup else F.lit(1)).alias("hits")))
    return F.when(F.size(times) > 0, made)


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str) -> DataFrame:
    """Each left row with the last right row of its key at or before its time: one sort over the union
    instead of a range join.  Right columns but key and time get their last values."""
    from pyspark.sql.window import Window

    values = [c for c in right.columns if c not in (key, right_time)]
    blank = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in values]
    a = left.select(F.col(key).alias("__k"), F.col(left_time).alias("__t"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"), F.lit(None).cast(right.schema[right_time].dataType).alias("__rt"), *blank)
    b = right.select(F.col(key).alias("__k"), F.col(right_time).alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(a.schema["__row"].dataType).alias("__row"), F.col(right_time).alias("__rt"), *values)
    w = Window.partitionBy("__k").orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("__side") == 0, F.struct("__rt", *values)), ignorenulls=True).over(w)
    out = a.unionByName(b).withColumn("__last", last).where("__side = 1")
    return out.select("__row.*", F.col("__last.__rt").alias(f"matched_{right_time}"), *[F.col(f"__last.{c}").alias(c) for c in values])
