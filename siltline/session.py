"""Session defaults and staging of intermediate tables."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "siltline", cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the operators are written for.  On a cluster the session
    is the caller's; nothing here overrides one that exists."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    import tempfile
    import zipfile
    from pathlib import Path

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="siltline-code-")) / "siltline_code.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where there are fewer partitions than cores, as with one small file; what has
    enough partitions, which is everything large, stays as it is and is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_written: list[tuple[SparkSession, str]] = []
_tables: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.  Only where that is unset and all work is
    done in this process, as in local tests, a temporary folder of this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        import tempfile

        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("a cluster needs a folder that all its executors share in spark.checkpoint.dir")

        folder = tempfile.mkdtemp(prefix="siltline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new, empty folder in the shared folder, made by the file system it is on; a local one is given as
    a plain path."""
    path = f"{shared_dir(spark)}/siltline-{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    remove_at_exit(spark, path)
    return path.removeprefix("file://")


def staged(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, later readers take
    only the columns they need, and lost executors cost nothing that was written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/siltline-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """A staged table in buckets by a column: joins and groupings on it with the same number of
    partitions read it where it lies.  Rows that are partitioned by the column into as many parts already
    give one file a bucket; others should be repartitioned so first."""
    spark = df.sparkSession
    name = f"siltline_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/siltline-{name}"
    df.write.format("parquet").bucketBy(buckets, column).option("path", path).option("compression", "zstd").saveAsTable(name)
    remove_at_exit(spark, path)
    _tables.append((spark, name))
    return spark.table(name)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A table for a join: marked for broadcast if it has at most ``rows`` rows, else as it is, to be
    shuffled.  Meant for staged tables; any other is computed twice."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def remove_at_exit(spark: SparkSession, path: str) -> None:
    if not _written:
        atexit.register(_remove)
    _written.append((spark, path))


def unstage(df: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    for path in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        if "/siltline-" in path:
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _remove() -> None:
    for spark, name in _tables:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # the session has ended, and its catalog with it
            break
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session has ended; the folder is the cluster's to clear
            return
