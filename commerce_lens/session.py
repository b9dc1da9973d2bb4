"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. All are settable on a live session, so a
# session handed in by a cluster keeps its own sizing (shuffle partitions, memory).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where that costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stored tables and copies hold much text.
    "spark.sql.parquet.compression.codec": "zstd",
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "commerce-lens") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read and write: spark.checkpoint.dir, else the warehouse, which is shared as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """Where this application keeps its intermediate files."""
    return f"{shared_folder(spark)}/scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate files."""
    return f"{scratch_root(spark)}/{label}_{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate files of this application, once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to path has ended well."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete copies that nothing reads any more."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Jobs begun within delete their shuffle files as they end; else these stay until the driver happens to collect its garbage.

    A result that is asked for again makes its shuffles anew, so this is for jobs that write what they make.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame, label: str = "cut", paths: list[str] | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back; the path is added to `paths`, for discard().

    Lost executors then re-read files instead of repeating the work above the cut, which
    matters where that work is a paid model call or feeds several consumers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)
