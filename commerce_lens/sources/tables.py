"""Versioned Parquet tables under root/layer/name."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

VERSION_GLOB = "v_*"


def _versions(spark: SparkSession, root: str, layer: str, name: str) -> list[str]:
    """Complete versions, oldest first. A version counts once its commit marker exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{root}/{layer}/{name}/{VERSION_GLOB}/_SUCCESS")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    return sorted(str(s.getPath().getParent().toString()) for s in found)


def table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """The newest complete version of a table."""
    versions = _versions(spark, root, layer, name)
    if not versions:
        raise FileNotFoundError(f"no table {layer}.{name} under {root}")
    return spark.read.parquet(versions[-1])


def replace_table(df: DataFrame, root: str, layer: str, name: str) -> DataFrame:
    """Replace a table by df and return the stored table.

    Each write makes a new version folder, so df may read the table it replaces, readers
    of the old version are not disturbed, and a failed write publishes nothing.
    """
    version = f"v_{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    path = f"{root}/{layer}/{name}/{version}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def expire_versions(spark: SparkSession, root: str, layer: str, name: str, keep: int = 2) -> int:
    """Delete all but the newest `keep` versions; returns how many were deleted."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    old = _versions(spark, root, layer, name)[:-keep]
    hadoop = spark._jvm.org.apache.hadoop.fs
    for version in old:
        path = hadoop.Path(version)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(old)
