"""Filters, sorts and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def pending(df: DataFrame, present: str, missing: str) -> DataFrame:
    """Rows with one column filled and another still empty."""
    return df.where(F.col(present).isNotNull() & F.col(missing).isNull())


def negative(df: DataFrame, score: str) -> DataFrame:
    return df.where(F.col(score) < 0)


def dropna_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(how="any", subset=list(columns))


def sort_by(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Ascending, NULLs first."""
    return df.orderBy(*[F.col(k).asc_nulls_first() if isinstance(k, str) else k for k in keys])


def sorted_layout(df: DataFrame, *keys: str) -> DataFrame:
    """Range-partitioned and sorted files, so that a reader can skip on the keys."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def head_n(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return sort_by(df, key).limit(n)


def limit_batch(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """At most n rows, the lowest by key, NULLs first; None takes every row.

    The keys are dealt into ranges by sampled bounds and counted. Ranges are taken whole until the
    one in which the n-th row lies, and only that range is put in order. The bounds decide what it
    costs, not what comes out; no task holds more than a range, whatever n is. The counts, one row per range,
    reach the driver. df is read twice and should come from a stored table.
    """
    if n is None:
        return df
    ranged = df.select(F.col(key).alias("key")).repartitionByRange(F.col("key").asc_nulls_first())
    sizes = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.max("key").alias("top"), F.count(F.lit(1)).alias("rows"))
    before, low, whole, last = 0, None, F.lit(False), F.lit(True)
    for size in sizes.orderBy("part").collect():
        if before + size["rows"] > n:
            break
        before, low = before + size["rows"], size["top"]
        # A range of NULLs alone has no top.
        whole = F.col(key).isNull() if low is None else F.col(key).isNull() | (F.col(key) <= F.lit(low))
        last = F.col(key).isNotNull() if low is None else F.col(key) > F.lit(low)
    else:
        return df
    high = size["top"]
    rest = df.where(last if high is None else last & (F.col(key).isNull() | (F.col(key) <= F.lit(high))))
    return df.where(whole).unionByName(rest.orderBy(F.col(key).asc_nulls_first()).limit(n - before))


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """The n most frequent non-NULL values with their counts; ties go to the lower value."""
    counts = df.na.drop(subset=[col]).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(col)).limit(n)


def keep_top(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Rows whose value is among the n most frequent. The kept list has n rows at most."""
    top = top_values(df, col, n).select(F.col(col).alias("_top"))
    return df.join(F.broadcast(top), F.col(col) == F.col("_top"), "left_semi")


def drill_down(
    geo: DataFrame, category: str, city: str, columns: Sequence[str], key: str = "review_id", n: int = 20
) -> DataFrame:
    """First n rows of one category in one city."""
    rows = geo.where((F.col("product_category_name_en") == category) & (F.col("city") == city))
    return rows.select(*columns).orderBy(F.col(key).asc_nulls_first(), *columns).limit(n)
