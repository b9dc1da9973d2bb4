"""Exact quantiles without collecting a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_lens.session import cut_lineage


def counted(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, value, w): how often each number stands in each group; NULL and not-a-number are left out."""
    v = df.select(*groups, F.col(value).cast("double").alias("value")).where("value IS NOT NULL AND NOT isnan(value)")
    return v.groupBy(*groups, "value").agg(F.count(F.lit(1)).alias("w"))


def weighted_quantiles(counts: DataFrame, groups: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles per group of counted() values, as (groups, prob, quantile).

    The counts are dealt into ranges of (group, value) by sampled bounds and written once with the number
    of their range, since the bounds of a second sample could differ. Running totals over the ranges of a group tell
    the one or two that hold the wanted ranks, and only these are put in order. No task holds more than a
    range, however many rows, values or groups there are; one method serves every size.
    """
    groups, probs = list(groups), sorted(set(probs))
    ranged = counts.repartitionByRange(*groups, "value").withColumn("part", F.spark_partition_id())
    stored = cut_lineage(ranged.select(F.struct(*groups).alias("g"), "value", "w", "part"), "counts")
    sizes = stored.groupBy("g", "part").agg(F.sum("w").alias("rows"))
    of_group = Window.partitionBy("g")
    upto = F.sum("rows").over(of_group.orderBy("part"))
    sizes = sizes.select("g", "part", "rows", upto.alias("upto"), F.sum("rows").over(of_group).alias("n"))
    places = F.array(*[F.struct(F.lit(p).alias("prob"), (p * (F.col("n") - 1)).alias("pos")) for p in probs])
    wanted = (
        sizes.select("g", "part", "n", "upto", (F.col("upto") - F.col("rows")).alias("before"), F.inline(places))
        # The values at the two ranks around the position, counted from 0.
        .where("upto > floor(pos) AND before <= floor(pos) + 1")
        .drop("upto")
    )
    within = Window.partitionBy("g", "part", "prob").orderBy("value")
    placed = stored.join(wanted, ["g", "part"]).withColumn("upto", F.col("before") + F.sum("w").over(within))
    picked = placed.groupBy("g", "prob", "pos").agg(
        F.min(F.when(F.expr("upto > floor(pos)"), F.col("value"))).alias("a"),
        F.min(F.when(F.expr("upto > floor(pos) + 1"), F.col("value"))).alias("b"),
    )
    return picked.select("g.*", "prob", F.expr("a + (coalesce(b, a) - a) * (pos - floor(pos)) AS quantile"))


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """weighted_quantiles of a column of df, which is read once."""
    return weighted_quantiles(counted(df, groups, value), groups, probs)


def in_columns(quantiles: DataFrame, groups: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """One row per group with one named column per quantile."""
    picks = [F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(n) for n, p in probs.items()]
    return quantiles.groupBy(*groups).agg(*picks)


def quantile_columns(df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """exact_quantiles with one named column per quantile."""
    return in_columns(exact_quantiles(df, groups, value, list(probs.values())), groups, probs)

