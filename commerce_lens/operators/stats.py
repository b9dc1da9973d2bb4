"""Summary statistics, histograms and box statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lens.operators.quantiles import counted, in_columns, weighted_quantiles
from commerce_lens.operators.reshape import melt
from commerce_lens.operators.select import keep_top
from commerce_lens.session import cut_lineage

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC or dtype.startswith("decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if is_numeric(t)]


def nan_as_null(df: DataFrame) -> DataFrame:
    """Not-a-number counts as missing."""
    floats = [c for c, t in df.dtypes if t in ("float", "double")]
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in floats}) if floats else df


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) for every non-NULL value of the columns, as DOUBLE."""
    wide = nan_as_null(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    return melt(wide, [], columns, "column", "value").where(F.col("value").isNotNull())


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of each numeric column.

    df is read once: everything is taken from how often each value stands in each column.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    counts = cut_lineage(counted(long_values(df, columns), ["column"], "value"), "values")
    plain = counts.groupBy("column").agg(
        F.sum("w").alias("count"),
        (F.sum(F.col("value") * F.col("w")) / F.sum("w")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    away = F.col("value") - F.col("mean")
    # All further sides have one row per column.
    spread = counts.join(F.broadcast(plain.select("column", "mean")), "column").groupBy("column").agg(
        F.try_divide(F.sum(away * away * F.col("w")), F.sum("w") - 1).alias("variance")
    )
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    quartiles = in_columns(weighted_quantiles(counts, ["column"], list(probs.values())), ["column"], probs)
    frame = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    out = frame
    for part in (plain, spread, quartiles):
        out = out.join(F.broadcast(part), "column", "left")
    return out.select(
        "column", F.coalesce("count", F.lit(0)).alias("count"), "mean", F.sqrt("variance").alias("std"), "min", "q25", "q50", "q75", "max"
    )


def histogram(df: DataFrame, columns: str | Sequence[str], bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max of each column, the last one closed.

    (column, bin, bin_start, bin_end, count), empty bins included. A column with a single
    value gets bins from half below to half above it.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    values = long_values(df, columns)
    span = values.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    span = span.select(
        "column",
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    ).withColumn("_step", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("_hi")).otherwise(F.col("_lo") + i * F.col("_step"))

    # The span has one row per column.
    placed = values.join(F.broadcast(span), "column").withColumn(
        "_guess",
        F.least(F.floor((F.col("value") - F.col("_lo")) / F.col("_step")), F.lit(bins - 1)),
    )
    # The division may round across an edge; the edges themselves decide.
    bin_ = (
        F.when(F.col("value") < edge(F.col("_guess")), F.col("_guess") - 1)
        .when((F.col("_guess") < bins - 1) & (F.col("value") >= edge(F.col("_guess") + 1)), F.col("_guess") + 1)
        .otherwise(F.col("_guess"))
    )
    counts = placed.select("column", bin_.cast("int").alias("bin")).groupBy("column", "bin").agg(
        F.count(F.lit(1)).alias("count")
    )
    frame = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        edge(F.col("bin")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def _with_fences(df: DataFrame, group: str, value: str, top: int) -> tuple[DataFrame, DataFrame]:
    """Counted values of the most frequent groups, and the box and fences of each."""
    counts = cut_lineage(counted(keep_top(df, group, top), [group], value), "values")
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    box = in_columns(weighted_quantiles(counts, [group], list(probs.values())), [group], probs)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return counts, box.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})


def box_stats(df: DataFrame, group: str, value: str, top: int = 10) -> DataFrame:
    """Quartiles, whiskers and outlier count for the most frequent groups.

    A whisker ends at the furthest value within 1.5 interquartile ranges of the box.
    """
    counts, fences = _with_fences(df, group, value, top)
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    # The fences have one row per kept group.
    return (
        counts.join(F.broadcast(fences), group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.sum("w").alias("count"),
            F.least(F.col("q1"), F.coalesce(F.min(F.when(inside, F.col("value"))), F.col("q1"))).alias("whisker_low"),
            F.greatest(F.col("q3"), F.coalesce(F.max(F.when(inside, F.col("value"))), F.col("q3"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("w"))).alias("outliers"),
        )
    )


def box_outliers(df: DataFrame, group: str, value: str, top: int = 10) -> DataFrame:
    """Values beyond the whiskers with their frequency."""
    counts, fences = _with_fences(df, group, value, top)
    beyond = ~F.col("value").between(F.col("_low"), F.col("_high"))
    return counts.join(F.broadcast(fences), group).where(beyond).select(group, "value", F.col("w").alias("count"))
