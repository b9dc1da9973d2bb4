"""Grouped scores, distinct and pair counts, trends, pivots and melts.

NULL keys are dropped here, as a data frame group-by drops them; the marts keep them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from commerce_lens.functions.json_text import ASPECTS
from commerce_lens.operators.select import top_values

SCORE_COLUMNS = tuple(f"{a}_score" for a in ASPECTS)
CATEGORY, CITY = "product_category_name_en", "city"


def group_by(df: DataFrame, keys: dict[str, Column], aggs: dict[str, Column]) -> DataFrame:
    """Group by named expressions; a NULL key forms one group."""
    return df.groupBy(*[e.alias(n) for n, e in keys.items()]).agg(*[a.alias(n) for n, a in aggs.items()])


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Per key, exactly how many different values each column has: {result name: column}. A NULL key forms one group, NULL values count as none.

    Whole numbers are bits of 64-bit words, (value >> 6, value & 63), which tasks merge before the shuffle: of dense ids it moves a word for
    64, of scattered ones as many rows as there are values. Other types are grouped as they are. Each column is a
    narrow read of its own in place of a copy of every row, so df should come from a stored table.
    """

    def counted(place: int, column: str) -> DataFrame:
        slim = df.select(*keys, F.col(column).alias("_value"))
        if isinstance(df.schema[column].dataType, IntegralType):
            value = F.col("_value").cast("long")
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63)).cast("int"))
            words = slim.groupBy(*keys, F.shiftright(value, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
            n = F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0))
        else:
            words, n = slim.groupBy(*keys, "_value").agg(F.lit(1)), F.count("_value")
        return words.groupBy(*keys).agg(n.cast("long").alias("_n")).select(*keys, F.lit(place).alias("_place"), "_n")

    parts = reduce(DataFrame.unionByName, [counted(i, c) for i, c in enumerate(columns.values())])
    return parts.groupBy(*keys).agg(*[F.max(F.when(F.col("_place") == i, F.col("_n"))).alias(name) for i, name in enumerate(columns)])


def score_by(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Per key: how many scores there are and their mean."""
    return (
        df.na.drop(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(score).alias("reviews_count"), F.avg(score).alias("avg_score"))
    )


def pair_frequency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Number of rows per pair of values."""
    return df.na.drop(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def aspect_trend(geo: DataFrame, month: str = "review_month_date") -> DataFrame:
    """Mean of each aspect score per month."""
    return geo.na.drop(subset=[month]).groupBy(month).agg(*[F.avg(c).alias(c) for c in SCORE_COLUMNS])


def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Row counts with one column per listed value; a missing cell is NULL."""
    pairs = pair_frequency(df, row, col)
    return pairs.groupBy(row).pivot(col, list(values)).agg(F.sum("count"))


def ranked_top(df: DataFrame, col: str, n: int, rank: str) -> DataFrame:
    """top_values with the place of each value. The window runs over n rows."""
    order = Window.orderBy(F.desc("count"), F.asc(col))
    return top_values(df, col, n).select(col, F.row_number().over(order).alias(rank))


def category_city_cells(
    df: DataFrame,
    score: str,
    top_cities: int = 10,
    min_reviews: int | None = None,
    top_categories: int | None = None,
) -> DataFrame:
    """Mean score per category and city for the most frequent cities, one row per cell.

    With min_reviews a cell needs strictly more scores than that, or its mean is NULL. With
    top_categories only the most frequent categories stay. Ranks give the order of columns
    and rows; the joined rank tables have at most top_cities and top_categories rows.
    """
    cells = score_by(df, [CATEGORY, CITY], score)
    if min_reviews is not None:
        cells = cells.withColumn("avg_score", F.when(F.col("reviews_count") > min_reviews, F.col("avg_score")))
    cells = cells.join(F.broadcast(ranked_top(df, CITY, top_cities, "city_rank")), CITY)
    if top_categories is not None:
        cells = cells.join(F.broadcast(ranked_top(df, CATEGORY, top_categories, "category_rank")), CATEGORY)
    return cells


def category_city_matrix(
    df: DataFrame,
    score: str,
    top_cities: int = 10,
    min_reviews: int | None = None,
    top_categories: int | None = None,
) -> DataFrame:
    """The same cells as a matrix: one row per category, one column per frequent city.

    Reads the list of city names (top_cities values) to name the columns. Every category
    keeps its row, also one with no score in any listed city.
    """
    cities = [r[0] for r in top_values(df, CITY, top_cities).collect()]
    cells = score_by(df, [CATEGORY, CITY], score)
    if min_reviews is not None:
        cells = cells.withColumn("avg_score", F.when(F.col("reviews_count") > min_reviews, F.col("avg_score")))
    matrix = cells.groupBy(CATEGORY).pivot(CITY, cities).agg(F.first("avg_score"))
    if top_categories is None:
        return matrix.orderBy(CATEGORY)
    rows = F.broadcast(ranked_top(df, CATEGORY, top_categories, "_rank"))
    return matrix.join(rows, CATEGORY).orderBy("_rank").drop("_rank")


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(columns), name, value)
