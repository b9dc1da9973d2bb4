"""Ranking and deduplication.

A first-row-per-key filter on ROW_NUMBER keeps at most one row per key and map task before
its shuffle, so a key that holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lens.session import cut_lineage

REVIEW_ORDER = ("review_creation_date", "review_answer_timestamp")


def nulls_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order. NULL keys form one group."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_per_key(df: DataFrame, key: str | Sequence[str], seq: Column | str) -> DataFrame:
    """The row with the highest seq of each key: a later result replaces an earlier one."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return first_per_key(df, key, [seq.desc_nulls_last()])


def _range_starts(stored: DataFrame) -> DataFrame:
    """(_part, _first, _start): the first key of every range, and how many of its rows are in earlier ranges.

    One row per range. Only the last key of a range can go on in the next, so the counts of the
    ranges' last keys are all that is needed.
    """
    ends = stored.groupBy("_part").agg(F.min("_key").alias("_first"), F.max("_key").alias("_last"))
    tails = stored.join(F.broadcast(ends), "_part").where("_key = _last").groupBy("_part", "_last").agg(F.count(F.lit(1)).alias("_rows"))
    asked = ends.select(F.col("_first").alias("_key"), "_part", F.lit(0).cast("long").alias("_rows"), F.lit(0).alias("_turn"))
    given = tails.select(F.col("_last").alias("_key"), "_part", "_rows", F.lit(1).alias("_turn"))
    earlier = Window.partitionBy("_key").orderBy("_part", "_turn")
    summed = asked.unionByName(given).withColumn("_start", F.sum("_rows").over(earlier))
    return summed.where("_turn = 0").select("_part", F.col("_key").alias("_first"), "_start")


def rank_in(df: DataFrame, ranks: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """ROW_NUMBER of every row within a key, ascending, NULLs first: {name: (key, order)}.

    Rows are dealt into ranges of (key, order) by sampled bounds and written once with the number of their
    range. A row's rank is its place within key and range, plus, for the first key of a range, the rows of
    that key in the ranges before. A hot key thus spreads over as many ranges as it fills.

    A key is one struct column, in which NULLs are equal.
    """
    out = df
    for name, (key, order) in ranks.items():
        ranged = out.repartitionByRange(*nulls_first([key, *order])).withColumn("_part", F.spark_partition_id())
        stored = cut_lineage(ranged.withColumn("_key", F.struct(F.col(key).alias("key"))), "ranges")
        place = F.row_number().over(Window.partitionBy("_part", "_key").orderBy(*nulls_first(order)))
        # One row per range.
        joined = stored.join(F.broadcast(_range_starts(stored)), "_part")
        start = F.when(F.col("_key") == F.col("_first"), F.col("_start")).otherwise(0)
        out = joined.withColumn(name, start + place).drop("_part", "_key", "_first", "_start")
    return out


def dedup_reviews(df: DataFrame) -> DataFrame:
    """Keep rows that come first for their review id and also first for their order id.

    The two ranks are independent: a row that loses to another row of its review id stays
    out even where that other row falls to its own order rank. Rows are ordered by creation
    date, then answer time, then the other id, then the remaining columns, so the outcome
    does not depend on row order in the source.
    """
    rest = [c for c in df.columns if c not in ("review_id", "order_id", *REVIEW_ORDER)]
    ids = df.select("review_id", "order_id", *REVIEW_ORDER)
    # The row that wins its order is needed as an id pair only. A row and the winner of its
    # order with the same two ids precede each other in (creation, answer), so they agree.
    by_order = first_per_key(ids, "order_id", [*REVIEW_ORDER, "review_id"])
    by_order = by_order.select(F.col("review_id").alias("_review"), F.col("order_id").alias("_order"))
    same_ids = F.col("review_id").eqNullSafe(F.col("_review")) & F.col("order_id").eqNullSafe(F.col("_order"))
    if not any(df.schema[c].dataType.typeName() in ("string", "binary") for c in rest):
        return first_per_key(df, "review_id", [*REVIEW_ORDER, "order_id", *rest]).join(by_order, same_ids, "left_semi")
    # The rest doesn't change which order wins a review, so texts are shuffled once, by review, and meet one row per
    # review. In a struct, NULL ids are equal.
    winners = first_per_key(ids, "review_id", [*REVIEW_ORDER, "order_id"]).join(by_order, same_ids, "left_semi")
    by_review = first_per_key(df.withColumn("_key", F.struct("review_id")), "_key", [*REVIEW_ORDER, "order_id", *rest])
    return by_review.join(winners.select(F.struct("review_id").alias("_key")), "_key", "left_semi").drop("_key")
