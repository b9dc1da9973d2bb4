"""Mixing sources to target weights by exact token budgets.

Every row gets a hash-random key. Rows are sorted by ranges of (source, key), so that a source of a third of all rows spreads
over as many ranges as it fills; each range is summed, the sums of earlier ranges are added, and that makes a prefix sum of
sizes within each source. A source's budget is a number of whole epochs and a rest; the prefix sums tell which rows the rest
still takes, and the row at the cut gives its first words only, so that a source gives its budget to the word.

Texts are not shuffled: (id, source, size) is, with what the caller wants to carry.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lens.operators.dedup import nulls_first, rank_in
from commerce_lens.session import cut_lineage

# Weights of the sources in order of their names, repeating; what all share, as a multiple of all sizes; the most of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix"
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    """The words of a text between ASCII white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sums(df: DataFrame, key: str, order: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """df with {name: sum of a column} over the rows of the same key up to each row; NULLs come first, NULL keys are equal.

    Rows are dealt into ranges of (key, order) by sampled bounds and written once with the number of their range. What goes
    before a range is summed from one row per range and key. `order` must tell apart rows that are not interchangeable.
    """
    ranged = df.repartitionByRange(*nulls_first([key, *order])).withColumn("_part", F.spark_partition_id())
    stored = cut_lineage(ranged.withColumn("_key", F.struct(F.col(key).alias("key"))), "ranges")
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy("_part", "_key").agg(*[F.sum(column).alias(f"_{name}") for name, column in values.items()])
    starts = totals.select("_part", "_key", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in values])
    upto = Window.partitionBy("_part", "_key").orderBy(*nulls_first(order)).rowsBetween(Window.unboundedPreceding, 0)
    summed = stored.join(starts, ["_part", "_key"])
    for name, column in values.items():
        summed = summed.withColumn(name, F.col(f"_{name}") + F.sum(column).over(upto))
    return summed.drop("_part", "_key", *[f"_{n}" for n in values])


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    The sources in order of their names, null last, weigh `weights` in turn and share `share` times all sizes. A target stops at
    `most` times its source's size, and what it leaves goes to the others by weight until none is above. That is one
    level for all: target = min(most * size, level * weight), and the level is the highest that any number of stopped
    sources, taken in order of size by weight, leaves to the rest. Only that level and the total are known to the driver.
    """
    if most < share:
        raise ValueError("the sources can't give that much")
    named = sizes.select("source", "source_size", F.col("source").isNull().alias("none"), F.lit(0).alias("all"))
    placed = rank_in(named, {"place": ("all", ["none", "source"])})
    turn = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int") + 1)
    limits = placed.withColumn("weight", turn).withColumn("limit", F.col("source_size") * most)
    limits = limits.withColumn("ratio", F.col("limit") / F.col("weight"))
    summed = cut_lineage(running_sums(limits, "all", ["ratio", "place"], {"limits": "limit", "weights": "weight"}), "limits")
    whole = summed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    left = F.lit(share * (whole["size"] or 0)) - (F.col("limits") - F.col("limit"))
    level = summed.agg(F.max(left / (F.lit(whole["weight"] or 0) - (F.col("weights") - F.col("weight")))).alias("level")).first()["level"]
    target = F.least(F.col("limit").cast("double"), F.lit(level).cast("double") * F.col("weight"))
    return summed.select("source", "source_size", target.alias("target"))


def mix(
    rows: DataFrame,
    carry: Sequence[str] = (),
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """(id, source, carried columns, size, source_size, target, taken) for every row of (id, source, size).

    taken counts words, repeats included: all words once per whole epoch, and once more for the rows that come first by the hash
    of seed and id, up to the source's budget, rounded down to whole words. Rows of one id follow each other by
    size; copies of one id and size are interchangeable, and the cut falls on one of them. Null ids hash alike, a null source is
    a source, a null size is none. Sources without words and empty tables take nothing. The same rows give the same mix.
    """
    own = rows.select(
        "id",
        "source",
        *carry,
        F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary")).alias("_hash"),
        F.monotonically_increasing_id().alias("_no"),
    )
    # Written first: dealing into ranges reads its rows twice, and their sizes are dear.
    own = cut_lineage(own, "sized")
    placed = cut_lineage(running_sums(own, "source", ["_hash", "id", "size", "_no"], {"_upto": "size"}), "placed")
    sizes = cut_lineage(placed.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    wanted = targets(sizes, weights, share, most).withColumnRenamed("source", "_source")
    both = placed.join(wanted, F.col("source").eqNullSafe(F.col("_source")))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size") - (F.col("_upto") - F.col("size"))
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    return both.select("id", "source", *carry, "size", "source_size", "target", taken.alias("taken"))
