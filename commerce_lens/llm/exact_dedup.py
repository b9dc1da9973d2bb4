"""Exact deduplication behind a two-pass Bloom filter, in DataFrame functions only.

Pass 1 sets, for every row, three bits in one block of a blocked Bloom filter and keeps the bits that
at least two rows set. Pass 2 looks each row up in that filter (a broadcast of fixed greatest
size). A row whose bits are not all set has no equal and passes straight through; only the
others are shuffled, by the digest of their text, and decided exactly. The filter's error costs
shuffled rows, never a wrong result.

Groups are counted before any join, so a text that holds a third of all rows is pre-aggregated
per task, and the join back has one row per text on its other side, which adaptive execution
can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lens.session import cut_lineage

# Bits of one filter block, and bits set by each row.
BLOCK_BITS = 4096
BITS_PER_KEY = 3
# Bits per row, and the most bits of the filter: 2^28 bits are 32 MB to broadcast. Beyond that the
# filter only gets denser.
BITS_PER_ROW = 16
MAX_BITS = 1 << 28


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def digest_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, sha, no): the row as a struct, its id, the digest of its text, its number."""
    return df.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        F.sha2(normalised(F.col(text_col)), 256).alias("sha"),
        F.monotonically_increasing_id().alias("no"),
    )


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("sha"), F.lit(blocks)).alias("block")


def _positions() -> list[Column]:
    """Where a row's bits are within its block."""
    return [F.pmod(F.xxhash64("sha", F.lit(i)), F.lit(BLOCK_BITS)) for i in range(1, BITS_PER_KEY + 1)]


def repeat_filter(hashed: DataFrame, blocks: int) -> DataFrame:
    """(block, words): per block, 64 words with the bits that two rows or more set."""
    bits = hashed.select(_block(blocks), F.explode(F.array(*_positions())).alias("bit"))
    twice = bits.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    words = twice.groupBy("block", F.expr("bit div 64").alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("word")
    )
    # At most 64 words a block.
    packed = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("slot", "word"))).alias("m"))
    return packed.select("block", F.expr("transform(sequence(0L, 63L), i -> coalesce(try_element_at(m, i), 0L))").alias("words"))


def mark_copies(hashed: DataFrame, rows: int) -> DataFrame:
    """(row, sha, keep_id, group_size, kept) for every row of digest_rows().

    `rows` is the row count, which sizes the filter. `hashed` must give the same `no` each time
    it is read: let it come from a stored table.
    """
    bits = min(MAX_BITS, max(BLOCK_BITS, rows * BITS_PER_ROW))
    blocks = -(-bits // BLOCK_BITS)
    known = F.broadcast(cut_lineage(repeat_filter(hashed, blocks), "filter"))
    looked = hashed.withColumn("block", _block(blocks)).join(known, "block", "left")
    hit = F.lit(True)
    for p in _positions():
        word = F.element_at("words", (F.floor(p / 64) + 1).cast("int"))
        hit = hit & (F.call_function("getbit", word, (p % 64).cast("int")) == 1)
    looked = looked.withColumn("hit", F.coalesce(hit, F.lit(False))).drop("block", "words")
    alone = looked.where(~F.col("hit")).select(
        "row", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    maybe = looked.where("hit").drop("hit")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "no")
    groups = maybe.groupBy("sha").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size"))
    # Written, so that the join has a plain shuffle on either side and can split the rows of a hot text.
    decided = maybe.join(cut_lineage(groups, "texts"), "sha").select(
        "row", "sha", F.col("first.id").alias("keep_id"), "group_size", (F.col("no") == F.col("first.no")).alias("kept")
    )
    return alone.unionByName(decided)


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df that stay, with df's columns.

    Texts are equal when identical after normalised(); a null text counts as empty, and all
    empty texts are equal. Of equal texts the smallest id stays, a null id last; rows that
    tie in text and id leave exactly one. Other columns, whatever their names, don't matter.
    An empty table gives an empty table.
    """
    marked = mark_copies(digest_rows(df, id_col, text_col), df.count())
    return marked.where("kept").select("row.*")
