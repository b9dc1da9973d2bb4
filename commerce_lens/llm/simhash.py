"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets one of the seven nonzero vectors of three bits, and each of the seven tables
keeps the positions whose vector has an odd product with the table's own. Two differing
positions span at most a plane, so some table ignores both: every pair of fingerprints within the
radius of two shares a bucket in some table, without chance.

Only distinct fingerprints enter the tables. Buckets of up to BUCKET members are compared
inside an array and give true links only. The members of larger buckets are linked by their one-bit
neighbours instead: two fingerprints at two bits or fewer share a neighbour at one bit, and
at most 65 fingerprints have the same neighbour, so no group grows with the data.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from commerce_lens.llm.components import components
from commerce_lens.session import cut_lineage

RADIUS = 2
BITS = 64
WORDS = 3
SEED = 42
BUCKET = 32
# Words handled at once, so that one very long text needs no list of all its words.
BLOCK_WORDS = 1 << 16


def _fingerprint(text: str | None, n: int = WORDS) -> int:
    rest, tail, total = (text or "").encode().lower(), [], 0
    ones = np.zeros(BITS, dtype=np.int64)
    while rest:
        words = rest.split(None, BLOCK_WORDS)
        rest = words.pop() if len(words) > BLOCK_WORDS else b""
        words = tail + words
        if rest or len(words) >= n:
            runs = map(b" ".join, zip(*(words[i:] for i in range(n))))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), dtype="<u8")
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(hashes)
        elif words and not total:
            one = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype="<u8")
            return int(one.view("<i8")[0])
        tail = words[len(words) - n + 1 :]
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0]) if total else 0


@F.pandas_udf(LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    """The 64-bit fingerprint as a signed long; null and blank texts give 0."""
    return pd.Series([_fingerprint(t) for t in texts], dtype="int64")


def masks() -> list[int]:
    """The bits that each of the seven tables keeps, as signed longs."""
    out = []
    for v in range(1, 2 ** (RADIUS + 1)):
        bits = sum(1 << i for i in range(BITS) if ((i % 7 + 1) & v).bit_count() % 2)
        out.append(bits - (1 << BITS) if bits >> 63 else bits)
    return out


def _near(a: str, b: str) -> str:
    return f"bit_count({a} ^ {b}) <= {RADIUS}"


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that join the same fingerprints as all links would; `prints` has distinct longs `fp`."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks())])
    dealt = prints.select("fp", F.explode(tables).alias("bucket"))
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut_lineage(dealt.join(sizes, "bucket").select("bucket", "fp", "n"), "buckets")
    small = shared.where(F.col("n") <= BUCKET).groupBy("bucket").agg(F.collect_list("fp").alias("fps"))
    pairs = F.expr(
        "flatten(transform(fps, x -> transform(filter(fps, y -> y > x AND "
        + _near("x", "y")
        + "), y -> struct(x AS a, y AS b))))"
    )
    close = small.select(F.explode(pairs).alias("e")).select("e.a", "e.b")
    flips = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    around = shared.where(F.col("n") > BUCKET).select("fp").distinct().select("fp", F.explode(flips).alias("near"))
    balls = around.groupBy("near").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    stars = balls.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return close.unionByName(stars).distinct()


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(row, id, fp, root, component_id, no): every row of df as a struct (only `carry`'s columns, if given),
    its id, fingerprint, the least fingerprint of its component, the component and a row number.

    component_id is the smallest id that links of RADIUS bits reach, the row's own included; null ids
    count only where a component has no other. Null, empty and blank texts have fingerprint 0 and
    are linked like any other. Repeated rows stay, each in the same component. An empty table
    gives no rows.
    """
    # The digest of a text is dear: it is taken once and kept with what the result needs.
    marked = df.select(
        F.struct(*(carry or ["*"])).alias("row"),
        F.col(id_col).alias("id"),
        fingerprint(F.col(text_col)).alias("fp"),
        F.monotonically_increasing_id().alias("no"),
    )
    return _grouped(cut_lineage(marked, "prints"))


def _grouped(marked: DataFrame) -> DataFrame:
    classes = cut_lineage(marked.groupBy("fp").agg(F.min("id").alias("id")), "classes")
    roots = components(links(classes.select("fp"))).select(F.col("node").alias("fp"), "root")
    named = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of = named.join(least, "root").select("fp", "root", "component_id")
    return marked.join(of, "fp").select("row", "id", "fp", "root", "component_id", "no")


def hex_print(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with df's columns: that of the smallest id, null ids last, ties by row order.

    df is read twice and should come from a stored table. Only ids and fingerprints are
    shuffled to find the rows that stay; the rows themselves then meet a list of numbers. That list grows with
    the rows, so it is merged with them and never broadcast, at any size.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "no")).alias("first")
    kept = near_groups(df, id_col, text_col, carry=[id_col]).groupBy("root").agg(first)
    kept = cut_lineage(kept.select(F.col("first.no").alias("kept_no")), "kept")
    rows = df.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("no"))
    return rows.join(kept.hint("merge"), F.col("no") == F.col("kept_no"), "left_semi").select("row.*")
