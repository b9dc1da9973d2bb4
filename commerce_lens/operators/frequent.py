"""The most common values of columns, exact, without shuffling values that are no candidates.

Each task sums a column up in a frequent-items sketch of a fixed number of counters; the sketches are merged. A value that the merged
sketch does not list can stand at most BOUND * cells / COUNTERS times, so once the candidates are counted exactly and the n-th of
them stands more often, none is missed. That is the proof; it holds for columns with common values.

That is done for texts; values of fixed width are no wider than a digest and are counted as they are.
Text columns without common values, as free text, are counted by 64-bit digests, which leaves a task with a few bytes a cell.
Digests only choose candidates: what is returned is counted by the values themselves. Where fewer than n digests repeat, the
others stand once, and the lowest of them are found by a limit within each task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Counters of a sketch, and how many of its values are counted exactly.
COUNTERS, LISTED = 3072, 128
# A value stands at most 3.5 / counters more or less often than its sketch says, and is listed from the double of that on.
BOUND = 7
# Digests of a column that are looked up; with more equally common ones the column is counted by its values.
MOST = 1000
# Types whose values may be of any width.
WIDE = ("string", "binary")


def _cells(df: DataFrame, columns: Sequence[str], where: dict[str, str]) -> DataFrame:
    """(column, value): non-NULL cells, of columns of one type, that meet their column's condition."""
    cells = [f"IF(`{c}` IS NOT NULL AND {where.get(c, 'true')}, struct('{c}' AS column, `{c}` AS value), NULL)" for c in columns]
    return df.selectExpr(f"inline(filter(array({', '.join(cells)}), x -> x IS NOT NULL))")


def _counted(df: DataFrame, columns: Sequence[str], where: dict[str, str]) -> DataFrame:
    return _cells(df, columns, where).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def _first(counts: DataFrame, n: int) -> DataFrame:
    """(column, rank, value, count): the n most common of each column, equal ones by value."""
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value")))
    return counts.withColumn("rank", place).where(F.col("rank") <= n).select("column", "rank", "value", "count")


def _among(c: str, digests: Sequence[int]) -> str:
    return f"xxhash64(`{c}`) IN ({', '.join(f'{d}L' if d > -(1 << 63) else 'CAST(-9223372036854775808 AS BIGINT)' for d in digests)})" if digests else "false"


def _sketched(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[list[int], int, bool]]:
    """{column: (digests of the listed values, how often any other can stand at most)} from one read."""
    aggs = [F.expr(f"approx_top_k(`{c}`, {LISTED}, {COUNTERS})").alias(f"t{i}") for i, c in enumerate(columns)]
    sizes = [F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]
    row = df.agg(*aggs, *sizes)
    slim = [F.transform(f"t{i}", lambda x: F.struct(F.xxhash64(x["item"]).alias("digest"), x["count"].alias("count"))).alias(f"t{i}") for i in range(len(columns))]
    found = row.select(*slim, *[f"n{i}" for i in range(len(columns))]).first()
    out = {}
    for i, c in enumerate(columns):
        listed, cells = found[f"t{i}"] or [], found[f"n{i}"]
        counts = [x["count"] for x in listed]
        if sum(counts) == cells and len(listed) < LISTED:
            rest = 0  # nothing else is there
        else:
            rest = max(BOUND * cells // COUNTERS + 1, min(counts) if len(listed) == LISTED else 0)
        out[c] = ([x["digest"] for x in listed], rest)
    return out


def most_common(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """(column, rank, value, count): the n most common non-NULL values of each column as text; equal counts by value, ascending.

    Values of fixed width are counted type by type, which reads each column once. Texts are read once for the sketches and once for
    the counts of their candidates; those whose proof fails cost two more reads. df should come from a stored table. Only
    what is known of each column, and digests of a fixed number of candidates, reach the driver.
    """
    types, parts, proven = dict(df.dtypes), [], []
    for kind in dict.fromkeys(types[c] for c in columns if types[c] not in WIDE):
        parts.append(_first(_counted(df, [c for c in columns if types[c] == kind], {}), n))
    # Sketches know text alone.
    sketched = [c for c in columns if types[c] == "string"]
    known = _sketched(df, sketched) if sketched else {}
    if sure := [c for c in sketched if known[c][0]]:
        counts = _first(_counted(df, sure, {c: _among(c, known[c][0]) for c in sure}), n)
        own = counts.collect()  # n rows a column
        for c in sure:
            seen = [r["count"] for r in own if r["column"] == c]
            if known[c][1] == 0 or (len(seen) == n and min(seen) > known[c][1]):
                proven.append(c)
        held = [tuple(r) for r in own if r["column"] in proven]
        parts.append(df.sparkSession.createDataFrame(held, counts.schema))
    for kind in WIDE:
        if rest := [c for c in columns if types[c] == kind and c not in proven]:
            parts.append(_first(_by_digest(df, rest, n), n))
    texts = [part.withColumn("value", F.col("value").cast("string")) for part in parts]
    return reduce(DataFrame.unionByName, texts)


def _by_digest(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """Counts of enough values of each column to hold the n most common."""
    by_count = Window.partitionBy("column").orderBy(F.desc("w"))
    digests = _cells(df, columns, {}).select("column", F.xxhash64("value").alias("digest"))
    counts = digests.groupBy("column", "digest").agg(F.count(F.lit(1)).alias("w"))
    # The n-th count of each column, and as many digests as are looked up, the most common first.
    top = counts.where("w > 1").withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= MOST + 1)
    found: dict[str, list[tuple[int, int]]] = {c: [] for c in columns}
    for r in top.select("column", "digest", "w").collect():
        found[r["column"]].append((r["w"], r["digest"]))
    some, plain, once = {}, [], {}
    for c, own in found.items():
        own.sort(reverse=True)
        least = own[n - 1][0] if len(own) >= n else 1
        if least > 1 and len(own) > MOST and own[-1][0] == least:
            plain.append(c)
        elif least > 1:
            some[c] = _among(c, [d for w, d in own if w >= least])
        else:
            some[c] = _among(c, [d for _, d in own])
            once[c] = f"NOT {some[c]}"
    parts = [_counted(df, list(where), where) for where in (some, dict.fromkeys(plain, "true")) if where]
    if once:
        low = F.row_number().over(Window.partitionBy("column").orderBy("value"))
        lowest = _cells(df, list(once), once).withColumn("_low", low).where(F.col("_low") <= n)
        parts.append(lowest.select("column", "value", F.lit(1).cast("long").alias("count")))
    return reduce(DataFrame.unionByName, parts)
