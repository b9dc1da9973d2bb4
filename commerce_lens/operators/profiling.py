"""Table and column profiles."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lens.operators.frequent import WIDE, most_common
from commerce_lens.operators.quantiles import in_columns, weighted_quantiles
from commerce_lens.operators.stats import is_numeric, nan_as_null, numeric_columns
from commerce_lens.session import cut_lineage

# Repeated digests that are broadcast at most.
FEW = 100_000
QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}


# Of n numbers, and the sums m2, m3 and m4 of the powers of their distance from the mean.
NUMERIC_MEASURES = {
    "min": "low",
    "max": "high",
    "mean": "total / n",
    "std": "IF(n > 1, sqrt(m2 / (n - 1)), NULL)",
    "zeros": "zeros",
    "negatives": "negatives",
    "skew": "IF(n > 2, try_divide(sqrt(n) * m3, m2 * sqrt(m2)) * sqrt(n * (n - 1)) / (n - 2), NULL)",
    "kurtosis": "IF(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (try_divide(n * m4, m2 * m2) - 3) + 6), NULL)",
}
TEXT_MEASURES = ("min_length", "max_length", "mean_length")
# Counted as one type, so that a row has fewer keys.
WHOLE = ("tinyint", "smallint", "int", "bigint")


def _cells(df: DataFrame, make: Callable[[str, str], str]) -> DataFrame:
    """One row per cell, made by an SQL struct per column and type, from one read of df."""
    return df.selectExpr(f"inline(array({', '.join(make(c, t) for c, t in df.dtypes)}))")


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: type, counts, distinct values, moments, quantiles, text lengths.

    Skew and kurtosis carry the small-sample correction. Numeric measures are NULL for other
    types, text lengths are NULL for anything but text. df is read twice: once for lengths and missing cells, once for how often
    each value stands in each column, from which distinct values, moments and quantiles are taken. Values
    of fixed width are counted as they are, texts by a digest of 128 bits, so that no text leaves its task.
    """
    df = nan_as_null(df)
    numeric, place = numeric_columns(df), {c: i for i, c in enumerate(df.columns)}
    kind = {c: "bigint" if t in WHOLE else t for c, t in df.dtypes if t not in WIDE}
    kinds = list(dict.fromkeys(kind.values()))
    wide = len(kind) < len(place)

    def typed(c: str, t: str) -> str:
        values = [f"CAST(`{c}` AS {k}) AS v{i}" if kind.get(c) == k else f"CAST(NULL AS {k}) AS v{i}" for i, k in enumerate(kinds)]
        if wide:
            values.append(f"{f'unhex(md5(CAST(`{c}` AS BINARY)))' if t in WIDE else 'CAST(NULL AS BINARY)'} AS digest")
        return f"struct({place[c]} AS at, `{c}` IS NULL AS empty, {', '.join(values)})"

    def sized(c: str, t: str) -> str:
        sizes = [f"{f}(length(`{c}`))" if t == "string" else f"CAST(NULL AS {k})" for f, k in (("min", "INT"), ("max", "INT"), ("avg", "DOUBLE"))]
        named = ", ".join(f"{x} AS {n}" for x, n in zip(sizes, TEXT_MEASURES))
        return f"struct({place[c]} AS at, '{c}' AS column, '{t}' AS type, count(1) AS rows, count(1) - count(`{c}`) AS missing, {named})"

    out = df.agg(F.expr(f"array({', '.join(sized(c, t) for c, t in df.dtypes)})").alias("columns")).select(F.inline("columns"))
    number = F.coalesce(*[F.col(f"v{i}").cast("double") for i, k in enumerate(kinds) if is_numeric(k)], F.lit(None).cast("double"))
    keys = [*[f"v{i}" for i in range(len(kinds))], *["digest"] * wide]
    counts = _cells(df, typed).where("NOT empty").groupBy("at", *keys).agg(F.count(F.lit(1)).alias("w"))
    counts = cut_lineage(counts.select("at", number.alias("value"), "w"), "values")
    numbers = counts.where("value IS NOT NULL")
    sums = {
        "distinct": "count(1)",
        "unique": "count_if(w = 1)",
        "n": "CAST(sum(IF(value IS NULL, 0, w)) AS DOUBLE)",
        "total": "sum(value * w)",
        "low": "min(value)",
        "high": "max(value)",
        "zeros": "sum(IF(value = 0, w, 0))",
        "negatives": "sum(IF(value < 0, w, 0))",
    }
    sums = counts.groupBy("at").agg(*[F.expr(sql).alias(name) for name, sql in sums.items()])
    # Equal numbers are at no distance, however their sum is rounded.
    centre = sums.select("at", F.expr("IF(low = high, low, total / nullif(n, 0))").alias("centre"))
    away = numbers.join(F.broadcast(centre), "at").select("at", "w", (F.col("value") - F.col("centre")).alias("d"))
    powers = {"m2": "sum(w * (d * d))", "m3": "sum(w * (d * d * d))", "m4": "sum(w * (d * d) * (d * d))"}
    moments = away.groupBy("at").agg(*[F.expr(sql).alias(name) for name, sql in powers.items()])
    quantiles = weighted_quantiles(numbers, ["at"], list(QUANTILES.values()))
    for part in (sums, moments, in_columns(quantiles, ["at"], QUANTILES)):
        # Every side has one row per column.
        out = out.join(F.broadcast(part), "at", "left")
    out = out.withColumn("n", F.expr("nullif(n, 0)"))
    is_number = F.col("column").isin(numeric)
    return out.withColumns(
        {
            **{c: F.coalesce(c, F.lit(0)).cast("long") for c in ("rows", "missing", "distinct", "unique")},
            **{c: F.when(is_number, F.coalesce(c, F.lit(0))).cast("long") for c in ("zeros", "negatives")},
        }
    ).select(
        "column", "type", "rows", "missing", "distinct", "unique",
        *[F.expr(sql).alias(name) for name, sql in NUMERIC_MEASURES.items()],
        *QUANTILES,
        *TEXT_MEASURES,
    )


def _digest(df: DataFrame) -> list[Column]:
    """128 bits of a whole row, NULLs told apart by their place; equal rows agree."""
    empty = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in df.columns])
    there, back = [F.col(c) for c in df.columns], [F.col(c) for c in reversed(df.columns)]
    return [F.xxhash64(empty, *there).alias("_one"), F.xxhash64(F.lit(len(back)), *back, empty).alias("_two")]


def profile_table(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and duplicate rows of a table, as one row.

    Rows are counted by a digest of 128 bits, and only rows whose digest repeats are compared as a whole. Up to FEW repeated
    digests are broadcast, and what a row holds leaves its task only where its digest is one of them; with more, the rows
    are shuffled to them. df is read three times.
    """
    df = nan_as_null(df)
    nulls = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0))
    sums = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.coalesce(F.sum(nulls), F.lit(0)).alias("missing_cells"),
    )
    twice = df.select(*_digest(df)).groupBy("_one", "_two").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    twice = cut_lineage(twice, "twice")
    if twice.count() <= FEW:
        twice = F.broadcast(twice)  # rows are held against it where they are
    compared = df.select("*", *_digest(df)).join(twice, ["_one", "_two"], "left_semi")
    whole_rows = compared.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = whole_rows.agg(F.count(F.lit(1)).alias("duplicate_groups"), F.coalesce(F.sum("_n"), F.lit(0)).alias("duplicate_rows"))
    # One row and one row.
    return sums.withColumn("_on", F.lit(1)).join(F.broadcast(repeated.withColumn("_on", F.lit(1))), "_on").drop("_on")


def profile_top_values(df: DataFrame, n: int = 10) -> DataFrame:
    """The n most common values of each column with their share of all rows."""
    df = nan_as_null(df)
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return most_common(df, df.columns, n).withColumn("share", F.col("count") / total)


def profile_correlations(df: DataFrame) -> DataFrame:
    """Pearson correlation of each pair of numeric columns over rows that have both."""
    df = nan_as_null(df)
    pairs = list(combinations(numeric_columns(df), 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, correlation double")
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}@{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}@{b}`").alias("correlation")) for a, b in pairs
    ]
    return row.select(F.inline(F.array(*cells)))
