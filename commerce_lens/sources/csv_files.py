"""CSV tables: typed reads and the enrichment hand-off file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from commerce_lens.sources.csv_records import read_records

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    # Keeps a quoted empty field as empty text; an unquoted empty field is NULL.
    "nullValue": "\u0001",
}


def read_table_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    required: Iterable[str] = (),
    quoted_newlines: bool = True,
) -> DataFrame:
    """A CSV table with one header row.

    Without a schema the types are inferred, at the price of one more pass over the files.
    Columns in `required` must not be NULL: such a row fails the job.

    Records may span lines: csv_records finds where, and many tasks read a file all the same, at the price of one more
    pass over the lines and of a shuffle of those splits that hold such records. quoted_newlines=False spares that pass where
    a file is known to have none.
    """
    if quoted_newlines and (df := read_records(spark, path, schema, CSV_OPTIONS)) is not None:
        return require(df, required)
    reader = spark.read.options(**CSV_OPTIONS)
    if schema is None:
        df = reader.option("inferSchema", "true").csv(path)
    else:
        df = reader.schema(schema).option("mode", "FAILFAST").csv(path)
    return require(df, required)


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail on a NULL in any of the columns.

    The check is part of the column, so that no filter on the key can run before it, and of
    a filter, so that it also runs where the key itself is not read.
    """
    for c in columns:
        checked = F.coalesce(F.col(c), F.raise_error(F.lit(f"NULL in required column {c}")))
        df = df.withColumn(c, checked).where(F.col(c).isNotNull())
    return df


WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def write_enrichment_csv(df: DataFrame, path: str) -> None:
    """Key and value columns with every text quoted and quotes doubled.

    With every field quoted a NULL comes out as empty text; parsed results hold none.
    """
    df.write.mode("overwrite").options(**WRITE_OPTIONS, quoteAll="true", emptyValue='').csv(path)


def write_table_csv(df: DataFrame, path: str) -> None:
    """CSV that read_table_csv reads back, quoted only where needed."""
    df.write.mode("overwrite").options(**WRITE_OPTIONS, emptyValue='""').csv(path)
