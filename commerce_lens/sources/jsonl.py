"""JSON-lines files: model requests out, model results in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lens.functions.json_text import result_fields


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON document per line."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def read_results(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Result lines as (custom_id, status_code, content, line, seq).

    seq orders lines by file, then by place in the file, so that "later" is well defined in
    a read that many tasks share.
    """
    lines = (
        spark.read.text(path)
        .select(
            F.col("value").alias("line"),
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("seq"),
        )
        .where(F.trim("line") != "")
    )
    return expand_results(lines, "line", "seq")


def expand_results(df: DataFrame, line: str = "line", seq: str = "seq") -> DataFrame:
    """Fields of result lines held in a column."""
    parsed = df.select(F.col(line).alias("line"), F.col(seq).alias("seq"), result_fields(line).alias("r"))
    return parsed.select(
        F.col("r.id").alias("custom_id"),
        F.col("r.status").alias("status_code"),
        F.col("r.content").alias("content"),
        "line",
        "seq",
    )
