"""Staging to clean."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lens.operators.dedup import dedup_reviews
from commerce_lens.sources.schemas import ENRICHMENT_COLUMNS, REVIEW_COLUMNS

# The tables copied unchanged.
PASS_THROUGH_TABLES = (
    "customers",
    "geolocation",
    "order_items",
    "order_payments",
    "orders",
    "products",
    "sellers",
    "product_category_name_translation",
)


def clean_pass_through(df: DataFrame) -> DataFrame:
    return df.select("*")


def project_columns(df: DataFrame, columns: Mapping[str, str] | list[str]) -> DataFrame:
    """Named columns only; a mapping {output: input} also renames."""
    pairs = columns.items() if isinstance(columns, Mapping) else ((c, c) for c in columns)
    return df.select(*[F.col(source).alias(out) for out, source in pairs])


def add_typed_nulls(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add columns of the given types, all NULL."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})


def clean_order_reviews(staging: DataFrame) -> DataFrame:
    """Deduplicated reviews with empty translation and aspect columns."""
    kept = dedup_reviews(project_columns(staging, list(REVIEW_COLUMNS)))
    return add_typed_nulls(kept, ENRICHMENT_COLUMNS)
