"""Declared schemas of tables and files."""

from __future__ import annotations

from pyspark.sql import types as T

CATEGORY_TRANSLATION = T.StructType(
    [
        T.StructField("product_category_name", T.StringType()),
        T.StructField("product_category_name_english", T.StringType()),
    ]
)

TRANSLATIONS = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("review_comment_message_en", T.StringType()),
    ]
)

ASPECT_SCORES = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("review_aspect_scores", T.StringType()),
    ]
)

# Columns of the cleaned review table that come from the source file.
REVIEW_COLUMNS = (
    "review_id",
    "order_id",
    "review_score",
    "review_comment_title",
    "review_comment_message",
    "review_creation_date",
    "review_answer_timestamp",
)

# Columns added for enrichment, with their types.
ENRICHMENT_COLUMNS = {"review_comment_message_en": "string", "review_aspect_scores": "string"}
