"""Source files to staging tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from commerce_lens.sources.csv_files import read_table_csv
from commerce_lens.sources.schemas import CATEGORY_TRANSLATION
from commerce_lens.sources.tables import replace_table

# The nine staging tables.
STAGING_TABLES = (
    "customers",
    "geolocation",
    "order_items",
    "order_payments",
    "order_reviews",
    "orders",
    "products",
    "sellers",
    "product_category_name_translation",
)


@dataclass(frozen=True)
class SourceSpec:
    """One source: the table it fills, where its CSV files are, and an optional schema."""

    name: str
    path: str | list[str]
    schema: StructType | str | None = None
    required: tuple[str, ...] = field(default=())
    quoted_newlines: bool = True


def source_spec(name: str, path: str | list[str], **options) -> SourceSpec:
    """A spec with the declared schema where the header of the file cannot be detected.

    Give `schema` for any table whose columns are known: it saves the pass that infers types. Quoted fields of
    every table may hold newlines.
    """
    if name == "product_category_name_translation":
        options.setdefault("schema", CATEGORY_TRANSLATION)
    return SourceSpec(name, path, **options)


def ingest(spark: SparkSession, specs: Iterable[SourceSpec], root: str) -> dict[str, DataFrame]:
    """Load each source as staging table `name`, replacing what was there; a source is stored before the next is asked for."""
    return {
        s.name: replace_table(
            read_table_csv(spark, s.path, s.schema, s.required, s.quoted_newlines), root, "staging", s.name
        )
        for s in specs
    }
