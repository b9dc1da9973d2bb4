"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it to the shared folder and
reads it back as the next stage's docs, so a lost executor repeats part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lens.llm import bpe_tree, decontaminate, exact_dedup, quality, simhash
from commerce_lens.llm.ship import ship
from commerce_lens.session import cut_lineage


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts; it learns from the labels of documents not held out."""
    return quality.keep_good(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    ship(spark)
    return simhash.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, intact): ids as little-endian unsigned 32-bit integers, and whether they decode to the text."""
    ship(spark)
    ids = bpe_tree.encode(docs).select("row.doc_id", "row.lang", "row.source", F.col("row.text").alias("text"), "ids")
    both = bpe_tree.decode(ids)
    return both.select(
        "row.doc_id",
        "row.lang",
        "row.source",
        F.expr("octet_length(row.ids) div 4").cast("long").alias("n_tokens"),
        "row.ids",
        (F.col("decoded") == F.coalesce("row.text", F.lit("")).cast("binary")).alias("intact"),
    )


STAGES = [
    ("quality_classifier", keep_good_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("bpe_tokens", encode_tokens),
]

# A trained classifier and fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
