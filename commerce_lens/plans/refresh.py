"""Source files to marts as one Spark application."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from commerce_lens.operators.clean import PASS_THROUGH_TABLES, clean_order_reviews, clean_pass_through
from commerce_lens.operators.joins import review_aspect_geo
from commerce_lens.operators.select import sorted_layout
from commerce_lens.plans.enrichment import carry_over, enrich_with_rejects
from commerce_lens.plans.marts import agg_aspect_score_by_product, agg_sales_by_city, agg_sales_daily, rejected_scores
from commerce_lens.session import discard, shuffles_deleted
from commerce_lens.sources.ingest import SourceSpec, ingest
from commerce_lens.sources.tables import replace_table


def refresh(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    root: str,
    open_translator: Callable,
    open_scorer: Callable,
    n: int | None = None,
    previous: DataFrame | None = None,
    tasks: int | None = None,
    mode: str = "quarantine",
    answers: str | None = None,
) -> dict[str, DataFrame]:
    """Run staging, clean, enrichment and marts; returns the stored tables as {layer.name}.

    All pending reviews are enriched; `n` is how many one run of the model gets. With mode "failfast" an answer
    without a response, content that isn't JSON or a score that isn't a number is an error. Otherwise such
    answers are left out and stored in clean.rejected_answers, such scores counted in clean.rejected_scores.

    Every layer reads stored tables of the one before. `previous` is an earlier cleaned
    review table whose answers are kept; without it each run starts from none. `answers` is a folder for the model's
    answers: a refresh that was cut off goes on from the runs that are complete there.
    """
    with shuffles_deleted(spark):
        staging = ingest(spark, specs, root)
        clean = {
            name: replace_table(clean_pass_through(staging[name]), root, "clean", name) for name in PASS_THROUGH_TABLES
        }
        reviews = clean_order_reviews(staging["order_reviews"])
        if previous is not None:
            reviews = carry_over(reviews, previous)
        reviews = replace_table(reviews, root, "clean", "order_reviews")
        strict = mode == "failfast"
        copies: list[str] = []
        enriched, rejects = enrich_with_rejects(reviews, open_translator, open_scorer, n, tasks, mode, stored=True, folder=answers, paths=copies)
        clean["rejected_answers"] = replace_table(rejects, root, "clean", "rejected_answers")
        reviews = replace_table(enriched, root, "clean", "order_reviews")
        discard(spark, copies)
        clean["rejected_scores"] = replace_table(rejected_scores(reviews), root, "clean", "rejected_scores")
        orders, items, customers = clean["orders"], clean["order_items"], clean["customers"]
        products, translation = clean["products"], clean["product_category_name_translation"]
        geo = review_aspect_geo(reviews, items, products, translation, orders, customers, strict, stored=True)
        clean["order_reviews"] = reviews
        clean["order_reviews_aspect_geo"] = replace_table(geo, root, "clean", "order_reviews_aspect_geo")
        marts = {
            "agg_sales_daily": agg_sales_daily(orders, items, reviews),
            "agg_sales_by_city": sorted_layout(
                agg_sales_by_city(orders, customers, items, reviews), "order_month", "city", "state"
            ),
            "agg_aspect_score_by_product": sorted_layout(
                agg_aspect_score_by_product(reviews, items, products, translation, strict), "review_month_date", "product_id"
            ),
        }
        aggregated = {name: replace_table(df, root, "aggregated", name) for name, df in marts.items()}
        layers = {"staging": staging, "clean": clean, "aggregated": aggregated}
        return {f"{layer}.{name}": df for layer, tables in layers.items() for name, df in tables.items()}
