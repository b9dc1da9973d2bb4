"""Joins.

No side is broadcast by hint: Spark broadcasts a side whose measured size is below its
threshold, and splits hot keys of sort-merge joins at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lens.functions.json_text import ASPECTS, json_scores
from commerce_lens.functions.scalars import month_start


def order_facts(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """orders with their items and reviews, both by left join on order_id.

    A left join can be split on its left side only, and the side that repeats an order is the right
    one, so it is written as a right join with the items and reviews on the left. Each table is
    read once.
    """
    reviewed = reviews.join(orders, "order_id", "right")
    return items.join(reviewed, "order_id", "right").select(
        *orders.columns, *[c for c in reviews.columns if c != "order_id"], *[c for c in items.columns if c != "order_id"]
    )


def inner_join_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """orders with their customer; an order without one is dropped."""
    return orders.join(customers, "customer_id")


def categorised_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """(product_id, product_category_name_en); products without a translated category drop out."""
    return products.join(translation, "product_category_name").select(
        "product_id", F.col("product_category_name_english").alias("product_category_name_en")
    )


def review_product(
    reviews: DataFrame, items: DataFrame, products: DataFrame, translation: DataFrame
) -> DataFrame:
    """One row per review (or order) and item with the item's product and English category."""
    return reviews.join(items.select("order_id", "product_id"), "order_id").join(
        categorised_products(products, translation), "product_id"
    )


def review_aspect_geo(
    reviews: DataFrame,
    items: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    strict: bool = False,
    stored: bool = False,
) -> DataFrame:
    """One row per scored review and item: month, English category, city and five scores.

    A score that isn't a number is NULL, or an error when strict; marts.rejected_scores() counts them.

    Reviews that are `stored` may be read twice: their orders are looked up by ids alone, and texts are shuffled once, by order,
    whatever the number of items. Merged in order of orders, the rows of a review lie side by side and are stored as little more than one.
    """
    scored = reviews.where(F.col("review_aspect_scores").isNotNull()).select(
        "review_id",
        "order_id",
        "review_comment_message_en",
        month_start("review_answer_timestamp").alias("review_month_date"),
        json_scores("review_aspect_scores", strict=strict).alias("s"),
    )
    if stored:
        asked = scored.select("order_id").distinct()
        cities = inner_join_customer(
            asked.join(orders.select("order_id", "customer_id"), "order_id"),
            customers.select("customer_id", F.col("customer_city").alias("city")),
        )
        sold = review_product(asked, items, products, translation)
        return _geo_columns(scored.join(cities.drop("customer_id"), "order_id").join(sold.drop("product_id"), "order_id"))
    # City is settled per review before items fan the rows out.
    located = scored.join(orders.select("order_id", "customer_id"), "order_id").join(
        customers.select("customer_id", F.col("customer_city").alias("city")), "customer_id"
    )
    return _geo_columns(review_product(located, items, products, translation))


def _geo_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "review_id",
        "review_comment_message_en",
        "review_month_date",
        "product_category_name_en",
        "city",
        *[F.col(f"s.{a}").alias(f"{a}_score") for a in ASPECTS],
    )


def update_from(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """UPDATE target SET columns FROM source WHERE the keys are equal.

    Unmatched rows keep their values and a matched NULL overwrites. A target row that two
    source rows match is an error, raised in a filter that no column pruning can remove.
    """
    new = [F.max(F.struct(*columns)).alias("_new"), F.count(F.lit(1)).alias("_matches")]
    updates = source.groupBy(F.col(key).alias("_key")).agg(*new)
    joined = target.join(updates, F.col(key) == F.col("_key"), "left")
    message = F.concat(F.lit(f"more than one update for {key} "), F.col(key).cast("string"))
    single = F.coalesce(F.col("_matches"), F.lit(1)) == 1
    checked = joined.where(single | F.raise_error(message).cast("boolean"))
    return checked.select(
        *[
            F.when(F.col("_matches").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )
