"""The three marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lens.functions.aggregates import add_money, count_distinct, count_where, money_sum, ratio, weighted_avg
from commerce_lens.functions.json_text import ASPECTS, json_rejects, json_scores
from commerce_lens.functions.scalars import amount, month_of, month_start, to_day, year_month, year_of
from commerce_lens.operators.joins import categorised_products, inner_join_customer
from commerce_lens.operators.reshape import group_by
from commerce_lens.session import cut_lineage


def order_totals(items: DataFrame) -> DataFrame:
    """Items reduced to one row per order before anything is joined.

    Keeps what the marts need of the joined rows: how many there are, and counts and exact
    sums over them.
    """
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("order_item_id").alias("items"),
        money_sum("price").alias("revenue"),
        money_sum("freight_value").alias("freight"),
        F.count("freight_value").alias("freight_items"),
    )


def _order_rows(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order (and review), standing for `lines` joined rows, at least one."""
    joined = orders.join(order_totals(items), "order_id", "left").join(
        reviews.select("order_id", "review_score"), "order_id", "left"
    )
    lines = F.coalesce("lines", F.lit(1))
    return joined.withColumns(
        {
            "score_sum": F.col("review_score") * lines,
            "score_rows": F.when(F.col("review_score").isNotNull(), lines),
        }
    )


def _sales_measures(orders: Column) -> dict[str, Column]:
    items = F.coalesce(F.sum("items"), F.lit(0))
    return {
        "total_orders": orders,
        "total_revenue": amount(add_money("revenue")),
        "total_items_sold": items,
        "avg_items_per_order": ratio(items, orders),
        "avg_review_score": weighted_avg("score_sum", "score_rows"),
        "avg_freight_value": F.try_divide(amount(add_money("freight")), F.sum("freight_items").cast("double")),
    }


def agg_sales_daily(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders, revenue, items, freight and review score per purchase day.

    The review score is weighted by item rows, an order without items counting once.
    """
    rows = _order_rows(orders.select("order_id", "order_purchase_timestamp"), items, reviews)
    mart = group_by(rows, {"order_date": to_day("order_purchase_timestamp")}, _sales_measures(count_distinct("order_id")))
    return mart.select(
        "order_date",
        "total_orders",
        "total_revenue",
        "avg_freight_value",
        "avg_review_score",
        "total_items_sold",
        "avg_items_per_order",
    )


def agg_sales_by_city(orders: DataFrame, customers: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """The daily measures per month, city and state, with customers and total freight.

    Each table is read once, in a write of one row per order, place and customer.
    """
    placed = orders.select("order_id", "customer_id", "order_purchase_timestamp")
    places = customers.select("customer_id", "customer_city", "customer_state")
    rows = inner_join_customer(_order_rows(placed, items, reviews), places)
    keys = {
        "order_month": month_start("order_purchase_timestamp"),
        "city": F.col("customer_city"),
        "state": F.col("customer_state"),
    }
    # Two distinct counts in one step would copy every row; here rows are first summed up per order and
    # customer, and what is left is written, then counted once per order and once per customer.
    sums = {c: F.sum(c).alias(c) for c in ("items", "freight_items", "score_sum", "score_rows")}
    sums |= {c: add_money(c).alias(c) for c in ("revenue", "freight")}
    placed = list(keys)
    pairs = group_by(rows, keys | {"order_id": F.col("order_id"), "customer_id": F.col("customer_id")}, sums)
    pairs = cut_lineage(pairs, "order_customers")
    per_order = group_by(pairs, {c: F.col(c) for c in [*placed, "order_id"]}, sums)
    customers_in = pairs.select(*placed, "customer_id").distinct().groupBy(*placed).agg(F.count("customer_id").alias("unique_customers"))
    measures = _sales_measures(F.count("order_id")) | {"total_freight_value": amount(add_money("freight"))}
    mart = group_by(per_order, {c: F.col(c) for c in placed}, measures)
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"c.{c}")) for c in placed]
    joined = mart.alias("m").join(customers_in.alias("c"), same).select("m.*", "unique_customers")
    return joined.select(
        "order_month",
        year_month("order_month").alias("year_month"),
        "city",
        "state",
        "total_orders",
        "total_revenue",
        "unique_customers",
        "total_items_sold",
        "avg_items_per_order",
        "avg_review_score",
        "total_freight_value",
        "avg_freight_value",
    )


def agg_aspect_score_by_product(
    reviews: DataFrame, items: DataFrame, products: DataFrame, translation: DataFrame, strict: bool = False
) -> DataFrame:
    """Review counts, scores and negative counts per product, category and answer month.

    A score that isn't a number counts as none, or is an error when strict.

    Counts are of review and item pairs. Pairs are summed up per product and month before
    the product tables are joined, so a product that holds much of the data is one row per
    task and month when it is shuffled.
    """
    scored = reviews.where(F.col("review_aspect_scores").isNotNull()).select(
        "review_id",
        "order_id",
        "review_score",
        month_start("review_answer_timestamp").alias("review_month_date"),
        json_scores("review_aspect_scores", strict=strict).alias("s"),
    )
    pairs = scored.join(items.select("order_id", "product_id"), "order_id")
    per_product = pairs.groupBy("product_id", "review_month_date").agg(
        F.count("review_id").alias("total_reviews"),
        F.count(F.lit(1)).alias("num_reviews_with_aspect_scores"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_rows"),
        *[F.sum(f"s.{a}").alias(f"{a}_sum") for a in ASPECTS],
        *[F.count(f"s.{a}").alias(f"{a}_rows") for a in ASPECTS],
        *[count_where(F.col(f"s.{a}") < 0).alias(f"count_negative_{a}") for a in ASPECTS],
    )
    categorised = per_product.join(categorised_products(products, translation), "product_id")
    # Sums of sums, so that a product listed twice in one category counts twice.
    counts = ["total_reviews", "num_reviews_with_aspect_scores", *[f"count_negative_{a}" for a in ASPECTS]]
    mart = categorised.groupBy("product_id", "product_category_name_en", "review_month_date").agg(
        *[F.sum(c).alias(c) for c in counts],
        weighted_avg("score_sum", "score_rows").alias("avg_review_score"),
        *[weighted_avg(f"{a}_sum", f"{a}_rows").alias(f"avg_{a}_score") for a in ASPECTS],
    )
    return mart.select(
        "product_id",
        "product_category_name_en",
        year_of("review_month_date").alias("review_year"),
        month_of("review_month_date").alias("review_month"),
        "review_month_date",
        "total_reviews",
        "num_reviews_with_aspect_scores",
        "avg_review_score",
        *[f"avg_{a}_score" for a in ASPECTS],
        *[f"count_negative_{a}" for a in ASPECTS],
    )


def rejected_scores(reviews: DataFrame) -> DataFrame:
    """(aspect, reviews): how many reviews have a score for the aspect that isn't a number."""
    found = reviews.select(F.explode(json_rejects("review_aspect_scores")).alias("aspect"))
    return found.groupBy("aspect").agg(F.count(F.lit(1)).alias("reviews"))
