"""One named query per operator, over the views of one scale."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lens.catalog.fixtures import Views, stand_in_scorer, stand_in_translator
from commerce_lens.functions import aggregates as agg
from commerce_lens.functions import scalars as fn
from commerce_lens.functions.json_text import ASPECTS, json_doc, json_scores, json_valid, result_fields
from commerce_lens.operators import clean, dedup, density, enrich, joins, profiling, reshape, select, stats
from commerce_lens.operators.reshape import CATEGORY, CITY, SCORE_COLUMNS, group_by
from commerce_lens.plans import enrichment, marts
from commerce_lens.plans.refresh import refresh
from commerce_lens.session import cut_lineage, discard, scratch_path
from commerce_lens.sources import csv_files, jsonl, tables
from commerce_lens.sources.ingest import SourceSpec, ingest, source_spec
from commerce_lens.sources.schemas import ENRICHMENT_COLUMNS, REVIEW_COLUMNS, TRANSLATIONS

Query = Callable[[Views], DataFrame]
QUERIES: dict[str, Query] = {}

QUALITY, SERVICE, DELIVERY = "product_quality_score", "customer_service_score", "delivery_score"
DRILL_COLUMNS = (
    "review_id",
    "review_comment_message_en",
    "product_quality_score",
    "delivery_score",
    "refund_process_score",
    "customer_service_score",
    "city",
    "product_category_name_en",
)
# The scores the fixture can take.
QUARTERS = [q / 4 for q in range(-4, 5)]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Floating-point results to a fixed number of digits; adding 0.0 drops a negative zero."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def stamp(c: str) -> Column:
    """A timestamp as text, the same in every engine."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# --- sources and sinks ---------------------------------------------------------------


@query
def csv_infer_load(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "csv_infer")
    csv_files.write_table_csv(v.raw("documents"), path)
    df = csv_files.read_table_csv(v.spark, path, quoted_newlines=True)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))


@query
def csv_declared_load(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "csv_declared")
    rows = v.staging_reviews.select(
        F.col("review_id").cast("string").alias("review_id"),
        F.col("review_comment_message").alias("review_comment_message_en"),
    )
    csv_files.write_table_csv(rows, path)
    return csv_files.read_table_csv(v.spark, path, TRANSLATIONS, required=["review_id"], quoted_newlines=True)


def _write_sources(v: Views) -> Iterator[SourceSpec]:
    """The sources one after the other: each is written when it is asked for, and goes when the next one is, being staged by then."""
    root = scratch_path(v.spark, "sources")
    for name, df in v.sources().items():
        csv_files.write_table_csv(df, f"{root}/{name}")
        # The translation keeps its own declared schema.
        declared = {} if name == "product_category_name_translation" else {"schema": df.schema}
        yield source_spec(name, f"{root}/{name}", **declared)
        discard(v.spark, [f"{root}/{name}"])


# What a row of a source table is checked by, in SQL that both engines read alike.
ROW_TEXTS = {
    "customers": "customer_id, customer_city, customer_state",
    "geolocation": "geolocation_id, geolocation_city",
    "order_items": "order_id, order_item_id, product_id, seller_id, CAST(round(price * 100) AS BIGINT), CAST(round(freight_value * 100) AS BIGINT)",
    "order_payments": "order_id, CAST(round(payment_value * 100) AS BIGINT)",
    "order_reviews": "review_id, order_id, review_score, review_comment_title, review_comment_message",
    "orders": "order_id, customer_id, order_status",
    "products": "product_id, product_category_name",
    "sellers": "seller_id, seller_name",
    "product_category_name_translation": "product_category_name, product_category_name_english",
}


def _row_counts(named: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, and for source tables a sum over the digests of their rows, which no order changes."""
    counts = []
    for name, df in named.items():
        texts = ROW_TEXTS.get(name.split(".")[-1]) if name.split(".")[0] in (name, "staging") else None
        digest = f"sum(CAST(conv(substr(md5(concat_ws('|', {texts})), 1, 8), 16, 10) AS BIGINT))" if texts else "CAST(NULL AS BIGINT)"
        counts.append(df.agg(F.count(F.lit(1)).alias("rows"), F.expr(digest).alias("digest")).select(F.lit(name).alias("table_name"), "rows", "digest"))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out


@query
def ingest_all(v: Views) -> DataFrame:
    return _row_counts(ingest(v.spark, _write_sources(v), scratch_path(v.spark, "ingest")))


@query
def scan_table(v: Views) -> DataFrame:
    root = scratch_path(v.spark, "scan")
    tables.replace_table(v.products, root, "clean", "products")
    return tables.table(v.spark, root, "clean", "products")


@query
def replace_table(v: Views) -> DataFrame:
    root = scratch_path(v.spark, "replace")
    tables.replace_table(v.orders, root, "clean", "orders")
    current = tables.table(v.spark, root, "clean", "orders")
    tables.replace_table(current.where("order_status = 'F'"), root, "clean", "orders")
    return tables.table(v.spark, root, "clean", "orders").select("order_id", "customer_id", "order_status")


@query
def jsonl_request_sink(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "requests")
    requests = enrich.translation_requests(enrich.pending_translation(v.reviews))
    jsonl.write_jsonl(enrich.request_documents(requests), path)
    lines = v.spark.read.text(path)
    return lines.select(
        F.get_json_object("value", "$.custom_id").alias("custom_id"),
        F.get_json_object("value", "$.body.model").alias("model"),
        F.get_json_object("value", "$.body.messages[1].content").alias("user_prompt"),
        F.get_json_object("value", "$.body.max_tokens").cast("int").alias("max_tokens"),
    )


@query
def jsonl_result_source(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "results")
    v.translation_results.select("line").write.text(path)
    return jsonl.read_results(v.spark, path).select("custom_id", "status_code", "content")


@query
def enrichment_csv_sink(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "enrichment")
    csv_files.write_enrichment_csv(enrich.parse_translations(v.translation_results), path)
    return csv_files.read_table_csv(v.spark, path, TRANSLATIONS, required=["review_id"], quoted_newlines=True)


# --- projections and filters ---------------------------------------------------------


@query
def clean_pass_through(v: Views) -> DataFrame:
    return clean.clean_pass_through(v.items).withColumn("shipping_limit_date", stamp("shipping_limit_date"))


@query
def project_columns(v: Views) -> DataFrame:
    kept = clean.project_columns(v.staging_with_k, list(REVIEW_COLUMNS))
    return kept.withColumns({c: stamp(c) for c in ("review_creation_date", "review_answer_timestamp")})


@query
def add_typed_nulls(v: Views) -> DataFrame:
    return clean.add_typed_nulls(v.staging_reviews.select("review_id", "order_id"), ENRICHMENT_COLUMNS)


@query
def filter_null_predicates(v: Views) -> DataFrame:
    todo = select.pending(v.scored_reviews, "review_comment_message_en", "review_aspect_scores")
    return todo.select("review_id", "review_comment_message_en")


@query
def filter_negative_scores(v: Views) -> DataFrame:
    return select.negative(v.geo, QUALITY).select("review_id", QUALITY)


@query
def filter_isin_top(v: Views) -> DataFrame:
    return select.keep_top(v.geo_table, CITY, 10).select("review_id", CITY, QUALITY)


@query
def filter_compound_eq(v: Views) -> DataFrame:
    return select.drill_down(v.geo_with_text, "en_economy_1", "NATION_3", DRILL_COLUMNS)


@query
def dropna_subset(v: Views) -> DataFrame:
    columns = ["review_comment_title", "review_comment_message"]
    return select.dropna_subset(v.staging_reviews, columns).select("review_id", "order_id", *columns)


@query
def cte_reuse(v: Views) -> DataFrame:
    return v.spark.sql(
        """
        WITH daily AS (
          SELECT to_date(order_purchase_timestamp) AS order_date, order_status, count(*) AS orders
          FROM {orders} GROUP BY 1, 2
        ), busiest AS (
          SELECT order_date, max(orders) AS most FROM daily GROUP BY order_date
        )
        SELECT daily.order_date, daily.order_status, daily.orders
        FROM daily JOIN busiest ON daily.order_date = busiest.order_date AND daily.orders = busiest.most
        """,
        orders=v.orders,
    )


@query
def column_alias(v: Views) -> DataFrame:
    return clean.project_columns(v.customers, {"id": "customer_id", "city": "customer_city", "state": "customer_state"})


# --- joins ---------------------------------------------------------------------------


@query
def left_join_chain(v: Views) -> DataFrame:
    facts = joins.order_facts(
        v.orders.select("order_id", "customer_id"),
        v.items.select("order_id", "order_item_id", "price"),
        v.review_scores.select("order_id", "review_id", "review_score"),
    )
    return facts.select("order_id", "customer_id", "order_item_id", "price", "review_id", "review_score")


@query
def inner_join_customer(v: Views) -> DataFrame:
    joined = joins.inner_join_customer(v.orders, v.customers)
    return joined.select("order_id", "customer_id", "customer_city", "customer_state")


@query
def inner_join_review_product(v: Views) -> DataFrame:
    joined = joins.review_product(v.review_scores, v.items, v.products, v.translation)
    return joined.select("review_id", "order_id", "product_id", "product_category_name_en", "review_score")


@query
def review_aspect_geo(v: Views) -> DataFrame:
    return v.geo_with_text


@query
def update_from_join(v: Views) -> DataFrame:
    target = v.staging_reviews.select("review_id", "order_id", "review_score", "review_comment_title")
    changes = v.review_scores.where("review_score <> 3").select(
        "review_id", F.expr("CASE WHEN review_score > 1 THEN concat('score ', review_score) END AS review_comment_title")
    )
    return joins.update_from(target, changes, "review_id", ["review_comment_title"])


# --- aggregations --------------------------------------------------------------------


@query
def agg_count_column(v: Views) -> DataFrame:
    return v.staging_reviews.groupBy("review_score").agg(
        agg.count_col("review_comment_message").alias("messages"),
        agg.count_col("review_comment_title").alias("titles"),
    )


@query
def agg_count_distinct(v: Views) -> DataFrame:
    return reshape.distinct_counts(v.orders, ["order_status"], {"orders": "order_id", "customers": "customer_id"})


@query
def agg_sum(v: Views) -> DataFrame:
    return v.items.groupBy("product_id").agg(
        agg.sum_money("price").alias("revenue"), agg.sum_money("freight_value").alias("freight")
    ).transform(rounded, "revenue", "freight")


@query
def agg_avg(v: Views) -> DataFrame:
    return v.items.groupBy("product_id").agg(
        agg.avg_money("price").alias("avg_price"), agg.avg_col("freight_value").alias("avg_freight")
    ).transform(rounded, "avg_price", "avg_freight", digits=8)


@query
def agg_countif(v: Views) -> DataFrame:
    return v.geo.groupBy(CATEGORY).agg(
        *[agg.count_where(F.col(c) < 0).alias(f"negative_{c}") for c in SCORE_COLUMNS]
    )


@query
def agg_ratio(v: Views) -> DataFrame:
    return v.items.groupBy("product_id").agg(
        agg.ratio(agg.count_col("order_item_id"), agg.count_distinct("order_id")).alias("items_per_order")
    )


@query
def group_by_expression(v: Views) -> DataFrame:
    return group_by(
        v.orders,
        {"order_date": fn.to_day("order_purchase_timestamp"), "year_month": fn.year_month("order_purchase_timestamp")},
        {"orders": agg.count_col("order_id")},
    )


@query
def group_multi_agg(v: Views) -> DataFrame:
    return reshape.score_by(v.geo, [CATEGORY, CITY], QUALITY)


@query
def pair_frequency(v: Views) -> DataFrame:
    return reshape.pair_frequency(v.geo, QUALITY, SERVICE)


@query
def trend_by_month(v: Views) -> DataFrame:
    return reshape.aspect_trend(v.geo)


# --- marts ---------------------------------------------------------------------------


@query
def agg_sales_daily(v: Views) -> DataFrame:
    mart = marts.agg_sales_daily(v.orders, v.items, v.review_scores)
    return rounded(mart, "total_revenue", "avg_freight_value", digits=8)


@query
def agg_sales_by_city(v: Views) -> DataFrame:
    mart = marts.agg_sales_by_city(v.orders, v.customers, v.items, v.review_scores)
    return rounded(mart, "total_revenue", "total_freight_value", "avg_freight_value", digits=8)


@query
def agg_aspect_score_by_product(v: Views) -> DataFrame:
    return marts.agg_aspect_score_by_product(v.aspect_scores, v.items, v.products, v.translation)


# --- ranks and deduplication ---------------------------------------------------------


@query
def row_number_rank(v: Views) -> DataFrame:
    rows = v.staging_scores_with_k.select("review_id", "order_id", *dedup.REVIEW_ORDER)
    ranks = {
        "review_id_rank": ("review_id", [*dedup.REVIEW_ORDER, "order_id"]),
        "order_id_rank": ("order_id", [*dedup.REVIEW_ORDER, "review_id"]),
    }
    ranked = dedup.rank_in(rows, ranks)
    return ranked.select(
        "review_id", "order_id", stamp("review_answer_timestamp").alias("answered"), "review_id_rank", "order_id_rank"
    )


@query
def dedup_reviews(v: Views) -> DataFrame:
    return dedup.dedup_reviews(v.staging_reviews).select("review_id", "order_id", "review_score")


@query
def clean_order_reviews(v: Views) -> DataFrame:
    return v.reviews.withColumns({c: stamp(c) for c in dedup.REVIEW_ORDER})


@query
def distinct_first_by_key(v: Views) -> DataFrame:
    rows = v.staging_reviews.select("review_id", "order_id", "review_score", "review_answer_timestamp")
    return dedup.first_per_key(rows, "review_id", ["review_answer_timestamp"]).drop("review_answer_timestamp")


@query
def last_result_wins(v: Views) -> DataFrame:
    return dedup.last_per_key(v.translation_results, "custom_id", "seq").select("custom_id", "content")


# --- sort and top-k ------------------------------------------------------------------


@query
def sort_multi_key(v: Views) -> DataFrame:
    mart = marts.agg_sales_by_city(v.orders, v.customers, v.items, v.review_scores)
    kept = mart.select("order_month", "city", "state", "total_orders")
    return select.sort_by(kept, "order_month", "city", "state")


@query
def limit_batch(v: Views) -> DataFrame:
    return select.limit_batch(v.orders.select("order_id", "customer_id"), "order_id", 10_000)


@query
def top_k_frequency(v: Views) -> DataFrame:
    return select.top_values(v.geo, CITY, 10)


@query
def head_n(v: Views) -> DataFrame:
    return select.head_n(v.customers, "customer_id", 5)


# --- scalar functions ----------------------------------------------------------------


@query
def fn_date(v: Views) -> DataFrame:
    return v.raw("events").select("event_id", fn.to_day("ts").alias("day"))


@query
def fn_month_trunc(v: Views) -> DataFrame:
    return v.orders.select("order_id", fn.month_start("order_purchase_timestamp").alias("month"))


@query
def fn_format_yyyymm(v: Views) -> DataFrame:
    return v.orders.select("order_id", fn.year_month("order_purchase_timestamp").alias("year_month"))


@query
def fn_extract_year_month(v: Views) -> DataFrame:
    when = "order_purchase_timestamp"
    return v.orders.select("order_id", fn.year_of(when).alias("year"), fn.month_of(when).alias("month"))


@query
def fn_to_datetime(v: Views) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return v.raw("events").select("event_id", fn.to_ts(text).cast("timestamp_ntz").alias("at"))


@query
def fn_cast_double(v: Views) -> DataFrame:
    text = F.col("l_extendedprice").cast("string")
    marked = F.when(F.col("l_returnflag") == "R", F.concat(text, F.lit(" BRL"))).otherwise(text)
    return v.raw("lineitem").select(
        "l_orderkey", fn.to_double(text).alias("price"), fn.to_double(marked, tolerant=True).alias("tolerant_price")
    )


@query
def fn_replace_trim(v: Views) -> DataFrame:
    padded = F.concat(F.lit("\t\n  "), F.col("text"), F.lit(" \r\n "))
    return v.raw("documents").select("doc_id", fn.clean_text(padded).alias("text"))


@query
def fn_prompt_template(v: Views) -> DataFrame:
    return v.raw("documents").select("doc_id", fn.prompt('Customer Review: "', "text", '"').alias("prompt"))


@query
def fn_true_division(v: Views) -> DataFrame:
    return v.raw("part").select("p_partkey", fn.divide("p_partkey", "p_size").alias("quotient"))


@query
def json_validate(v: Views) -> DataFrame:
    cut = F.when(F.col("k") % 13 == 0, F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    return v.events.select("event_id", json_valid(cut).alias("is_valid"))


def _mixed_documents(v: Views) -> DataFrame:
    """Score documents with a number, a number as text, an object, null and a missing key."""
    k = F.col("k")
    document = F.concat(
        F.lit('{"delivery": '),
        (k / F.lit(4.0)).cast("string"),
        F.lit(', "product_quality": "'),
        k.cast("string"),
        F.lit('.5", "customer_service": '),
        F.when(k % 3 == 0, F.lit('{"score": 1}')).when(k % 3 == 1, F.lit("null")).otherwise(F.lit("[0.5]")),
        F.lit(', "packaging_condition": '),
        F.when(k % 2 == 0, F.lit("-1")).otherwise(F.lit('"none"')),
        F.lit("}"),
    )
    return v.events.select("event_id", document.alias("document"))


@query
def json_extract_scores(v: Views) -> DataFrame:
    scores = _mixed_documents(v).select("event_id", json_scores("document").alias("s"))
    return scores.select("event_id", *[F.col(f"s.{a}").alias(a) for a in ASPECTS])


@query
def json_build(v: Views) -> DataFrame:
    document = json_doc(city=F.col("customer_city"), place=F.struct("customer_state", "customer_id"))
    return v.customers.select("customer_id", document.alias("document"))


@query
def json_path_result(v: Views) -> DataFrame:
    return v.translation_results.select(result_fields("line").alias("r")).select("r.id", "r.status", "r.content")


# --- reshape -------------------------------------------------------------------------


@query
def pivot_pair_frequency(v: Views) -> DataFrame:
    return reshape.pivot_counts(v.geo, SERVICE, QUALITY, QUARTERS)


@query
def pivot_category_city_mean(v: Views) -> DataFrame:
    return reshape.category_city_cells(v.geo_table, QUALITY)


@query
def pivot_category_city_masked(v: Views) -> DataFrame:
    return reshape.category_city_cells(v.geo_table, DELIVERY, min_reviews=5)


@query
def pivot_top_both(v: Views) -> DataFrame:
    return reshape.category_city_cells(v.geo_table, SERVICE, min_reviews=5, top_categories=10)


@query
def melt_aspects(v: Views) -> DataFrame:
    return reshape.melt(reshape.aspect_trend(v.geo), ["review_month_date"], SCORE_COLUMNS, "aspect", "score")


# --- statistics ----------------------------------------------------------------------


@query
def describe_numeric(v: Views) -> DataFrame:
    out = stats.describe(v.geo, ["review_id", *SCORE_COLUMNS])
    return rounded(out, "mean", "std", "q25", "q50", "q75")


@query
def histogram_20(v: Views) -> DataFrame:
    return rounded(stats.histogram(v.geo_table, SCORE_COLUMNS), "bin_start", "bin_end")


@query
def histogram_negative(v: Views) -> DataFrame:
    return rounded(stats.histogram(select.negative(v.geo_table, QUALITY), QUALITY), "bin_start", "bin_end")


@query
def kde_1d(v: Views) -> DataFrame:
    return rounded(density.kde_1d(v.geo_table, SCORE_COLUMNS), "x", "density")


@query
def kde_2d(v: Views) -> DataFrame:
    return rounded(density.kde_2d(v.geo_table, [(QUALITY, SERVICE)]), "x", "y", "density")


@query
def kde_2d_levels(v: Views) -> DataFrame:
    return rounded(density.kde_levels(density.kde_2d(v.geo_table, [(QUALITY, SERVICE)])), "proportion", "density")


@query
def box_stats(v: Views) -> DataFrame:
    return rounded(stats.box_stats(v.geo_table, CATEGORY, QUALITY), "q1", "median", "q3")


@query
def box_outliers(v: Views) -> DataFrame:
    totals = marts.order_totals(v.items).select("order_id", fn.amount("revenue").alias("revenue"))
    orders = v.orders.select("order_id", "order_status").join(totals, "order_id")
    out = stats.box_outliers(cut_lineage(rounded(orders, "revenue"), "orders"), "order_status", "revenue")
    return out


@query
def pair_grid(v: Views) -> DataFrame:
    return rounded(density.pair_grid(v.geo_table, [QUALITY, SERVICE, DELIVERY]), "x", "value")


@query
def pair_grid_density(v: Views) -> DataFrame:
    return rounded(density.pair_grid(v.geo_table, [QUALITY, SERVICE, DELIVERY], kind="kde"), "x", "y", "value")


def _profiled(v: Views) -> dict[str, DataFrame]:
    return {
        "customers": v.customers,
        "orders": v.orders,
        "order_items": v.items,
        "products": v.products,
        "order_reviews": v.staging_reviews,
    }


def _per_table(v: Views, profile: Callable[[DataFrame], DataFrame]) -> DataFrame:
    out = None
    for name, df in _profiled(v).items():
        part = profile(df).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query
def profile_columns(v: Views) -> DataFrame:
    out = _per_table(v, profiling.profile_columns)
    return rounded(out, "mean", "std", "skew", "kurtosis", "mean_length", *profiling.QUANTILES, digits=4)


@query
def profile_table(v: Views) -> DataFrame:
    return _per_table(v, profiling.profile_table)


@query
def profile_top_values(v: Views) -> DataFrame:
    return _per_table(v, profiling.profile_top_values)


@query
def profile_correlations(v: Views) -> DataFrame:
    return rounded(_per_table(v, profiling.profile_correlations), "correlation")


# --- enrichment ----------------------------------------------------------------------


@query
def pending_translation(v: Views) -> DataFrame:
    return enrich.pending_translation(v.reviews)


@query
def pending_scoring(v: Views) -> DataFrame:
    return enrich.pending_scoring(v.translated_reviews)


@query
def translation_requests(v: Views) -> DataFrame:
    return enrich.translation_requests(enrich.pending_translation(v.reviews)).drop("response_format")


@query
def aspect_requests(v: Views) -> DataFrame:
    return enrich.aspect_requests(enrich.pending_scoring(v.translated_reviews))


@query
def translation_results(v: Views) -> DataFrame:
    return enrich.parse_translations(v.translation_results)


@query
def aspect_results(v: Views) -> DataFrame:
    parsed = enrich.parse_aspects(v.aspect_results)
    scores = parsed.select(
        "review_id", json_scores("review_aspect_scores", [*ASPECTS, "delivery_speed", "correct_items"]).alias("s")
    )
    return scores.select("review_id", *[F.col(f"s.{a}").alias(a) for a in (*ASPECTS, "delivery_speed", "correct_items")])


@query
def apply_model(v: Views) -> DataFrame:
    requests = enrich.translation_requests(enrich.pending_translation(v.reviews))
    lines = enrich.apply_model(requests, stand_in_translator(), "line string, seq long")
    return jsonl.expand_results(lines).select("custom_id", "status_code", "content", "seq")


@query
def merge_translations(v: Views) -> DataFrame:
    merged = enrich.merge_translations(v.reviews, enrich.parse_translations(v.translation_results))
    return merged.select("review_id", "order_id", "review_comment_message_en")


@query
def merge_aspects(v: Views) -> DataFrame:
    merged = enrich.merge_aspects(v.reviews, enrich.parse_aspects(v.aspect_results))
    scores = merged.select("review_id", "order_id", json_scores("review_aspect_scores").alias("s"))
    return scores.select("review_id", "order_id", *[F.col(f"s.{a}").alias(a) for a in ASPECTS])


@query
def enrich_reviews(v: Views) -> DataFrame:
    # Fewer requests a run than are pending, at every scale: all of them must come back all the same.
    out = enrichment.enrich_reviews(v.reviews, stand_in_translator(), stand_in_scorer(), n=400)
    scores = out.select("review_id", "review_comment_message_en", json_scores("review_aspect_scores").alias("s"))
    return scores.select("review_id", "review_comment_message_en", *[F.col(f"s.{a}").alias(a) for a in ASPECTS])


@query
def batch_outcome(v: Views) -> DataFrame:
    return enrich.batch_outcome(v.aspect_results)


@query
def refresh_all_layers(v: Views) -> DataFrame:
    root = scratch_path(v.spark, "refresh")
    return _row_counts(refresh(v.spark, _write_sources(v), root, stand_in_translator(), stand_in_scorer()))


def named_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Each query as a function of a session and the folder of one scale."""
    return {name: (lambda spark, sf_dir, q=q: q(Views(spark, sf_dir))) for name, q in QUERIES.items()}
