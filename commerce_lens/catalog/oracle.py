"""SQL counterparts of the named queries, for DuckDB over the raw test tables."""

from __future__ import annotations

from commerce_lens.functions.json_text import ASPECTS
from commerce_lens.operators.enrich import ASPECT_SYSTEM, MODEL, TRANSLATION_SYSTEM

SCORES = [f"{a}_score" for a in ASPECTS]
DEDUP_ORDER = "review_creation_date NULLS FIRST, review_answer_timestamp NULLS FIRST"
TRIM_CLASS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _clean_text(expression: str) -> str:
    flat = f"replace({expression}, chr(10), ' ')"
    return f"regexp_replace({flat}, '^{TRIM_CLASS}+|{TRIM_CLASS}+$', '', 'g')"


# Views in order of dependence.
VIEWS: dict[str, str] = {
    "v_customers": """
        SELECT c_custkey AS customer_id, n_name AS customer_city, r_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               o_orderdate AS order_purchase_timestamp FROM orders""",
    "v_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               l_quantity AS freight_value FROM lineitem""",
    "v_products": "SELECT p_partkey AS product_id, concat(p_type, '_', p_size % 4) AS product_category_name FROM part",
    "v_translation": """
        SELECT DISTINCT product_category_name,
               concat('en_', lower(product_category_name)) AS product_category_name_english
        FROM v_products WHERE product_category_name NOT LIKE 'PROMO%'""",
    "v_events": "SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "v_staging": """
        SELECT event_id - CASE WHEN event_id % 10 = 8 OR event_id % 12 = 4 THEN 1 ELSE 0 END AS review_id,
               event_id - CASE WHEN event_id % 4 = 3 THEN 1 ELSE 0 END AS order_id,
               1 + k % 5 AS review_score,
               CASE WHEN k % 3 = 0 THEN event_type END AS review_comment_title,
               d.text AS review_comment_message,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) AS review_creation_date,
               ts + to_days(CAST(event_id % 24 * 30 AS INTEGER)) AS review_answer_timestamp, k
        FROM v_events e LEFT JOIN documents d ON d.doc_id = e.event_id""",
    "v_ranked": f"""
        SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY {DEDUP_ORDER}, order_id NULLS FIRST) AS rr,
               row_number() OVER (PARTITION BY order_id ORDER BY {DEDUP_ORDER}, review_id NULLS FIRST) AS ro
        FROM v_staging""",
    "v_clean": "SELECT * EXCLUDE (rr, ro) FROM v_ranked WHERE rr = 1 AND ro = 1",
    "v_scored": f"""
        SELECT *, {_clean_text("concat('EN: ', review_comment_message)")} AS en_raw,
               k % 4 <> 0 AS has_scores,
               {", ".join(f"CASE WHEN k % 4 <> 0 THEN (((k + {j} * review_id) % 9) - 4) / CAST(4 AS DOUBLE) END AS {s}"
                          for j, s in enumerate(SCORES))}
        FROM v_clean""",
    "v_enriched": """
        SELECT *, CASE WHEN review_comment_message IS NOT NULL THEN en_raw END AS review_comment_message_en
        FROM v_scored""",
    "v_geo": f"""
        SELECT r.review_id, r.review_comment_message_en,
               CAST(date_trunc('month', r.review_answer_timestamp) AS DATE) AS review_month_date,
               t.product_category_name_english AS product_category_name_en, c.customer_city AS city,
               {", ".join("r." + s for s in SCORES)}
        FROM v_enriched r
        JOIN v_items i ON r.order_id = i.order_id
        JOIN v_products p ON i.product_id = p.product_id
        JOIN v_translation t ON p.product_category_name = t.product_category_name
        JOIN v_orders o ON r.order_id = o.order_id
        JOIN v_customers c ON o.customer_id = c.customer_id
        WHERE r.has_scores""",
    # One row per result line of the stand-in batches: seq 1 is the later answer.
    "v_tr_lines": """
        SELECT review_id, CASE WHEN review_id % 11 = 0 THEN 500 ELSE 200 END AS status_code, seq,
               CASE WHEN seq = 0 THEN concat(chr(10), ' EN: ', review_comment_message, chr(10))
                    ELSE concat('EN2: ', review_comment_message) END AS content
        FROM v_clean, (VALUES (0), (1)) s(seq)
        WHERE review_comment_message IS NOT NULL AND (seq = 0 OR review_id % 17 = 0)""",
    "v_tr_parsed": f"""
        SELECT review_id, {_clean_text("content")} AS en FROM v_tr_lines
        WHERE status_code = 200
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY seq DESC) = 1""",
    "v_as_lines": f"""
        SELECT review_id, CASE WHEN review_id % 11 = 0 THEN 500 ELSE 200 END AS status_code, seq,
               seq = 0 AND review_id % 13 = 0 AS malformed,
               {", ".join(f"(((k + seq + 2 * {j}) % 9) - 4) / CAST(4 AS DOUBLE) AS {a}" for j, a in enumerate(ASPECTS))}
        FROM v_clean, (VALUES (0), (1)) s(seq)
        WHERE k % 4 <> 0 AND (seq = 0 OR review_id % 17 = 0)""",
    "v_as_parsed": """
        SELECT * FROM v_as_lines WHERE status_code = 200 AND NOT malformed
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY seq DESC) = 1""",
    "v_sales": """
        SELECT o.order_id, o.customer_id, o.order_purchase_timestamp, i.order_item_id,
               i.price, i.freight_value,
               r.review_score
        FROM v_orders o LEFT JOIN v_items i ON o.order_id = i.order_id
        LEFT JOIN v_clean r ON o.order_id = r.order_id""",
    "v_daily": """
        SELECT CAST(order_purchase_timestamp AS DATE) AS order_date,
               count(DISTINCT order_id) AS total_orders,
               round(sum(price), 8) AS total_revenue,
               round(sum(freight_value) / count(freight_value), 8) AS avg_freight_value,
               CAST(sum(review_score) AS DOUBLE) / count(review_score) AS avg_review_score,
               count(order_item_id) AS total_items_sold,
               count(order_item_id) / count(DISTINCT order_id) AS avg_items_per_order
        FROM v_sales GROUP BY 1""",
    "v_by_city": """
        SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month,
               strftime(order_purchase_timestamp, '%Y%m') AS year_month,
               c.customer_city AS city, c.customer_state AS state,
               count(DISTINCT order_id) AS total_orders,
               round(sum(price), 8) AS total_revenue,
               count(DISTINCT s.customer_id) AS unique_customers,
               count(order_item_id) AS total_items_sold,
               count(order_item_id) / count(DISTINCT order_id) AS avg_items_per_order,
               CAST(sum(review_score) AS DOUBLE) / count(review_score) AS avg_review_score,
               round(sum(freight_value), 8) AS total_freight_value,
               round(sum(freight_value) / count(freight_value), 8) AS avg_freight_value
        FROM v_sales s JOIN v_customers c ON s.customer_id = c.customer_id GROUP BY 1, 2, 3, 4""",
}


def _uses(sql: str, seen: set[str]) -> None:
    """Collect the views a statement needs, with the views those need."""
    for name, body in VIEWS.items():
        if name in sql and name not in seen:
            seen.add(name)
            _uses(body, seen)


def _with(sql: str) -> str:
    """The statement with its views in front."""
    seen: set[str] = set()
    _uses(sql, seen)
    views = [f"{name} AS ({body})" for name, body in VIEWS.items() if name in seen]
    own = sql.strip()
    if own.upper().startswith("WITH "):
        return "WITH " + ",\n".join(views + [own[5:]])
    return ("WITH " + ",\n".join(views) + "\n" if views else "") + own


def _stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}"


REVIEWS = "review_id, order_id, review_score, review_comment_title, review_comment_message"
ORACLE: dict[str, str] = {}

# --- sources and sinks: what was written comes back ---
ORACLE["csv_infer_load"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
ORACLE["csv_declared_load"] = """
    SELECT CAST(review_id AS VARCHAR) AS review_id, review_comment_message AS review_comment_message_en FROM v_staging"""
SOURCES = {
    "customers": ("v_customers", "customer_id, customer_city, customer_state"),
    "geolocation": ("nation", "n_nationkey, n_name"),
    "order_items": (
        "v_items",
        "order_id, order_item_id, product_id, seller_id, CAST(round(price * 100) AS BIGINT), CAST(round(freight_value * 100) AS BIGINT)",
    ),
    "order_payments": ("orders", "o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT)"),
    "order_reviews": ("v_staging", "review_id, order_id, review_score, review_comment_title, review_comment_message"),
    "orders": ("v_orders", "order_id, customer_id, order_status"),
    "products": ("v_products", "product_id, product_category_name"),
    "sellers": ("supplier", "s_suppkey, s_name"),
    "product_category_name_translation": ("v_translation", "product_category_name, product_category_name_english"),
}
ORACLE["ingest_all"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, count(*) AS rows,
        CAST(sum(CAST(concat('0x', substr(md5(concat_ws('|', {texts})), 1, 8)) AS BIGINT)) AS BIGINT) AS digest FROM {view}"""
    for name, (view, texts) in SOURCES.items()
)
ORACLE["scan_table"] = "SELECT product_id, product_category_name FROM v_products"
ORACLE["replace_table"] = "SELECT order_id, customer_id, order_status FROM v_orders WHERE order_status = 'F'"
PENDING = """
    SELECT review_id, review_comment_message FROM v_clean WHERE review_comment_message IS NOT NULL
    """
ORACLE["jsonl_request_sink"] = f"""
    SELECT CAST(review_id AS VARCHAR) AS custom_id, '{MODEL}' AS model, review_comment_message AS user_prompt,
           CAST(1000 AS INT) AS max_tokens FROM ({PENDING})"""
ORACLE["jsonl_result_source"] = """
    SELECT CAST(review_id AS VARCHAR) AS custom_id, CAST(status_code AS INT) AS status_code, content FROM v_tr_lines"""
ORACLE["enrichment_csv_sink"] = """
    SELECT CAST(review_id AS VARCHAR) AS review_id, en AS review_comment_message_en FROM v_tr_parsed"""

# --- projections and filters ---
ORACLE["clean_pass_through"] = f"""
    SELECT order_id, order_item_id, product_id, seller_id, {_stamp("shipping_limit_date")}, price, freight_value
    FROM v_items"""
ORACLE["project_columns"] = f"""
    SELECT {REVIEWS}, {_stamp("review_creation_date")}, {_stamp("review_answer_timestamp")} FROM v_staging"""
ORACLE["add_typed_nulls"] = """
    SELECT review_id, order_id, CAST(NULL AS VARCHAR) AS review_comment_message_en,
           CAST(NULL AS VARCHAR) AS review_aspect_scores FROM v_staging"""
ORACLE["filter_null_predicates"] = """
    SELECT review_id, review_comment_message_en FROM v_enriched
    WHERE review_comment_message_en IS NOT NULL AND NOT has_scores"""
ORACLE["filter_negative_scores"] = "SELECT review_id, product_quality_score FROM v_geo WHERE product_quality_score < 0"
TOP_CITIES = "SELECT city, count(*) AS n FROM v_geo WHERE city IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
ORACLE["filter_isin_top"] = f"""
    SELECT review_id, city, product_quality_score FROM v_geo WHERE city IN (SELECT city FROM ({TOP_CITIES}))"""
DRILL = (
    "review_id, review_comment_message_en, product_quality_score, delivery_score, refund_process_score, "
    "customer_service_score, city, product_category_name_en"
)
ORACLE["filter_compound_eq"] = f"""
    SELECT {DRILL} FROM v_geo WHERE product_category_name_en = 'en_economy_1' AND city = 'NATION_3'
    ORDER BY {", ".join(c + " NULLS FIRST" for c in DRILL.split(", "))} LIMIT 20"""
ORACLE["dropna_subset"] = """
    SELECT review_id, order_id, review_comment_title, review_comment_message FROM v_staging
    WHERE review_comment_title IS NOT NULL AND review_comment_message IS NOT NULL"""
ORACLE["cte_reuse"] = """
    WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status, count(*) AS orders
                   FROM orders GROUP BY 1, 2)
    SELECT order_date, order_status, orders FROM daily d
    WHERE orders = (SELECT max(orders) FROM daily x WHERE x.order_date = d.order_date)"""
ORACLE["column_alias"] = "SELECT customer_id AS id, customer_city AS city, customer_state AS state FROM v_customers"

# --- joins ---
ORACLE["left_join_chain"] = """
    SELECT o.order_id, o.customer_id, i.order_item_id, i.price, r.review_id, r.review_score
    FROM v_orders o LEFT JOIN v_items i ON o.order_id = i.order_id LEFT JOIN v_clean r ON o.order_id = r.order_id"""
ORACLE["inner_join_customer"] = """
    SELECT o.order_id, o.customer_id, c.customer_city, c.customer_state
    FROM v_orders o JOIN v_customers c ON o.customer_id = c.customer_id"""
ORACLE["inner_join_review_product"] = """
    SELECT r.review_id, r.order_id, p.product_id, t.product_category_name_english AS product_category_name_en,
           r.review_score
    FROM v_clean r JOIN v_items i ON r.order_id = i.order_id JOIN v_products p ON i.product_id = p.product_id
    JOIN v_translation t ON p.product_category_name = t.product_category_name"""
ORACLE["review_aspect_geo"] = "SELECT * FROM v_geo"
ORACLE["update_from_join"] = """
    SELECT t.review_id, t.order_id, t.review_score,
           CASE WHEN s.review_id IS NULL THEN t.review_comment_title
                WHEN s.review_score > 1 THEN concat('score ', s.review_score) END AS review_comment_title
    FROM v_staging t LEFT JOIN (SELECT review_id, review_score FROM v_clean WHERE review_score <> 3) s
      ON t.review_id = s.review_id"""

# --- aggregations ---
ORACLE["agg_count_column"] = """
    SELECT review_score, count(review_comment_message) AS messages, count(review_comment_title) AS titles
    FROM v_staging GROUP BY 1"""
ORACLE["agg_count_distinct"] = """
    SELECT order_status, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers
    FROM v_orders GROUP BY 1"""
ORACLE["agg_sum"] = """
    SELECT product_id, round(sum(price), 6) AS revenue, round(sum(freight_value), 6) AS freight FROM v_items GROUP BY 1"""
ORACLE["agg_avg"] = """
    SELECT product_id, round(avg(price), 8) AS avg_price, round(avg(freight_value), 8) AS avg_freight FROM v_items GROUP BY 1"""
ORACLE["agg_countif"] = f"""
    SELECT product_category_name_en, {", ".join(f"count(*) FILTER (WHERE {s} < 0) AS negative_{s}" for s in SCORES)}
    FROM v_geo GROUP BY 1"""
ORACLE["agg_ratio"] = """
    SELECT product_id, count(order_item_id) / count(DISTINCT order_id) AS items_per_order FROM v_items GROUP BY 1"""
ORACLE["group_by_expression"] = """
    SELECT CAST(order_purchase_timestamp AS DATE) AS order_date,
           strftime(order_purchase_timestamp, '%Y%m') AS year_month, count(order_id) AS orders
    FROM v_orders GROUP BY 1, 2"""
CELLS = """
    SELECT product_category_name_en, city, count({score}) AS reviews_count, avg({score}) AS avg_score
    FROM v_geo WHERE product_category_name_en IS NOT NULL AND city IS NOT NULL GROUP BY 1, 2"""
ORACLE["group_multi_agg"] = CELLS.format(score="product_quality_score")
ORACLE["pair_frequency"] = """
    SELECT product_quality_score, customer_service_score, count(*) AS count FROM v_geo GROUP BY 1, 2"""
TREND = f"SELECT review_month_date, {', '.join(f'avg({s}) AS {s}' for s in SCORES)} FROM v_geo GROUP BY 1"
ORACLE["trend_by_month"] = TREND

# --- marts ---
ORACLE["agg_sales_daily"] = "SELECT * FROM v_daily"
ORACLE["agg_sales_by_city"] = "SELECT * FROM v_by_city"
ORACLE["agg_aspect_score_by_product"] = f"""
    SELECT p.product_id, t.product_category_name_english AS product_category_name_en,
           CAST(extract(year FROM r.review_answer_timestamp) AS INT) AS review_year,
           CAST(extract(month FROM r.review_answer_timestamp) AS INT) AS review_month,
           CAST(date_trunc('month', r.review_answer_timestamp) AS DATE) AS review_month_date,
           count(r.review_id) AS total_reviews,
           count(*) FILTER (WHERE r.has_scores) AS num_reviews_with_aspect_scores,
           avg(r.review_score) AS avg_review_score,
           {", ".join(f"avg(r.{a}_score) AS avg_{a}_score" for a in ASPECTS)},
           {", ".join(f"count(*) FILTER (WHERE r.{a}_score < 0) AS count_negative_{a}" for a in ASPECTS)}
    FROM v_scored r JOIN v_items i ON r.order_id = i.order_id JOIN v_products p ON i.product_id = p.product_id
    JOIN v_translation t ON p.product_category_name = t.product_category_name
    WHERE r.has_scores GROUP BY 1, 2, 3, 4, 5"""

# --- ranks and deduplication ---
ORACLE["row_number_rank"] = """
    SELECT review_id, order_id, strftime(review_answer_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS answered,
           rr AS review_id_rank, ro AS order_id_rank FROM v_ranked"""
ORACLE["dedup_reviews"] = "SELECT review_id, order_id, review_score FROM v_clean"
ORACLE["clean_order_reviews"] = f"""
    SELECT {REVIEWS}, {_stamp("review_creation_date")}, {_stamp("review_answer_timestamp")},
           CAST(NULL AS VARCHAR) AS review_comment_message_en, CAST(NULL AS VARCHAR) AS review_aspect_scores
    FROM v_clean"""
ORACLE["distinct_first_by_key"] = """
    SELECT review_id, order_id, review_score FROM v_staging
    QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY review_answer_timestamp) = 1"""
ORACLE["last_result_wins"] = """
    SELECT CAST(review_id AS VARCHAR) AS custom_id, content FROM v_tr_lines
    QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY seq DESC) = 1"""

# --- sort and top-k ---
ORACLE["sort_multi_key"] = """
    SELECT order_month, city, state, total_orders FROM v_by_city ORDER BY order_month, city, state"""
ORACLE["limit_batch"] = "SELECT order_id, customer_id FROM v_orders ORDER BY order_id LIMIT 10000"
ORACLE["top_k_frequency"] = f"SELECT city, n AS count FROM ({TOP_CITIES})"
ORACLE["head_n"] = """
    SELECT customer_id, customer_city, customer_state FROM v_customers ORDER BY customer_id LIMIT 5"""

# --- scalar functions ---
ORACLE["fn_date"] = "SELECT event_id, CAST(ts AS DATE) AS day FROM events"
ORACLE["fn_month_trunc"] = """
    SELECT o_orderkey AS order_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders"""
ORACLE["fn_format_yyyymm"] = "SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y%m') AS year_month FROM orders"
ORACLE["fn_extract_year_month"] = """
    SELECT o_orderkey AS order_id, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month
    FROM orders"""
ORACLE["fn_to_datetime"] = """
    SELECT event_id, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS at FROM events"""
ORACLE["fn_cast_double"] = """
    SELECT l_orderkey, l_extendedprice AS price,
           CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS tolerant_price FROM lineitem"""
PADDED = "concat(chr(9), chr(10), '  ', text, ' ', chr(13), chr(10), ' ')"
ORACLE["fn_replace_trim"] = f"SELECT doc_id, {_clean_text(PADDED)} AS text FROM documents"
ORACLE["fn_prompt_template"] = "SELECT doc_id, concat('Customer Review: \"', text, '\"') AS prompt FROM documents"
ORACLE["fn_true_division"] = """
    SELECT p_partkey, CAST(p_partkey AS DOUBLE) / CAST(p_size AS DOUBLE) AS quotient FROM part"""
ORACLE["json_validate"] = """
    SELECT event_id, json_valid(CASE WHEN k % 13 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END) AS is_valid
    FROM v_events"""
ORACLE["json_extract_scores"] = """
    SELECT event_id, k / CAST(4 AS DOUBLE) AS delivery, k + CAST(0.5 AS DOUBLE) AS product_quality,
           CAST(NULL AS DOUBLE) AS customer_service, CAST(NULL AS DOUBLE) AS refund_process,
           CASE WHEN k % 2 = 0 THEN CAST(-1 AS DOUBLE) END AS packaging_condition
    FROM v_events"""
ORACLE["json_build"] = """
    SELECT customer_id, concat('{"city":"', customer_city, '","place":{"customer_state":"', customer_state,
           '","customer_id":', customer_id, '}}') AS document FROM v_customers"""
ORACLE["json_path_result"] = """
    SELECT CAST(review_id AS VARCHAR) AS id, CAST(status_code AS INT) AS status, content FROM v_tr_lines"""

# --- reshape ---
ORACLE["pivot_pair_frequency"] = f"""
    SELECT customer_service_score, {", ".join(
        f'nullif(count(*) FILTER (WHERE product_quality_score = {q / 4}), 0) AS "{q / 4}"' for q in range(-4, 5))}
    FROM v_geo GROUP BY 1"""
CITY_RANKS = f"SELECT city, CAST(row_number() OVER (ORDER BY n DESC, city) AS INT) AS city_rank FROM ({TOP_CITIES})"
CATEGORY_RANKS = """
    SELECT product_category_name_en, CAST(row_number() OVER (ORDER BY n DESC, product_category_name_en) AS INT) AS category_rank
    FROM (SELECT product_category_name_en, count(*) AS n FROM v_geo GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)"""
MASK = "CASE WHEN reviews_count > 5 THEN avg_score END AS avg_score"
ORACLE["pivot_category_city_mean"] = f"""
    SELECT product_category_name_en, city, reviews_count, avg_score, city_rank
    FROM ({CELLS.format(score="product_quality_score")}) JOIN ({CITY_RANKS}) USING (city)"""
ORACLE["pivot_category_city_masked"] = f"""
    SELECT product_category_name_en, city, reviews_count, {MASK}, city_rank
    FROM ({CELLS.format(score="delivery_score")}) JOIN ({CITY_RANKS}) USING (city)"""
ORACLE["pivot_top_both"] = f"""
    SELECT product_category_name_en, city, reviews_count, {MASK}, city_rank, category_rank
    FROM ({CELLS.format(score="customer_service_score")}) JOIN ({CITY_RANKS}) USING (city)
    JOIN ({CATEGORY_RANKS}) USING (product_category_name_en)"""
ORACLE["melt_aspects"] = f"""
    UNPIVOT ({TREND}) ON {", ".join(SCORES)} INTO NAME aspect VALUE score"""


# --- statistics ---
def _long(columns, source="v_geo", value="CAST({c} AS DOUBLE)") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {value.format(c=c)} AS value FROM {source} WHERE {c} IS NOT NULL" for c in columns
    )


def _quantiles(named: dict[str, float], value: str = "value") -> str:
    return ", ".join(f"round(quantile_cont({value}, {p}), 6) AS {n}" for n, p in named.items())


ORACLE["describe_numeric"] = f"""
    SELECT "column", count(*) AS count, round(avg(value), 6) + 0.0 AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
           {_quantiles({"q25": 0.25, "q50": 0.5, "q75": 0.75})}, max(value) AS max
    FROM ({_long(["review_id", *SCORES])}) GROUP BY 1"""


def _histogram(columns, source) -> str:
    return f"""
    WITH long AS ({_long(columns, source)}),
    span AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM long GROUP BY 1),
    counts AS (
      SELECT l."column", CAST(least(floor((value - lo) / ((hi - lo) / 20.0)), 19) AS INT) AS bin, count(*) AS count
      FROM long l JOIN span s ON l."column" = s."column" GROUP BY 1, 2),
    frame AS (SELECT "column", lo, hi, CAST(b AS INT) AS bin FROM span, range(20) t(b))
    SELECT f."column", f.bin, round(lo + f.bin * ((hi - lo) / 20.0), 6) + 0.0 AS bin_start,
           round(lo + (f.bin + 1) * ((hi - lo) / 20.0), 6) + 0.0 AS bin_end, coalesce(c.count, 0) AS count
    FROM frame f LEFT JOIN counts c ON f."column" = c."column" AND f.bin = c.bin"""


ORACLE["histogram_20"] = _histogram(SCORES, "v_geo")
ORACLE["histogram_negative"] = _histogram(
    ["product_quality_score"], "(SELECT * FROM v_geo WHERE product_quality_score < 0)"
)


def _kde_1d(columns, source: str, cut: int) -> str:
    return f"""
    SELECT "column", CAST(i AS INT) AS i, lo + i * ((hi - lo) / 199.0) AS x,
           sum(w * exp(-0.5 * power((lo + i * ((hi - lo) / 199.0) - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
    FROM (SELECT "column", n, h, lo - {cut} * h AS lo, hi + {cut} * h AS hi FROM (
            SELECT "column", CAST(count(*) AS DOUBLE) AS n, stddev_samp(value) * power(count(*), -0.2) AS h,
                   min(value) AS lo, max(value) AS hi FROM ({_long(columns, source)}) GROUP BY 1))
    JOIN (SELECT "column", value, count(*) AS w FROM ({_long(columns, source)}) GROUP BY 1, 2) USING ("column"),
         range(200) t(i)
    GROUP BY 1, 2, 3"""


def _kde_2d(x: str, y: str, source: str) -> str:
    return f"""
    SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, any_value(gx) AS x, any_value(gy) AS y,
           sum(w * exp(-0.5 * (vy * power(gx - px, 2) - 2 * vxy * (gx - px) * (gy - py) + vx * power(gy - py, 2))
                       / (vx * vy - vxy * vxy))) / (any_value(n) * 2 * pi() * sqrt(any_value(vx * vy - vxy * vxy))) AS density
    FROM (
      SELECT *, lox - 3 * sqrt(vx) + i * ((hix - lox + 6 * sqrt(vx)) / 199.0) AS gx,
             loy - 3 * sqrt(vy) + j * ((hiy - loy + 6 * sqrt(vy)) / 199.0) AS gy
      FROM (
        SELECT n, f * f * vx AS vx, f * f * vy AS vy, f * f * vxy AS vxy, lox, hix, loy, hiy FROM (
          SELECT CAST(count(*) AS DOUBLE) AS n, 0.5 * power(count(*), -1.0 / 6) AS f, var_samp({x}) AS vx,
                 var_samp({y}) AS vy, covar_samp({x}, {y}) AS vxy,
                 min({x}) AS lox, max({x}) AS hix, min({y}) AS loy, max({y}) AS hiy FROM {source})),
        (SELECT {x} AS px, {y} AS py, count(*) AS w FROM {source} GROUP BY 1, 2),
        range(200) a(i), range(200) b(j))
    GROUP BY 1, 2"""


PAIR = ("product_quality_score", "customer_service_score")
DENSITY = _kde_2d(*PAIR, "v_geo")
PAIR_NAMES = f"'{PAIR[0]}' AS x_column, '{PAIR[1]}' AS y_column"
ORACLE["kde_1d"] = f"""
    SELECT "column", i, round(x, 6) + 0.0 AS x, round(density, 6) AS density FROM ({_kde_1d(SCORES, "v_geo", 0)})"""
ORACLE["kde_2d"] = f"""
    SELECT {PAIR_NAMES}, i, j, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(density, 6) AS density FROM ({DENSITY})"""
ORACLE["kde_2d_levels"] = f"""
    WITH ranked AS (
      SELECT density, sum(density) OVER (ORDER BY density DESC, i, j ROWS UNBOUNDED PRECEDING) / sum(density) OVER () AS mass
      FROM ({DENSITY})),
    wanted AS (SELECT CAST(l AS INT) AS level, CASE WHEN l = 39 THEN 1.0 ELSE 0.05 + l * (0.95 / 39) END AS proportion
               FROM range(40) t(l))
    SELECT {PAIR_NAMES}, level, round(CAST(proportion AS DOUBLE), 6) AS proportion,
           round((SELECT max(density) FROM ranked WHERE mass >= 1 - CAST(proportion AS DOUBLE)), 6) AS density FROM wanted"""


def _box(source: str, group: str, value: str) -> str:
    return f"""
    WITH top AS (SELECT {group}, count(*) AS n FROM {source} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10),
    kept AS (SELECT {group}, {value} AS v FROM {source} WHERE {group} IN (SELECT {group} FROM top)),
    box AS (SELECT {group}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                   quantile_cont(v, 0.75) AS q3 FROM kept GROUP BY 1),
    placed AS (SELECT *, v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside FROM kept JOIN box USING ({group}))"""


CATEGORY = "product_category_name_en"
ORACLE["box_stats"] = f"""{_box("v_geo", CATEGORY, "product_quality_score").strip()}
    SELECT {CATEGORY}, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median, round(q3, 6) + 0.0 AS q3,
           count(*) AS count, min(v) FILTER (WHERE inside) AS whisker_low, max(v) FILTER (WHERE inside) AS whisker_high,
           count(*) FILTER (WHERE NOT inside) AS outliers FROM placed GROUP BY 1, 2, 3, 4"""
SOLD = """(SELECT o.order_status, round(sum(i.price), 6) AS revenue
    FROM v_orders o JOIN v_items i ON o.order_id = i.order_id GROUP BY o.order_id, o.order_status)"""
ORACLE["box_outliers"] = f"""{_box(SOLD, "order_status", "revenue").strip()}
    SELECT order_status, v AS value, count(*) AS count FROM placed WHERE NOT inside GROUP BY 1, 2"""

GRID = ["product_quality_score", "customer_service_score", "delivery_score"]
BELOW = [(x, y) for k, y in enumerate(GRID) for x in GRID[:k]]
DIAGONAL = f"""
    SELECT "column" AS y_column, "column" AS x_column, 'diagonal' AS panel, round(x, 6) + 0.0 AS x,
           CAST(NULL AS DOUBLE) AS y, round(density, 6) AS value FROM ({_kde_1d(GRID, "v_geo", 3)})"""
ORACLE["pair_grid"] = DIAGONAL + "".join(
    f""" UNION ALL SELECT '{y}', '{x}', 'scatter', round({x}, 6), {y}, CAST(count(*) AS DOUBLE)
    FROM v_geo GROUP BY {x}, {y}"""
    for x, y in BELOW
)
ORACLE["pair_grid_density"] = DIAGONAL + "".join(
    f""" UNION ALL SELECT '{y}', '{x}', 'kde', round(x, 6) + 0.0, round(y, 6) + 0.0, round(density, 6)
    FROM ({_kde_2d(x, y, "v_geo")})"""
    for x, y in BELOW
)

# Columns of the profiled tables: (column, Spark type name, kind).
NUMBER, TEXT, OTHER = "number", "text", "other"
PROFILED = {
    "customers": (
        "v_customers",
        [("customer_id", "bigint", NUMBER), ("customer_city", "string", TEXT), ("customer_state", "string", TEXT)],
    ),
    "orders": (
        "v_orders",
        [
            ("order_id", "bigint", NUMBER),
            ("customer_id", "bigint", NUMBER),
            ("order_status", "string", TEXT),
            ("order_purchase_timestamp", "timestamp_ntz", OTHER),
        ],
    ),
    "order_items": (
        "v_items",
        [
            ("order_id", "bigint", NUMBER),
            ("order_item_id", "int", NUMBER),
            ("product_id", "bigint", NUMBER),
            ("seller_id", "bigint", NUMBER),
            ("shipping_limit_date", "timestamp_ntz", OTHER),
            ("price", "double", NUMBER),
            ("freight_value", "double", NUMBER),
        ],
    ),
    "products": ("v_products", [("product_id", "bigint", NUMBER), ("product_category_name", "string", TEXT)]),
    "order_reviews": (
        "v_staging",
        [
            ("review_id", "bigint", NUMBER),
            ("order_id", "bigint", NUMBER),
            ("review_score", "int", NUMBER),
            ("review_comment_title", "string", TEXT),
            ("review_comment_message", "string", TEXT),
            ("review_creation_date", "timestamp_ntz", OTHER),
            ("review_answer_timestamp", "timestamp_ntz", OTHER),
        ],
    ),
}
COLUMN_QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}


def _profile_column(table: str, view: str, c: str, type_: str, kind: str) -> str:
    def only(wanted: str, expression: str, as_type: str, name: str) -> str:
        return f"{expression if kind == wanted else f'CAST(NULL AS {as_type})'} AS {name}"

    d = f"CAST({c} AS DOUBLE)"
    numbers = [
        (f"min({d})", "min"),
        (f"max({d})", "max"),
        (f"round(avg({d}), 4)", "mean"),
        (f"round(stddev_samp({d}), 4)", "std"),
        (f"round(skewness({d}), 4) + 0.0", "skew"),
        (f"round(kurtosis({d}), 4) + 0.0", "kurtosis"),
        *[(f"round(quantile_cont({d}, {p}), 4)", n) for n, p in COLUMN_QUANTILES.items()],
    ]
    cells = [
        f"'{table}' AS table_name, '{c}' AS \"column\", '{type_}' AS type, count(*) AS rows",
        f"count(*) - count({c}) AS missing, count(DISTINCT {c}) AS \"distinct\"",
        f"(SELECT count(*) FROM (SELECT {c} FROM {view} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) = 1)) AS \"unique\"",
        *[only(NUMBER, e, "DOUBLE", n) for e, n in numbers],
        only(NUMBER, f"count(*) FILTER (WHERE {c} = 0)", "BIGINT", "zeros"),
        only(NUMBER, f"count(*) FILTER (WHERE {c} < 0)", "BIGINT", "negatives"),
        only(TEXT, f"CAST(min(length({c})) AS INT)", "INT", "min_length"),
        only(TEXT, f"CAST(max(length({c})) AS INT)", "INT", "max_length"),
        only(TEXT, f"round(avg(length({c})), 4)", "DOUBLE", "mean_length"),
    ]
    return f"SELECT {', '.join(cells)} FROM {view}"


ORACLE["profile_columns"] = " UNION ALL ".join(
    _profile_column(table, view, *column) for table, (view, columns) in PROFILED.items() for column in columns
)
ORACLE["profile_table"] = " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, CAST(sum(n) AS BIGINT) AS rows, CAST({len(columns)} AS BIGINT) AS columns,
        CAST(sum(n * ({" + ".join(f"CAST({c} IS NULL AS INT)" for c, _, _ in columns)})) AS BIGINT) AS missing_cells,
        count(*) FILTER (WHERE n > 1) AS duplicate_groups,
        CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows
    FROM (SELECT {", ".join(c for c, _, _ in columns)}, count(*) AS n FROM {view} GROUP BY ALL)"""
    for table, (view, columns) in PROFILED.items()
)
ORACLE["profile_top_values"] = " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, '{c}' AS "column", CAST(rank AS INT) AS rank, value, n AS count, n / total AS share
    FROM (SELECT CAST(v AS VARCHAR) AS value, n, total, row_number() OVER (ORDER BY n DESC, v) AS rank
          FROM (SELECT {c} AS v, count(*) AS n, (SELECT count(*) FROM {view}) AS total
                FROM {view} WHERE {c} IS NOT NULL GROUP BY 1)) WHERE rank <= 10"""
    for table, (view, columns) in PROFILED.items()
    for c, _, _ in columns
)
ORACLE["profile_correlations"] = " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS correlation FROM {view}"""
    for table, (view, columns) in PROFILED.items()
    for numbers in [[c for c, _, kind in columns if kind == NUMBER]]
    for i, a in enumerate(numbers)
    for b in numbers[i + 1 :]
)

# --- enrichment ---
ORACLE["pending_translation"] = PENDING
PENDING_SCORING = """
    SELECT review_id, review_comment_message_en FROM v_enriched WHERE review_comment_message_en IS NOT NULL"""
ORACLE["pending_scoring"] = PENDING_SCORING
REQUEST = "CAST(review_id AS VARCHAR) AS custom_id, 'POST' AS method, '/v1/chat/completions' AS url, '{m}' AS model"
ORACLE["translation_requests"] = f"""
    SELECT {REQUEST.format(m=MODEL)}, {_sql_text(TRANSLATION_SYSTEM)} AS system_prompt,
           review_comment_message AS user_prompt, CAST(1000 AS INT) AS max_tokens FROM ({PENDING})"""
ORACLE["aspect_requests"] = f"""
    SELECT {REQUEST.format(m=MODEL)}, {_sql_text(ASPECT_SYSTEM)} AS system_prompt,
           concat('Customer Review: "', review_comment_message_en, '"') AS user_prompt,
           'json_object' AS response_format, CAST(100 AS INT) AS max_tokens FROM ({PENDING_SCORING})"""
ORACLE["translation_results"] = ORACLE["enrichment_csv_sink"]
ORACLE["aspect_results"] = f"""
    SELECT CAST(review_id AS VARCHAR) AS review_id, {", ".join(ASPECTS)}, CAST(NULL AS DOUBLE) AS delivery_speed,
           CAST(0 AS DOUBLE) AS correct_items FROM v_as_parsed"""
ORACLE["apply_model"] = f"""
    SELECT CAST(review_id AS VARCHAR) AS custom_id,
           CAST(CASE WHEN review_id % 11 = 0 THEN 500 ELSE 200 END AS INT) AS status_code,
           concat(CASE WHEN seq = 0 THEN 'EN: ' ELSE 'EN2: ' END, review_comment_message) AS content,
           CAST(seq AS BIGINT) AS seq
    FROM ({PENDING}), (VALUES (0), (1)) s(seq) WHERE seq = 0 OR review_id % 17 = 0"""
ORACLE["merge_translations"] = """
    SELECT c.review_id, c.order_id, p.en AS review_comment_message_en
    FROM v_clean c LEFT JOIN v_tr_parsed p ON c.review_id = p.review_id"""
ORACLE["merge_aspects"] = f"""
    SELECT c.review_id, c.order_id, {", ".join("p." + a for a in ASPECTS)}
    FROM v_clean c LEFT JOIN v_as_parsed p ON c.review_id = p.review_id"""
ENRICHED = f"""
    WITH translated AS (
      SELECT review_id, {_clean_text("concat(CASE WHEN review_id % 17 = 0 THEN 'EN2: ' ELSE 'EN: ' END, review_comment_message)")} AS en
      FROM ({PENDING}) WHERE review_id % 11 <> 0),
    scored AS (
      SELECT review_id, length(concat('Customer Review: "', en, '"')) + CASE WHEN review_id % 17 = 0 THEN 1 ELSE 0 END AS size
      FROM translated WHERE review_id % 13 <> 0 OR review_id % 17 = 0)"""
ORACLE["enrich_reviews"] = f"""{ENRICHED.strip()}
    SELECT c.review_id, t.en AS review_comment_message_en,
           {", ".join(f"(((s.size + 2 * {j}) % 9) - 4) / CAST(4 AS DOUBLE) AS {a}" for j, a in enumerate(ASPECTS))}
    FROM v_clean c LEFT JOIN translated t ON c.review_id = t.review_id LEFT JOIN scored s ON c.review_id = s.review_id"""
ORACLE["batch_outcome"] = """
    SELECT CASE WHEN status_code <> 200 THEN 'failed' WHEN malformed THEN 'malformed' ELSE 'ok' END AS outcome,
           CAST(status_code AS INT) AS status_code, count(*) AS count FROM v_as_lines GROUP BY 1, 2"""
ORACLE["refresh_all_layers"] = f"""{ENRICHED.strip()},
    pairs AS (
      SELECT r.review_id, r.review_answer_timestamp, p.product_id, t.product_category_name_english AS category
      FROM scored s JOIN v_clean r ON s.review_id = r.review_id JOIN v_items i ON r.order_id = i.order_id
      JOIN v_products p ON i.product_id = p.product_id
      JOIN v_translation t ON p.product_category_name = t.product_category_name),
    copied AS ({ORACLE["ingest_all"]})
    SELECT concat('staging.', table_name) AS table_name, rows, digest FROM copied
    UNION ALL SELECT concat('clean.', table_name), rows, NULL FROM copied WHERE table_name <> 'order_reviews'
    UNION ALL SELECT 'clean.order_reviews', count(*), NULL FROM v_clean
    UNION ALL SELECT 'clean.rejected_answers', (SELECT count(*) FROM v_tr_lines WHERE status_code <> 200)
      + (SELECT count(*) FROM translated, (VALUES (0), (1)) x(seq) WHERE (seq = 0 AND review_id % 13 = 0) AND review_id % 11 <> 0), NULL
    UNION ALL SELECT 'clean.rejected_scores', 0, NULL
    UNION ALL SELECT 'clean.order_reviews_aspect_geo', count(*), NULL FROM pairs
    UNION ALL SELECT 'aggregated.agg_sales_daily', count(*), NULL FROM v_daily
    UNION ALL SELECT 'aggregated.agg_sales_by_city', count(*), NULL FROM v_by_city
    UNION ALL SELECT 'aggregated.agg_aspect_score_by_product', count(*), NULL
      FROM (SELECT DISTINCT product_id, category, date_trunc('month', review_answer_timestamp) FROM pairs)"""


def oracle_statements() -> dict[str, str]:
    return {name: _with(sql) for name, sql in ORACLE.items()}
