"""The commerce tables as views over the test tables, and stand-ins for model answers."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lens.functions.json_text import ASPECTS
from commerce_lens.functions.scalars import clean_text
from commerce_lens.operators.clean import add_typed_nulls, clean_order_reviews
from commerce_lens.operators.dedup import dedup_reviews
from commerce_lens.operators.joins import review_aspect_geo
from commerce_lens.session import configure, cut_lineage
from commerce_lens.sources.jsonl import expand_results
from commerce_lens.sources.schemas import REVIEW_COLUMNS


class Views:
    """Commerce tables derived from the parquet tables of one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def customers(self) -> DataFrame:
        places = self.raw("nation").join(self.raw("region"), F.expr("n_regionkey = r_regionkey"))
        return (
            self.raw("customer")
            .join(places, F.expr("c_nationkey = n_nationkey"))
            .selectExpr("c_custkey AS customer_id", "n_name AS customer_city", "r_name AS customer_state")
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "o_orderstatus AS order_status",
            "o_orderdate AS order_purchase_timestamp",
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS order_item_id",
            "l_partkey AS product_id",
            "l_suppkey AS seller_id",
            "l_shipdate AS shipping_limit_date",
            "l_extendedprice AS price",
            "l_quantity AS freight_value",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").selectExpr("p_partkey AS product_id", "concat(p_type, '_', p_size % 4) AS product_category_name")

    @cached_property
    def translation(self) -> DataFrame:
        """English names per category. The PROMO ones have none, so inner joins drop them."""
        return (
            self.products.where("product_category_name NOT LIKE 'PROMO%'")
            .select("product_category_name")
            .distinct()
            .withColumn("product_category_name_english", F.concat(F.lit("en_"), F.lower("product_category_name")))
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return self.raw("supplier").selectExpr("s_suppkey AS seller_id", "s_name AS seller_name")

    @cached_property
    def payments(self) -> DataFrame:
        return self.raw("orders").selectExpr("o_orderkey AS order_id", "o_totalprice AS payment_value")

    @cached_property
    def geolocation(self) -> DataFrame:
        return self.raw("nation").selectExpr("n_nationkey AS geolocation_id", "n_name AS geolocation_city")

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))

    @cached_property
    def staging_scores_with_k(self) -> DataFrame:
        """Reviews without text. Ids repeat in chains and creation dates tie."""
        return self.events.selectExpr(
            "event_id - CASE WHEN event_id % 10 = 8 OR event_id % 12 = 4 THEN 1 ELSE 0 END AS review_id",
            "event_id - CASE WHEN event_id % 4 = 3 THEN 1 ELSE 0 END AS order_id",
            "1 + k % 5 AS review_score",
            "CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) AS review_creation_date",
            "ts + make_dt_interval(cast(event_id % 24 * 30 AS int)) AS review_answer_timestamp",
            "k",
            "event_id",
            "event_type",
        )

    @cached_property
    def staging_with_k(self) -> DataFrame:
        """Reviews with title and message; documents hold at most one text per review."""
        documents = self.raw("documents").select("doc_id", "text")
        return self.staging_scores_with_k.join(documents, F.expr("doc_id = event_id"), "left").selectExpr(
            "review_id",
            "order_id",
            "review_score",
            "CASE WHEN k % 3 = 0 THEN event_type END AS review_comment_title",
            "text AS review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
            "k",
        )

    @cached_property
    def staging_reviews(self) -> DataFrame:
        return self.staging_with_k.select(*REVIEW_COLUMNS)

    @cached_property
    def reviews(self) -> DataFrame:
        """Cleaned reviews, nothing enriched."""
        return clean_order_reviews(self.staging_reviews)

    @cached_property
    def review_scores(self) -> DataFrame:
        """Cleaned reviews without their text, for queries that do not read it.

        Deduplication breaks ties by every column it is given, so the text is left out
        before it, not after.
        """
        return dedup_reviews(self.staging_scores_with_k.drop("k", "event_id", "event_type"))

    def _scored(self, staging: DataFrame) -> DataFrame:
        """Deduplicated rows with stand-in scores, quarters between -1 and 1 with exact sums; no score settles another."""
        score = {a: (((F.col("k") + j * F.col("review_id")) % 9) - 4).cast("double") / 4 for j, a in enumerate(ASPECTS)}
        document = F.to_json(F.struct(*[e.alias(a) for a, e in score.items()]))
        return dedup_reviews(staging).withColumn("review_aspect_scores", F.when(F.col("k") % 4 != 0, document))

    @cached_property
    def scored_reviews(self) -> DataFrame:
        """Cleaned reviews with stand-in answers: every message translated, most rows scored."""
        scored = self._scored(self.staging_with_k)
        return scored.select(
            *REVIEW_COLUMNS,
            stand_in_translation("review_comment_message").alias("review_comment_message_en"),
            "review_aspect_scores",
        )

    @cached_property
    def aspect_scores(self) -> DataFrame:
        """The scored reviews without any text but their scores."""
        scored = self._scored(self.staging_scores_with_k.drop("event_id", "event_type"))
        return scored.withColumn("review_comment_message_en", F.lit(None).cast("string"))

    @cached_property
    def translated_reviews(self) -> DataFrame:
        """Cleaned reviews, translated and not scored."""
        reviews = self.scored_reviews.drop("review_aspect_scores")
        return add_typed_nulls(reviews, {"review_aspect_scores": "string"})

    def _geo(self, reviews: DataFrame) -> DataFrame:
        return review_aspect_geo(
            reviews, self.items, self.products, self.translation, self.orders, self.customers
        )

    @cached_property
    def geo(self) -> DataFrame:
        """The scored review fact without its text."""
        return self._geo(self.aspect_scores).drop("review_comment_message_en")

    @cached_property
    def geo_table(self) -> DataFrame:
        """The fact as a stored table, for operators that read it more than once."""
        return cut_lineage(self.geo, "geo")

    @cached_property
    def geo_with_text(self) -> DataFrame:
        return self._geo(self.scored_reviews)

    @cached_property
    def translation_results(self) -> DataFrame:
        """Stand-in result lines for a translation batch: one request per cleaned message."""
        messages = self.reviews.where("review_comment_message IS NOT NULL")
        first = F.concat(F.lit("\n EN: "), F.col("review_comment_message"), F.lit("\n"))
        later = F.concat(F.lit("EN2: "), F.col("review_comment_message"))
        return self._result_lines(messages, first, later)

    @cached_property
    def aspect_results(self) -> DataFrame:
        """Stand-in result lines for an aspect batch: one request per scored review."""
        scored = dedup_reviews(self.staging_scores_with_k.drop("event_id", "event_type")).where("k % 4 <> 0")

        def document(shift: int):
            keys = ("delivery_speed", *ASPECTS[1:])
            cells = [
                (((F.col("k") + shift + 2 * j) % 9 - 4).cast("double") / 4).alias(key) for j, key in enumerate(keys)
            ]
            return F.to_json(F.struct(*cells, F.lit(0.0).alias("correct_items")))

        first = F.when(F.col("review_id") % 13 == 0, F.lit('{"delivery_speed": ')).otherwise(document(0))
        return self._result_lines(scored, first, document(1))

    def _result_lines(self, reviews: DataFrame, first, later) -> DataFrame:
        """Status 500 for every 11th id, and a second, later answer for every 17th."""
        status = F.when(F.col("review_id") % 11 == 0, 500).otherwise(200)
        answers = F.when(
            F.col("review_id") % 17 == 0,
            F.array(
                F.struct(F.lit(0).cast("long").alias("seq"), first.alias("content")),
                F.struct(F.lit(1).cast("long").alias("seq"), later.alias("content")),
            ),
        ).otherwise(F.array(F.struct(F.lit(0).cast("long").alias("seq"), first.alias("content"))))
        each = reviews.select("review_id", status.alias("status"), F.explode(answers).alias("a"))
        message = F.struct(F.struct(F.col("a.content").alias("content")).alias("message"))
        response = F.struct(
            F.col("status").alias("status_code"), F.struct(F.array(message).alias("choices")).alias("body")
        )
        line = F.to_json(
            F.struct(F.col("review_id").cast("string").alias("custom_id"), response.alias("response"))
        )
        return expand_results(each.select(line.alias("line"), F.col("a.seq").alias("seq")))

    def sources(self) -> dict[str, DataFrame]:
        """The nine source tables."""
        return {
            "customers": self.customers,
            "geolocation": self.geolocation,
            "order_items": self.items,
            "order_payments": self.payments,
            "order_reviews": self.staging_reviews,
            "orders": self.orders,
            "products": self.products,
            "sellers": self.sellers,
            "product_category_name_translation": self.translation,
        }


def stand_in_translation(message: str):
    return clean_text(F.concat(F.lit("EN: "), F.col(message)))


def _opener(answer):
    """A model that answers with result lines: failures and repeats as in _result_lines.

    answer(number, text, seq) gives the content. The functions refer to nothing outside
    themselves, so executors need not import this package.
    """

    def open_model():
        import json

        import pandas as pd

        def run(batch):
            rows = []
            for custom_id, text in zip(batch["custom_id"], batch["user_prompt"]):
                number = int(custom_id)
                for seq in range(2 if number % 17 == 0 else 1):
                    message = {"message": {"content": answer(number, text, seq)}}
                    response = {"status_code": 500 if number % 11 == 0 else 200, "body": {"choices": [message]}}
                    rows.append((json.dumps({"custom_id": custom_id, "response": response}), seq))
            return pd.DataFrame(rows, columns=["line", "seq"])

        return run

    return open_model


def stand_in_translator():
    """Marks the text instead of translating it."""

    def answer(number, text, seq):
        return f"{'EN' if seq == 0 else 'EN2'}: {text}"

    return _opener(answer)


def stand_in_scorer():
    """Derives scores from the length of the prompt; every 13th first answer is malformed."""
    keys = ("delivery_speed", *ASPECTS[1:])

    def answer(number, text, seq):
        import json

        if seq == 0 and number % 13 == 0:
            return '{"delivery_speed": '
        scores = {key: ((len(text) + seq + 2 * j) % 9 - 4) / 4 for j, key in enumerate(keys)}
        return json.dumps(scores | {"correct_items": 0.0})

    return _opener(answer)
