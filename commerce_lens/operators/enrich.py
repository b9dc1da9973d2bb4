"""Review enrichment: pending rows, model requests, the model call, results, merges."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lens.functions.json_text import json_checked
from commerce_lens.functions.scalars import clean_text, prompt
from commerce_lens.operators.dedup import first_per_key, last_per_key
from commerce_lens.operators.joins import update_from
from commerce_lens.operators.select import limit_batch, pending
from commerce_lens.sources.csv_files import require

# The request format.
METHOD = "POST"
ENDPOINT = "/v1/chat/completions"
MODEL = "gpt-3.5-turbo-0125"
OK = 200

# The translation request.
TRANSLATION_SYSTEM = (
    "You are a translator. Translate the following Portuguese text to English. "
    "Respond with only the translation, no explanations."
)
TRANSLATION_MAX_TOKENS = 1000

# The aspect request.
ASPECT_SYSTEM = """\
You are an aspect-based sentiment evaluator for e-commerce reviews. \
The text you receive will be a single review from a customer.

Task: For each of the following aspects, output a numeric score between -1.0 and +1.0 (inclusive):
1. delivery_speed (Only about shipping speed/time.)
2. product_quality (Only about the item's quality or defects.)
3. customer_service (Only about service reps or support if contact already happened.)
4. refund_process (Only about ease/difficulty of returning or refunding if that already happened.)
5. packaging_condition (Only about how the package arrived (damaged or intact).)

6. correct_items (Only about whether the customer received the right or wrong item.)

• -1.0 = extremely negative
• 0.0 = neutral or not mentioned
• +1.0 = extremely positive

If the review does not mention an aspect, default its score to 0.0.

Output Format: Return only a valid JSON object with these five keys exactly: \
Provide no extra commentary or text."""
ASPECT_USER = ('Customer Review: "', '"')
ASPECT_MAX_TOKENS = 100
ASPECT_RESPONSE_FORMAT = "json_object"

# The prompt asks for delivery_speed, the marts read delivery.
ASPECT_RENAMES = {"delivery_speed": "delivery"}

MODES = ("quarantine", "failfast")


def pending_translation(reviews: DataFrame, n: int | None = None) -> DataFrame:
    """Reviews with a message and no translation; with n, the n lowest ids of them, as one batch."""
    todo = pending(reviews, "review_comment_message", "review_comment_message_en")
    return limit_batch(todo.select("review_id", "review_comment_message"), "review_id", n)


def pending_scoring(reviews: DataFrame, n: int | None = None) -> DataFrame:
    """Translated reviews without scores; with n, the n lowest ids of them, as one batch."""
    todo = pending(reviews, "review_comment_message_en", "review_aspect_scores")
    return limit_batch(todo.select("review_id", "review_comment_message_en"), "review_id", n)


def build_requests(
    df: DataFrame,
    text: str,
    system: str,
    max_tokens: int,
    user: tuple[str, str] = ("", ""),
    response_format: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """One flat request row per distinct review id. Of ids that are known to be unique no text is shuffled."""
    distinct = df if unique else first_per_key(df, "review_id", [text])
    return distinct.select(
        F.col("review_id").cast("string").alias("custom_id"),
        F.lit(METHOD).alias("method"),
        F.lit(ENDPOINT).alias("url"),
        F.lit(MODEL).alias("model"),
        F.lit(system).alias("system_prompt"),
        prompt(user[0], text, user[1]).alias("user_prompt"),
        F.lit(response_format).cast("string").alias("response_format"),
        F.lit(max_tokens).alias("max_tokens"),
    )


def translation_requests(df: DataFrame, unique: bool = False) -> DataFrame:
    return build_requests(df, "review_comment_message", TRANSLATION_SYSTEM, TRANSLATION_MAX_TOKENS, unique=unique)


def aspect_requests(df: DataFrame, unique: bool = False) -> DataFrame:
    return build_requests(
        df, "review_comment_message_en", ASPECT_SYSTEM, ASPECT_MAX_TOKENS, ASPECT_USER, ASPECT_RESPONSE_FORMAT, unique
    )


def request_documents(requests: DataFrame) -> DataFrame:
    """Flat requests in the nested shape of a request line; an absent format is left out."""
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.col("system_prompt").alias("content")),
        F.struct(F.lit("user").alias("role"), F.col("user_prompt").alias("content")),
    )
    response_format = F.when(
        F.col("response_format").isNotNull(), F.struct(F.col("response_format").alias("type"))
    )
    return requests.select(
        "custom_id",
        "method",
        "url",
        F.struct(
            "model",
            messages.alias("messages"),
            response_format.alias("response_format"),
            "max_tokens",
        ).alias("body"),
    )


def apply_model(
    df: DataFrame, open_model: Callable[[], Callable[[Any], Any]], schema: str, tasks: int | None = None, spread: bool = False
) -> DataFrame:
    """Run a model over every row.

    open_model() is called once per task and returns a function from one pandas batch to
    another. Rows are spread by id first, since calls cost far more than rows; `tasks` caps how many
    calls run at a time (by default Spark's shuffle partitions, so that the work is cut as finely as any other). Rows that are
    `spread` already, over many files, stay where they are.
    """

    def run(batches):
        model = open_model()
        for batch in batches:
            yield model(batch)

    if tasks:
        df = df.repartition(tasks, "custom_id")
    elif not spread:
        df = df.repartition("custom_id")
    return df.mapInPandas(run, schema)


def apply_model_by(
    df: DataFrame, key: str, open_model: Callable[[], Callable[[Any], Any]], schema: str, tasks: int | None = None
) -> DataFrame:
    """apply_model over groups that a model must not mix: open_model() is called once per value of key, which no batch goes beyond."""

    def run(batches):
        model, now = None, None
        for batch in batches:
            for value, part in batch.groupby(key, sort=True):
                if model is None or value != now:
                    model, now = open_model(), value
                yield model(part.drop(columns=key).reset_index(drop=True))

    spread = df.repartition(tasks, key) if tasks else df.repartition(key)
    return spread.sortWithinPartitions(key, "custom_id").mapInPandas(run, schema)


def _ok(results: DataFrame, mode: str) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "failfast":
        message = F.concat(F.lit("result without a response: "), F.col("line"))
        complete = F.col("status_code").isNotNull() & (
            (F.col("status_code") != OK) | F.col("content").isNotNull()
        )
        # In the column, so that no filter on the status can run before the check.
        results = results.withColumn("status_code", F.when(complete, F.col("status_code")).otherwise(F.raise_error(message)))
    return results.where((F.col("status_code") == OK) & F.col("content").isNotNull())


def parse_translations(results: DataFrame, mode: str = "quarantine") -> DataFrame:
    """(review_id, review_comment_message_en) of the successful results, the last per id.

    "failfast" stops at a result without a response; "quarantine" leaves it to quarantined().
    """
    last = last_per_key(_ok(results, mode), "custom_id", "seq")
    return last.select(
        F.col("custom_id").alias("review_id"), clean_text("content").alias("review_comment_message_en")
    )


def translations_for(reviews: DataFrame, results: DataFrame, mode: str = "quarantine") -> DataFrame:
    """parse_translations() with ids of the type that the reviews' have, dealt by them: a merge shuffles no text again.

    Ids of results that are written differently and are the same id of a review are an error, as they are to a merge.
    """
    ok = _like_target(_ok(results, mode).withColumn("review_id", F.col("custom_id")), reviews)
    # In a struct, so that a result without a seq comes first and isn't left out.
    last = ok.groupBy("review_id").agg(
        F.max_by("content", F.struct("seq")).alias("content"), F.min("custom_id").alias("_low"), F.max("custom_id").alias("_high")
    )
    message = F.concat(F.lit("more than one update for review_id "), F.col("review_id").cast("string"))
    checked = last.where((F.col("_low") == F.col("_high")) | F.raise_error(message).cast("boolean"))
    return checked.select("review_id", clean_text("content").alias("review_comment_message_en"))


def _swap(old: str, new: str) -> Callable[[Column, Column], Column]:
    return lambda key, _: F.when(key == old, F.lit(new)).otherwise(key)


def rename_keys(c: str, renames: Mapping[str, str]) -> Column:
    """JSON text in compact form, with top-level keys renamed unless the new key exists."""
    plain = F.to_json(F.try_parse_json(c))
    if not renames:
        return plain
    fields = F.from_json(c, "map<string,variant>", {"mode": "PERMISSIVE"})
    renamed = fields
    for old, new in renames.items():
        present = F.map_contains_key(fields, F.lit(old)) & ~F.map_contains_key(fields, F.lit(new))
        renamed = F.when(present, F.transform_keys(renamed, _swap(old, new))).otherwise(renamed)
    is_object = F.ltrim(c).startswith("{")
    return F.when(is_object & fields.isNotNull(), F.to_json(renamed)).otherwise(plain)


def parse_aspects(
    results: DataFrame, mode: str = "quarantine", rename: Mapping[str, str] = ASPECT_RENAMES
) -> DataFrame:
    """(review_id, review_aspect_scores) of the successful results, the last per id.

    Content must be JSON: "failfast" stops at anything else, "quarantine" leaves it out.
    rename={} keeps the keys as the model wrote them.
    """
    ok = _ok(results, mode).withColumn("content", json_checked("content", tolerant=mode == "quarantine"))
    last = last_per_key(ok.where(F.col("content").isNotNull()), "custom_id", "seq")
    return last.select(
        F.col("custom_id").alias("review_id"), rename_keys("content", rename).alias("review_aspect_scores")
    )


def result_outcome(json_content: bool) -> Column:
    """ok, failed (another status), no_response or malformed."""
    bad = F.try_parse_json("content").isNull() if json_content else F.lit(False)
    return (
        F.when(F.col("status_code").isNull() , F.lit("no_response"))
        .when(F.col("status_code") != OK, F.lit("failed"))
        .when(F.col("content").isNull(), F.lit("no_response"))
        .when(bad, F.lit("malformed"))
        .otherwise(F.lit("ok"))
    )


def batch_outcome(results: DataFrame, json_content: bool = True) -> DataFrame:
    """Number of result lines per outcome and status."""
    return (
        results.select(result_outcome(json_content).alias("outcome"), "status_code")
        .groupBy("outcome", "status_code")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def quarantined(results: DataFrame, json_content: bool = True) -> DataFrame:
    """Result lines that give no answer, with the reason."""
    outcome = results.withColumn("outcome", result_outcome(json_content))
    return outcome.where("outcome <> 'ok'").select("custom_id", "status_code", "outcome", "line")


def _like_target(parsed: DataFrame, reviews: DataFrame) -> DataFrame:
    """Parsed ids are text; give them the type of the table's id."""
    return require(parsed, ["review_id"]).withColumn(
        "review_id", F.col("review_id").cast(reviews.schema["review_id"].dataType)
    )


def merge_translations(reviews: DataFrame, parsed: DataFrame, typed: bool = False) -> DataFrame:
    """Translations by review id; `typed` are those of translations_for(), whose ids need no further look."""
    source = parsed if typed else _like_target(parsed, reviews)
    return update_from(reviews, source, "review_id", ["review_comment_message_en"])


def merge_aspects(reviews: DataFrame, parsed: DataFrame) -> DataFrame:
    """Scores by review id; the text must be well-formed JSON."""
    text = F.col("review_aspect_scores")
    checked = parsed.where(text.isNull() | json_checked(text).isNotNull())
    return update_from(reviews, _like_target(checked, reviews), "review_id", ["review_aspect_scores"])
