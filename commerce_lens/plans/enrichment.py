"""Both enrichment phases over the cleaned reviews."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from commerce_lens.operators.enrich import (
    apply_model,
    apply_model_by,
    aspect_requests,
    merge_aspects,
    merge_translations,
    parse_aspects,
    pending_scoring,
    pending_translation,
    quarantined,
    translation_requests,
    translations_for,
)
from commerce_lens.operators.dedup import rank_in
from commerce_lens.operators.joins import update_from
from commerce_lens.session import cut_lineage, discard, is_complete, scratch_path
from commerce_lens.sources.jsonl import expand_results
from commerce_lens.sources.schemas import ENRICHMENT_COLUMNS

# What a model returns per request: a result document, and its place among the results.
MODEL_OUTPUT = "line string, seq long"
# Runs of the model in flight: one alone leaves cores idle while its last requests are answered.
RUNS_AT_ONCE = 4
# Jobs that answer all runs, at most: with more runs than that, a job answers several of them, each by itself.
MOST_JOBS = 100
# Requests in a file, at most: what is read as it is stored is cut as finely.
REQUESTS_A_FILE = 1000


def deal_runs(requests: DataFrame, n: int | None, folder: str) -> int:
    """Store the requests under folder by the number of their run; returns how many runs there are.

    One ranking by id, over ranges, tells every request its run, and a run is a folder of its own: it is read alone, whatever the
    number of runs. Without n all requests are one run. Requests that are there already stay as they are.
    """
    spark, path = requests.sparkSession, f"{folder}/requests"
    schema = requests.schema
    if not is_complete(spark, path):
        placed = requests.withColumn("_place", F.lit(1))
        if n:
            stored = cut_lineage(requests.withColumn("_all", F.lit(0)), "requests")
            placed = rank_in(stored, {"_place": ("_all", ["custom_id", "user_prompt"])})
        run = F.expr(f"CAST((_place - 1) div {n or 1} AS int)")
        written = placed.select(*schema.names, run.alias("run")).write.mode("overwrite").option("maxRecordsPerFile", REQUESTS_A_FILE)
        written.partitionBy("run").parquet(path)
    dealt = spark.read.schema(schema).parquet(path).count()  # known to the files' footers
    return -(-dealt // n) if n else min(dealt, 1)


def run_batches(
    requests: DataFrame,
    open_model: Callable,
    tasks: int | None,
    n: int | None,
    label: str,
    folder: str | None = None,
    paths: list[str] | None = None,
) -> DataFrame:
    """Result rows for all requests; with n, in runs of n requests each, in order of their ids.

    Answers are written before they are read, so a lost executor costs a re-read, not a second call of the model. Every request is answered once, so a request that fails doesn't keep the runs going. The answers of all runs land in one
    folder. With `folder`, requests and answers are kept there: after a lost driver the same call goes on with the first job
    that has no complete answers, and what finished jobs answered is not paid for again. A job is one run; with more than
    MOST_JOBS runs it is several in a row, dealt over its tasks, and the model is opened for each of them. Without `folder`,
    requests go once they are answered, and the answers' own folder is added to `paths`, for discard().
    """
    spark, schema, kept = requests.sparkSession, requests.schema, folder
    folder = folder or scratch_path(spark, label)

    def answer(runs: range) -> None:
        # Named by its first run.
        answers = f"{folder}/answers/run={runs[0]}"
        if not is_complete(spark, answers):
            own = [f"{folder}/requests/run={run}" for run in runs]
            if len(runs) == 1:
                # All requests in one run lie in as many files as they need.
                answered = apply_model(spark.read.schema(schema).parquet(*own), open_model, MODEL_OUTPUT, tasks, spread=not n)
            else:
                numbered = spark.read.schema(f"{_ddl(schema)}, run int").option("basePath", f"{folder}/requests").parquet(*own)
                answered = apply_model_by(numbered, "run", open_model, MODEL_OUTPUT, tasks)
            answered.write.mode("overwrite").parquet(answers)

    runs = deal_runs(requests, n, folder)
    size = max(1, -(-runs // MOST_JOBS))
    with ThreadPoolExecutor(RUNS_AT_ONCE) as pool:
        list(pool.map(answer, [range(i, min(i + size, runs)) for i in range(0, runs, size)]))
    if not kept:
        discard(spark, [f"{folder}/requests"])
        if paths is not None:
            paths.append(folder)
    if not is_complete(spark, f"{folder}/answers/run=0"):
        return expand_results(spark.createDataFrame([], MODEL_OUTPUT))
    return expand_results(spark.read.schema(MODEL_OUTPUT).parquet(f"{folder}/answers").drop("run"))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def unique_ids(reviews: DataFrame) -> bool:
    """Whether no review id comes twice, NULL being an id. Only ids are read."""
    repeated = reviews.groupBy("review_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return not repeated.limit(1).count()


def carry_over(clean: DataFrame, previous: DataFrame) -> DataFrame:
    """Answers of an earlier version of the table, so that only new reviews are pending."""
    columns = list(ENRICHMENT_COLUMNS)
    return update_from(clean, previous.select("review_id", *columns), "review_id", columns)


def enrich_with_rejects(
    reviews: DataFrame,
    open_translator: Callable,
    open_scorer: Callable,
    n: int | None = None,
    tasks: int | None = None,
    mode: str = "quarantine",
    stored: bool = False,
    folder: str | None = None,
    paths: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Translate all that is untranslated, then score all that is translated and unscored.

    Returns the reviews, and (phase, custom_id, status_code, outcome, line) of the answers that were of no use. `n` is how
    many requests one run of the model gets, not a limit on the result. With `folder`, a call that was cut off goes on
    where it was, see run_batches(). The reviews are read more than once, so they are written out first unless they come
    from a stored table. The folders of copies that both results read are added to `paths`, for discard().
    """
    base = reviews if stored else cut_lineage(reviews, "reviews", paths)
    kept = {phase: f"{folder}/{phase}" if folder else None for phase in ("translations", "aspects")}
    todo = pending_translation(base)
    requests = translation_requests(todo, unique_ids(todo))
    answers = run_batches(requests, open_translator, tasks, n, "translations", kept["translations"], paths)
    # Read from the answers by each phase: scoring reads no message, and the reviews take both answers in one go.
    translations = translations_for(base, answers, mode)
    slim = base.select("review_id", "review_comment_message_en", "review_aspect_scores")
    requests = aspect_requests(pending_scoring(merge_translations(slim, translations, typed=True)))
    scores = run_batches(requests, open_scorer, tasks, n, "aspects", kept["aspects"], paths)
    rejects = [
        quarantined(results, json_content).select(F.lit(phase).alias("phase"), "*")
        for phase, results, json_content in (("translation", answers, False), ("aspects", scores, True))
    ]
    merged = merge_aspects(merge_translations(base, translations, typed=True), parse_aspects(scores, mode))
    return merged, rejects[0].unionByName(rejects[1])


def enrich_reviews(
    reviews: DataFrame,
    open_translator: Callable,
    open_scorer: Callable,
    n: int | None = None,
    tasks: int | None = None,
    mode: str = "quarantine",
    stored: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """The reviews of enrich_with_rejects()."""
    return enrich_with_rejects(reviews, open_translator, open_scorer, n, tasks, mode, stored, folder)[0]
