"""What a refresh leaves on disk and how often it moves texts."""

import json
import os
import re

import pytest

from commerce_lens.catalog.fixtures import Views, stand_in_scorer, stand_in_translator
from commerce_lens.catalog.queries import _write_sources
from commerce_lens.operators import enrich
from commerce_lens.operators.joins import review_aspect_geo
from commerce_lens.plans import enrichment
from commerce_lens.plans.refresh import refresh
from commerce_lens.session import scratch_root, shuffles_deleted
from commerce_lens.sources.ingest import ingest, source_spec
from commerce_lens.sources.jsonl import expand_results
from tests.conftest import rows


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.split("\n") if os.path.basename(f).startswith("shuffle_")}


def exchanges(df, column=None):
    """Shuffles of the plan, or those whose rows hold the column."""
    node = df._jdf.queryExecution().executedPlan()
    todo, found = [node.initialPlan() if "Adaptive" in node.nodeName() else node], 0
    while todo:
        node = todo.pop()
        names = [re.sub(r"#.*", "", x) for x in node.output().mkString("\n").split("\n")]
        found += node.nodeName() == "Exchange" and (column is None or column in names)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def scratch_folders(spark):
    root = re.sub("^file:", "", scratch_root(spark))
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def line(id_, content, status=200):
    body = {"choices": [{"message": {"content": content}}]}
    return json.dumps({"custom_id": id_, "response": {"status_code": status, "body": body}})


def test_shuffles_go_with_their_job(spark, tmp_path):
    made = spark.range(20_000).selectExpr("id * 7919 % 997 AS k").groupBy("k").count()
    before = shuffle_files(spark)
    with shuffles_deleted(spark):
        made.write.parquet(str(tmp_path / "a"))
    assert not shuffle_files(spark) - before
    made.select("*").write.parquet(str(tmp_path / "b"))
    assert shuffle_files(spark) - before  # as it was outside
    assert rows(spark.read.parquet(str(tmp_path / "a"))) == rows(spark.read.parquet(str(tmp_path / "b")))


CSV = {
    "customers": ("customer_id bigint, customer_city string, customer_state string", ["1,Ro,S"]),
    "geolocation": ("geolocation_id bigint, geolocation_city string", ["1,Ro"]),
    "order_items": (
        "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, shipping_limit_date timestamp_ntz, price double, freight_value double",
        [f"{o},{i},{1 + i % 2},1,2024-01-02 00:00:00,2.5,1" for o in range(1, 9) for i in (1, 2)],
    ),
    "order_payments": ("order_id bigint, payment_value double", ["1,5"]),
    "order_reviews": (
        "review_id bigint, order_id bigint, review_score int, review_comment_title string, review_comment_message string, "
        "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
        [f'{r},{r},{1 + r % 5},,"text\n{r}",2024-01-0{r} 00:00:00,2024-01-0{r} 01:00:00' for r in range(1, 9)],
    ),
    "orders": (
        "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp_ntz",
        [f"{o},1,F,2024-01-01 00:00:00" for o in range(1, 9)],
    ),
    "products": ("product_id bigint, product_category_name string", ["1,a", "2,b"]),
    "sellers": ("seller_id bigint, seller_name string", ["1,s"]),
    "product_category_name_translation": ("product_category_name string, product_category_name_english string", ["a,A", "b,B"]),
}


def specs(folder):
    for name, (schema, lines) in CSV.items():
        path = folder / f"{name}.csv"
        header = ",".join(c.split()[0] for c in schema.split(", "))
        path.write_text("\n".join([header, *lines]) + "\n")
        yield source_spec(name, str(path), schema=schema)


@pytest.mark.parametrize("n", [None, 3])
def test_a_refresh_leaves_no_copies_of_texts_and_no_shuffles(spark, tmp_path, n):
    folders, shuffles = scratch_folders(spark), shuffle_files(spark)
    tables = refresh(spark, specs(tmp_path), str(tmp_path / "t"), stand_in_translator(), stand_in_scorer(), n=n)
    left = {re.sub("_[0-9a-f]{32}$", "", f) for f in scratch_folders(spark) - folders}
    assert not left & {"translations", "aspects", "translated"}
    assert not shuffle_files(spark) - shuffles
    got = rows(tables["clean.order_reviews"], "review_id", "review_comment_message", "review_comment_message_en")
    assert got == [(r, f"text\n{r}", f"EN: text {r}") for r in range(1, 9)]
    assert tables["clean.order_reviews_aspect_geo"].count() == 16


def test_kept_answers_outlast_the_refresh(spark, tmp_path):
    answers = tmp_path / "answers"
    refresh(spark, specs(tmp_path), str(tmp_path / "t"), stand_in_translator(), stand_in_scorer(), answers=str(answers))
    for phase in ("translations", "aspects"):
        assert (answers / phase / "requests" / "_SUCCESS").exists() and (answers / phase / "answers" / "run=0" / "_SUCCESS").exists()


def test_a_source_goes_once_it_is_staged(spark, tmp_path):
    seen = []

    def watched():
        for spec in _write_sources(Views(spark, "/root/testdata/sf0.001")):
            seen.append(re.sub("^file:", "", spec.path))
            assert [os.path.isdir(p) for p in seen] == [False] * (len(seen) - 1) + [True]
            yield spec

    tables = ingest(spark, watched(), str(tmp_path / "t"))
    assert len(tables) == 9 and not any(map(os.path.exists, seen))
    assert tables["products"].count() == Views(spark, "/root/testdata/sf0.001").products.count()


def test_requests_of_unique_ids_and_their_answers_shuffle_no_text(spark, tmp_path, no_broadcast):
    made = spark.range(2500).selectExpr("id * 7 % 2503 AS review_id", "concat('t', id) AS review_comment_message")
    assert enrichment.unique_ids(made)
    requests = enrich.translation_requests(made, unique=True)
    assert exchanges(requests, "review_comment_message") == 0 and exchanges(enrich.translation_requests(made), "review_comment_message") == 1
    assert rows(requests) == rows(enrich.translation_requests(made))
    folder = str(tmp_path / "runs")
    answers = enrichment.run_batches(requests, stand_in_translator(), None, None, "x", folder)
    assert answers.select("custom_id").distinct().count() == 2500
    files = [f for f in os.listdir(f"{folder}/requests/run=0") if f.startswith("part-")]
    assert len(files) >= 3  # so that many tasks read them
    stored = spark.read.schema(requests.schema).parquet(f"{folder}/requests/run=0")
    assert exchanges(enrich.apply_model(stored, stand_in_translator(), "line string, seq long", spread=True), "user_prompt") == 0


def test_ids_that_repeat_are_no_unique_ids(frame):
    schema = "review_id long, review_comment_message string"
    assert enrichment.unique_ids(frame(schema, (1, "a"), (None, "b")))
    assert not enrichment.unique_ids(frame(schema, (1, "a"), (1, "b")))
    assert not enrichment.unique_ids(frame(schema, (None, "a"), (None, "b")))


def test_translations_for_merges_as_parse_translations(frame, no_broadcast):
    reviews = frame("review_id long, review_comment_message_en string", *[(i, None) for i in range(6)], (None, "x"))
    lines = [line("1", "one"), line("2", "fails", 500), line("1", "\n one\nmore"), line("3", "three"), line("9", "nobody's"), line("3", "late", 500)]
    results = expand_results(frame("line string, seq long", *[(x, i) for i, x in enumerate(lines)], (line("4", "no seq"), None), (line("4", "seq"), 1)))
    typed = enrich.translations_for(reviews, results)
    assert rows(typed) == [(1, "one more"), (3, "three"), (4, "seq"), (9, "nobody's")]
    merged = enrich.merge_translations(reviews, typed, typed=True)
    parsed = enrich.merge_translations(reviews, enrich.parse_translations(results))
    assert rows(merged) == rows(parsed)
    # The answers are dealt by id and not again to be merged; the other one is of the reviews.
    assert (exchanges(merged), exchanges(parsed)) == (2, 3)
    twice = expand_results(frame("line string, seq long", (line("1", "a"), 0), (line("01", "b"), 1)))
    for bad, typed in ((enrich.translations_for(reviews, twice), True), (enrich.parse_translations(twice), False)):
        with pytest.raises(Exception, match="more than one update for review_id 1"):
            enrich.merge_translations(reviews, bad, typed).collect()
    nobody = expand_results(frame("line string, seq long", (line(None, "a"), 0)))
    with pytest.raises(Exception, match="NULL in required column"):
        enrich.translations_for(reviews, nobody).collect()
    with pytest.raises(Exception, match="result without a response"):
        enrich.translations_for(reviews, expand_results(frame("line string, seq long", ('{"custom_id": "3"}', 0))), "failfast").collect()


def test_the_fact_of_stored_reviews_shuffles_texts_once(frame, no_broadcast):
    doc = '{"delivery": 1, "product_quality": -0.5}'
    reviews = frame(
        "review_id long, order_id long, review_comment_message_en string, review_answer_timestamp timestamp, review_aspect_scores string",
        *[(r, o, f"text {r}", None, doc) for r, o in ((1, 1), (2, 1), (2, 1), (None, 2), (4, None), (5, 3), (6, 77))],
        (7, 1, "unscored", None, None),
    )
    orders = frame("order_id long, customer_id long", (1, 1), (1, 2), (2, 1), (3, 9), (None, 1), (4, 1))
    customers = frame("customer_id long, customer_city string", (1, "Ro"), (2, "Bo"), (2, "Bo"), (None, "No"))
    items = frame("order_id long, product_id long", (1, 1), (1, 1), (1, 2), (2, 2), (2, 3), (3, 1), (None, 1), (4, None))
    products = frame("product_id long, product_category_name string", (1, "a"), (2, "b"), (2, "b"), (3, "c"))
    translation = frame("product_category_name string, product_category_name_english string", ("a", "A"), ("b", "B"))
    tables = (reviews, items, products, translation, orders, customers)
    as_read, once = review_aspect_geo(*tables), review_aspect_geo(*tables, stored=True)
    assert rows(once) == rows(as_read) and once.dtypes == as_read.dtypes and len(rows(once)) > 30
    assert exchanges(once, "review_comment_message_en") == 1 < exchanges(as_read, "review_comment_message_en")
