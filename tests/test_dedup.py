"""Ranking and deduplication against a plain Python reading of the rules."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from commerce_lens.operators.clean import clean_order_reviews
from commerce_lens.operators.dedup import dedup_reviews, first_per_key, last_per_key, rank_in
from tests.conftest import plan, rows

SCHEMA = "review_id string, order_id string, review_creation_date timestamp, review_answer_timestamp timestamp, review_score int"
DAY = datetime(2024, 1, 1)


def nulls_first(values):
    return [(v is not None, v if v is not None else 0) for v in values]


def expected_ranks(data, key, other):
    """Rank of each row position within its key, NULL being one key."""
    groups = {}
    for i, r in enumerate(data):
        groups.setdefault(r[key], []).append(i)
    ranks = {}
    for members in groups.values():
        members.sort(key=lambda i: nulls_first([data[i][2], data[i][3]]) + [(data[i][other] is not None, data[i][other] or "")])
        ranks.update({i: place for place, i in enumerate(members, 1)})
    return ranks


def random_reviews(seed, n, hot):
    """Reviews with NULL ids and dates; a third of the rows share one review id or order id."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        review = "hot" if hot == "review" and rng.random() < 0.34 else rng.choice([None, *map(str, range(n // 2))])
        order = "hot" if hot == "order" and rng.random() < 0.34 else rng.choice([None, *map(str, range(n // 2))])
        created = rng.choice([None, *(DAY + timedelta(days=d) for d in range(5))])
        data.append((review, order, created, DAY + timedelta(seconds=i), rng.randint(1, 5)))
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("hot", ["review", "order", None])
def test_both_ranks_must_be_one(spark, hot):
    data = random_reviews(7, 300, hot)
    by_review, by_order = expected_ranks(data, 0, 1), expected_ranks(data, 1, 0)
    want = sorted(str(data[i]) for i in range(len(data)) if by_review[i] == 1 and by_order[i] == 1)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = [tuple(r) for r in dedup_reviews(df).select(*df.columns).collect()]
    assert sorted(map(str, got)) == want


def test_a_row_stays_out_behind_a_row_that_itself_falls(frame):
    df = frame(
        SCHEMA,
        ("a", "x", DAY, DAY, 1),
        ("b", "x", DAY + timedelta(days=1), DAY, 2),
        ("b", "y", DAY + timedelta(days=2), DAY, 3),
    )
    assert rows(dedup_reviews(df), "review_id", "order_id") == [("a", "x")]


def test_exact_copies_leave_one_row_and_dedup_is_idempotent(frame):
    copy = ("a", "x", DAY, DAY, 1)
    df = frame(SCHEMA, copy, copy, copy, ("b", None, None, DAY, 2), (None, "z", DAY, DAY, 3))
    once = dedup_reviews(df)
    assert once.count() == 3
    assert rows(dedup_reviews(once)) == rows(once)


def test_full_ties_are_settled_by_the_other_columns(frame):
    data = [("a", "x", DAY, DAY, s) for s in (5, 2, 4)]
    for order in (data, data[::-1]):
        assert rows(dedup_reviews(frame(SCHEMA, *order)), "review_score") == [(2,)]


def test_rows_are_pruned_before_both_shuffles(frame):
    text = plan(dedup_reviews(frame(SCHEMA, ("a", "x", DAY, DAY, 1))))
    assert text.count("row_number(), 1, Partial") == 2


def test_clean_adds_empty_enrichment(frame):
    data = ("a", "x", 5, None, "text", DAY, DAY)
    schema = (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"
    )
    out = clean_order_reviews(frame(schema, data))
    assert out.dtypes[-2:] == [("review_comment_message_en", "string"), ("review_aspect_scores", "string")]
    assert rows(out)[0][-2:] == (None, None)


@pytest.mark.parametrize("hot", ["review", "order"])
def test_rank_in_ranges_equals_row_number(spark, hot):
    data = random_reviews(3, 400, hot)
    key, other, at = ("review_id", "order_id", 0) if hot == "review" else ("order_id", "review_id", 1)
    want = expected_ranks(data, at, 1 - at)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    order = ["review_creation_date", "review_answer_timestamp", other]
    ranked = rank_in(df, {"rank": (key, order)})
    got = {r["review_answer_timestamp"]: r["rank"] for r in ranked.collect()}
    assert got == {data[i][3]: rank for i, rank in want.items()}


def test_first_and_last_per_key(frame):
    df = frame("k string, seq int, v string", ("a", 1, "x"), ("a", 2, "y"), (None, 1, "z"), (None, 3, "w"))
    assert rows(first_per_key(df, "k", ["seq"]), "k", "v") == [(None, "z"), ("a", "x")]
    assert rows(last_per_key(df, "k", "seq"), "k", "v") == [(None, "w"), ("a", "y")]


def test_a_hot_key_spreads_over_ranges(spark):
    df = spark.range(40_000).selectExpr("IF(id % 10 < 9, 0, id) AS k", "id * 7919 % 40000 AS v")
    ranked = rank_in(df, {"rank": ("k", ["v"])}).cache()
    assert ranked.where("k = 0").agg(F.max("rank"), F.count_distinct("rank")).first() == (36_001 - 1, 36_000)
    wrong = ranked.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("v"))).where("rank <> want")
    assert wrong.count() == 0
    ranked.unpersist()


def test_texts_are_shuffled_once(spark):
    """Rows with texts as without, NULL ids among them, and one exchange that carries a text."""
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    made = spark.range(4000).selectExpr(
        "nullif(id * 7919 % 900, 5) AS review_id", "nullif(id * 104729 % 1100, 9) AS order_id", "cast(id % 5 AS int) AS review_score",
        "concat('t', id % 3) AS review_comment_message", "timestamp_seconds(id * 31 % 40) AS review_creation_date",
        "timestamp_seconds(id * 17 % 20) AS review_answer_timestamp",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dedup_reviews(made)
        text = plan(out)
        got = rows(out, "review_id", "order_id", "review_creation_date", "review_answer_timestamp")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    ids = rows(dedup_reviews(made.drop("review_comment_message", "review_score")))
    assert sorted(map(str, got)) == sorted(str((r[0], r[1], r[2], r[3])) for r in ids) and got
    # Where texts come from: one exchange on the key alone, none on both ids.
    assert text.count("Exchange hashpartitioning(_key") == 2
