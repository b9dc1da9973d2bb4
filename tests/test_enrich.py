"""Enrichment: requests, results, outcomes, merges."""

import json
import re

import pytest
from pyspark.sql import functions as F

from commerce_lens.catalog.fixtures import stand_in_scorer, stand_in_translator
from commerce_lens.operators import enrich
from commerce_lens.operators.select import limit_batch
from commerce_lens.plans import enrichment
from commerce_lens.plans.enrichment import carry_over, enrich_reviews, enrich_with_rejects
from commerce_lens.sources.jsonl import expand_results, write_jsonl
from tests.conftest import plan, rows

REVIEWS = "review_id string, review_comment_message string, review_comment_message_en string, review_aspect_scores string"


def line(id_, content, status=200):
    body = {"choices": [{"message": {"content": content}}]}
    return json.dumps({"custom_id": id_, "response": {"status_code": status, "body": body}})


def results(frame, *lines):
    return expand_results(frame("line string, seq long", *[(x, i) for i, x in enumerate(lines)]))


EDGE = [
    line("1", "first"),
    line("2", "fails", 500),
    '{"custom_id": "3", "response": null}',
    line("1", "\n second\nanswer \t"),
    '{"custom_id": "4", "response": {"status_code": 200, "body": {"choices": []}}}',
    line("5", "not json"),
    line("6", '{"delivery_speed": 0.5, "correct_items": 0}'),
    line("6", "later failure", 429),
]


def test_pending(frame):
    df = frame(REVIEWS, ("1", "a", None, None), ("2", None, None, None), ("3", "c", "C", None), ("4", "d", "D", "{}"))
    assert rows(enrich.pending_translation(df)) == [("1", "a")]
    assert rows(enrich.pending_scoring(df)) == [("3", "C")]


def test_limit_batch_takes_the_lowest_keys(spark):
    df = spark.range(0, 50_000, 1, 40).select((F.col("id") * 7919 % 50_000).alias("k"), F.lit("x").alias("text"))
    got = [r["k"] for r in limit_batch(df, "k", 1000).collect()]
    assert sorted(got) == list(range(1000))
    assert limit_batch(df, "k", None).count() == 50_000
    assert limit_batch(df, "k", 60_000).count() == 50_000


def nodes(df):
    return re.findall(r"^[ :+-]*(?:\*\(\d+\) )?(\w+)", plan(df), re.M)


def test_limit_batch_has_one_plan_whatever_n(spark):
    df = spark.range(0, 2_000_000, 1, 40).withColumnRenamed("id", "k")
    few, many = limit_batch(df, "k", 10_000), limit_batch(df, "k", 1_000_000)
    # No window over the table and no sort of it for either; a first range that holds all n rows needs no union.
    assert set(nodes(few)) <= set(nodes(many)) and not {"Window", "Sort", "Exchange"} & set(nodes(many))
    assert few.count() == 10_000 and many.agg(F.max("k")).first()[0] == 999_999


def test_limit_batch_of_null_and_equal_keys(frame):
    df = frame("k long, v int", *[(None, i) for i in range(5)], *[(7, i) for i in range(5)], (9, 0))
    assert [limit_batch(df, "k", n).count() for n in (0, 3, 5, 8, 10, 11, 12)] == [0, 3, 5, 8, 10, 11, 11]
    assert rows(limit_batch(df, "k", 3), "k") == [(None,)] * 3
    assert limit_batch(df.where("false"), "k", 3).count() == 0


@pytest.mark.parametrize("n", [1, 2, 100, None])
def test_runs_of_n_answer_every_review(frame, n):
    reviews = frame(REVIEWS, *[(str(i), f"text {i}", None, None) for i in range(1, 8)], ("99", None, None, None))
    out = enrich_reviews(reviews, stand_in_translator(), stand_in_scorer(), n=n)
    assert out.where("review_comment_message_en IS NOT NULL").count() == 7
    assert out.where("review_aspect_scores IS NOT NULL").count() == 7


def test_rejects_are_kept_with_their_phase(frame):
    reviews = frame(REVIEWS, ("11", "failed", None, None), ("13", "malformed", None, None), ("1", "fine", None, None))
    out, rejects = enrich_with_rejects(reviews, stand_in_translator(), stand_in_scorer(), n=2)
    assert rows(rejects, "phase", "custom_id", "outcome") == [("aspects", "13", "malformed"), ("translation", "11", "failed")]
    assert rows(out.where("review_aspect_scores IS NOT NULL"), "review_id") == [("1",)]


def test_requests_are_distinct_and_nested(frame, tmp_path, spark):
    df = frame("review_id string, review_comment_message_en string", ("1", 'so "good"'), ("1", 'so "good"'), ("2", "bad"))
    requests = enrich.aspect_requests(df)
    assert rows(requests, "custom_id") == [("1",), ("2",)]
    write_jsonl(enrich.request_documents(requests), str(tmp_path / "r"))
    docs = {d["custom_id"]: d for d in (json.loads(r[0]) for r in spark.read.text(str(tmp_path / "r")).collect())}
    assert docs["1"]["body"]["messages"][1] == {"role": "user", "content": 'Customer Review: "so "good""'}
    assert docs["1"]["body"]["response_format"] == {"type": "json_object"}
    assert (docs["1"]["method"], docs["1"]["url"], docs["1"]["body"]["max_tokens"]) == ("POST", "/v1/chat/completions", 100)
    plain = enrich.translation_requests(frame("review_id string, review_comment_message string", ("1", "oi")))
    write_jsonl(enrich.request_documents(plain), str(tmp_path / "t"))
    doc = json.loads(spark.read.text(str(tmp_path / "t")).first()[0])
    assert "response_format" not in doc["body"] and doc["body"]["max_tokens"] == 1000


def test_translations(frame):
    got = rows(enrich.parse_translations(results(frame, *EDGE)))
    assert got == [("1", "second answer"), ("5", "not json"), ("6", '{"delivery_speed": 0.5, "correct_items": 0}')]
    with pytest.raises(Exception, match="result without a response"):
        enrich.parse_translations(results(frame, *EDGE), "failfast").collect()
    with pytest.raises(ValueError):
        enrich.parse_translations(results(frame, *EDGE), "other")


def test_aspects(frame):
    assert rows(enrich.parse_aspects(results(frame, *EDGE))) == [("6", '{"delivery":0.5,"correct_items":0}')]
    plain = enrich.parse_aspects(results(frame, *EDGE), rename={})
    assert json.loads(plain.first()[1]) == {"delivery_speed": 0.5, "correct_items": 0}
    with pytest.raises(Exception, match="malformed JSON"):
        enrich.parse_aspects(results(frame, line("1", "not json")), "failfast").collect()


def test_a_malformed_later_answer_does_not_hide_an_earlier_one(frame):
    got = enrich.parse_aspects(results(frame, line("1", '{"a": 1}'), line("1", "oops")))
    assert rows(got) == [("1", '{"a":1}')]


def test_a_repeated_key_keeps_its_last_value(frame):
    got = enrich.parse_aspects(results(frame, line("1", '{"delivery": 1, "delivery": 2}')), rename={})
    assert json.loads(got.first()[1]) == {"delivery": 2}


def test_outcomes_account_for_every_line(frame):
    r = results(frame, *EDGE)
    counts = {(o, s): n for o, s, n in rows(enrich.batch_outcome(r))}
    assert counts == {
        ("ok", 200): 1,
        ("failed", 500): 1,
        ("failed", 429): 1,
        ("no_response", None): 1,
        ("no_response", 200): 1,
        ("malformed", 200): 3,
    }
    assert enrich.quarantined(r).count() == 7
    assert enrich.quarantined(r, json_content=False).count() == 4


def test_apply_model_opens_once_per_task_and_sees_every_row(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("custom_id"))

    def open_model():
        import uuid

        me = uuid.uuid4().hex
        return lambda batch: batch.assign(model=me)[["custom_id", "model"]]

    out = enrich.apply_model(df, open_model, "custom_id string, model string", tasks=3)
    counted = out.agg(F.count_distinct("custom_id"), F.count_distinct("model")).first()
    assert tuple(counted) == (1000, 3)


def test_merges(frame):
    reviews = frame(REVIEWS, ("1", "a", None, None), ("2", "b", "B", None))
    merged = enrich.merge_translations(reviews, frame("review_id string, review_comment_message_en string", ("1", "A")))
    assert rows(merged, "review_id", "review_comment_message_en") == [("1", "A"), ("2", "B")]
    bad = frame("review_id string, review_aspect_scores string", ("1", "{"))
    with pytest.raises(Exception, match="malformed JSON"):
        enrich.merge_aspects(reviews, bad).collect()
    # Also where the merged column is not read.
    with pytest.raises(Exception, match="malformed JSON"):
        enrich.merge_aspects(reviews, bad).select("review_id").collect()
    with pytest.raises(Exception, match="NULL in required column"):
        enrich.merge_translations(
            reviews, frame("review_id string, review_comment_message_en string", (None, "A"))
        ).collect()


def model(answer, status=200):
    def open_model():
        import json

        import pandas as pd

        def run(batch):
            lines = []
            for id_, text in zip(batch["custom_id"], batch["user_prompt"]):
                body = {"choices": [{"message": {"content": answer(text)}}]}
                lines.append((json.dumps({"custom_id": id_, "response": {"status_code": status, "body": body}}), 0))
            return pd.DataFrame(lines, columns=["line", "seq"])

        return run

    return open_model


def test_both_phases(frame):
    reviews = frame(REVIEWS, ("1", "bom", None, None), ("2", None, None, None), ("3", "feito", "done", '{"x":1}'))
    out = enrich_reviews(reviews, model(str.upper), model(lambda t: '{"delivery_speed": %d}' % len(t)), tasks=2)
    assert rows(out) == [
        ("1", "bom", "BOM", '{"delivery":%d}' % len('Customer Review: "BOM"')),
        ("2", None, None, None),
        ("3", "feito", "done", '{"x":1}'),
    ]


def test_nothing_pending_changes_nothing(frame):
    reviews = frame(REVIEWS, ("2", None, None, None), ("3", "feito", "done", '{"x":1}'))
    assert rows(enrich_reviews(reviews, model(str), model(str), tasks=2)) == rows(reviews)


def test_a_failed_batch_leaves_reviews_pending(frame):
    reviews = frame(REVIEWS, ("1", "bom", None, None))
    out = enrich_reviews(reviews, model(str, 500), model(str, 500), tasks=1)
    assert rows(out) == rows(reviews)


def test_carry_over(frame):
    clean = frame(REVIEWS, ("1", "a", None, None), ("2", "b", None, None))
    previous = frame(REVIEWS, ("1", "a", "A", "{}"), ("9", "z", "Z", "{}"))
    assert rows(carry_over(clean, previous)) == [("1", "a", "A", "{}"), ("2", "b", None, None)]


def counting_model(log, fail_at=None):
    """Writes the ids of each batch it sees to a file of its own."""

    def open_model():
        import json
        import os
        import uuid

        import pandas as pd

        def run(batch):
            if fail_at in set(batch["custom_id"]):
                raise RuntimeError("cut off")
            with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
                json.dump(batch["custom_id"].tolist(), f)
            doc = lambda i: json.dumps({"custom_id": i, "response": {"status_code": 200, "body": {"choices": [{"message": {"content": "E" + i}}]}}})
            return pd.DataFrame([(doc(i), 0) for i in batch["custom_id"]], columns=["line", "seq"])

        return run

    return open_model


def requests(spark, n):
    made = spark.range(n).select(F.format_string("%03d", "id").alias("review_id"), F.lit("texto").alias("review_comment_message"))
    return enrich.translation_requests(made)


@pytest.mark.parametrize("n", [1, 7, 50, 1000, None])
def test_runs_hold_n_requests_in_order_of_ids(spark, tmp_path, n):
    folder = str(tmp_path / "runs")
    k = enrichment.deal_runs(requests(spark, 50), n, folder)
    size = n or 50
    assert k == -(-50 // size)
    for run in range(k):
        own = spark.read.parquet(f"{folder}/requests/run={run}")
        assert [r[0] for r in rows(own, "custom_id")] == [f"{i:03}" for i in range(run * size, min(50, (run + 1) * size))]


def test_a_cut_off_call_goes_on_and_pays_no_run_twice(spark, tmp_path):
    log, folder = tmp_path / "log", str(tmp_path / "runs")
    log.mkdir()
    with pytest.raises(Exception, match="cut off"):
        enrichment.run_batches(requests(spark, 30), counting_model(str(log), "021"), 2, 10, "x", folder)
    seen = sorted(i for f in log.iterdir() for i in json.loads(f.read_text()))
    assert [i for i in seen if i < "020"] == [f"{i:03}" for i in range(20)]
    out = enrichment.run_batches(requests(spark, 30), counting_model(str(log)), 2, 10, "x", folder)
    assert rows(out, "custom_id", "content") == [(f"{i:03}", f"E{i:03}") for i in range(30)]
    seen = [i for f in log.iterdir() for i in json.loads(f.read_text())]
    assert all(seen.count(f"{i:03}") == 1 for i in range(20))
    # One read of one folder, however many runs there were.
    assert plan(out).count("FileScan") == 1 and "Union" not in plan(out)


def test_no_requests_are_no_runs(spark, tmp_path):
    folder = str(tmp_path / "runs")
    assert enrichment.run_batches(requests(spark, 0), model(str), 2, 10, "x", folder).count() == 0
    assert enrichment.deal_runs(requests(spark, 0), 10, folder) == 0


def test_many_runs_are_answered_by_few_jobs_and_stay_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(enrichment, "MOST_JOBS", 5)
    log, folder = tmp_path / "log", str(tmp_path / "runs")
    log.mkdir()
    with pytest.raises(Exception, match="cut off"):
        enrichment.run_batches(requests(spark, 70), counting_model(str(log), "069"), 2, 3, "x", folder)
    out = enrichment.run_batches(requests(spark, 70), counting_model(str(log)), 2, 3, "x", folder)
    assert rows(out, "custom_id", "content") == [(f"{i:03}", f"E{i:03}") for i in range(70)]
    batches = [json.loads(f.read_text()) for f in log.iterdir()]
    # 24 runs of 3, five to a job; only the last job is done again.
    assert all(len({int(i) // 3 for i in b}) == 1 for b in batches) and max(map(len, batches)) == 3
    seen = [i for b in batches for i in b]
    assert all(seen.count(f"{i:03}") == 1 for i in range(60))
    assert len(list((tmp_path / "runs" / "answers").iterdir())) == 5
