"""Column functions on hand-made values."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from commerce_lens.functions import aggregates as agg
from commerce_lens.functions import scalars as fn
from commerce_lens.functions.aggregates import avg_money, sum_money
from commerce_lens.functions.json_text import ASPECTS, json_checked, json_doc, json_scores, json_valid, result_fields
from commerce_lens.operators.enrich import rename_keys
from commerce_lens.plans.marts import rejected_scores
from tests.conftest import rows

SPACES = "\t\r\x0b\x0c\x1c\x1f\x85\xa0  　 "


@pytest.mark.parametrize(
    "text",
    ["", "  ", "plain", f"{SPACES}a b{SPACES}", "a\nb", "\na\n\nb\n", "a\r\nb\r\n", "x​", "\n", None, "a \t b"],
)
def test_clean_text_replaces_newlines_and_strips(frame, text):
    want = None if text is None else text.replace("\n", " ").strip()
    assert frame("t string", (text,)).select(fn.clean_text("t")).first()[0] == want


def test_dates(frame):
    df = frame("t timestamp", (datetime(2018, 3, 31, 23, 59, 59),), (None,))
    out = df.select(
        fn.to_day("t"), fn.month_start("t"), fn.year_month("t"), fn.year_of("t"), fn.month_of("t")
    ).collect()
    assert tuple(out[0]) == (date(2018, 3, 31), date(2018, 3, 1), "201803", 2018, 3)
    assert tuple(out[1]) == (None,) * 5


def test_to_double(frame):
    df = frame("t string", ("1.5",), ("x",))
    assert [r[0] for r in df.select(fn.to_double("t", tolerant=True)).collect()] == [1.5, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(fn.to_double("t")).collect()


def test_division_by_zero_is_an_error(frame):
    df = frame("a int, b int", (1, 2))
    assert df.select(fn.divide("a", "b")).first()[0] == 0.5
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(fn.divide("a", F.col("b") - 2)).collect()


def test_money_is_exact_in_any_order(frame):
    cents = [0.1, 0.2, 0.7, 1e9 + 0.01, 0.3, None] * 50
    df = frame("p double", *[(c,) for c in cents])
    want = 50 * 1_000_000_001.31
    for parts in (1, 7, 50):
        assert df.repartition(parts).agg(agg.sum_money("p")).first()[0] == want


def test_aggregates_on_nulls(frame):
    df = frame("k string, v double, w int", ("a", None, None), ("a", None, None), ("b", 1.0, 2), ("b", 2.0, 2))
    out = df.groupBy("k").agg(
        agg.count_col("v"), agg.sum_money("v"), agg.avg_money("v"), agg.avg_col("v"), agg.count_where(F.col("v") > 1),
        agg.count_distinct("w"),
    )
    assert rows(out) == [("a", 0, None, None, None, 0, 0), ("b", 2, 3.0, 1.5, 1.5, 1, 1)]


@pytest.mark.parametrize(
    "text, valid", [("{}", True), ("null", True), ("[1", False), ("{'a': 1}", False), ("", False), ("{\"a\": 1}", True)]
)
def test_json_valid(frame, text, valid):
    df = frame("c string", (text,))
    assert df.select(json_valid("c")).first()[0] is valid
    assert df.select(json_checked("c", tolerant=True)).first()[0] == (text if valid else None)
    if not valid:
        with pytest.raises(Exception, match="malformed JSON"):
            df.select(json_checked("c")).collect()


@pytest.mark.parametrize(
    "value, score",
    [
        ("0.25", 0.25),
        ('"0.25"', 0.25),
        ("-1", -1.0),
        ("1e-1", 0.1),
        ("null", None),
        ('{"x": 1}', None),
        ("[0.5]", None),
        ("true", None),
        ('"bad"', None),
    ],
)
def test_json_score_values(frame, value, score):
    df = frame("c string", ('{"delivery": %s, "other": 1}' % value,))
    got = df.select(json_scores("c").alias("s")).select("s.*").first()
    assert tuple(got) == (score, None, None, None, None)


@pytest.mark.parametrize("text", ["null", "[]", '[{"delivery": 1}]', "3", None])
def test_json_scores_of_other_documents_are_null(frame, text):
    got = frame("c string", (text,)).select(json_scores("c").alias("s")).select("s.*").first()
    assert tuple(got) == (None,) * len(ASPECTS)


def test_strict_scores_refuse_text(frame):
    df = frame("c string", ('{"delivery": "bad"}',))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(json_scores("c", strict=True)).collect()
    fine = frame("c string", ('{"delivery": "0.5", "product_quality": {"x": 1}}',))
    assert tuple(fine.select(json_scores("c", strict=True).alias("s")).select("s.*").first())[:2] == (0.5, None)


@pytest.mark.parametrize("text", ["1d", "1f", "0.5D", "5.f"])
def test_suffixed_numbers_are_refused(frame, text):
    df = frame("c string", ('{"delivery": "%s"}' % text,))
    assert df.select(json_scores("c").alias("s")).select("s.delivery").first()[0] is None
    with pytest.raises(Exception, match="not a number"):
        df.select(json_scores("c", strict=True)).collect()


def test_rejected_scores_are_counted(frame):
    df = frame("review_aspect_scores string", ('{"delivery": "bad", "product_quality": "1d"}',), ('{"delivery": "x"}',), ('{"delivery": null}',), ('{"delivery": [1]}',), (None,))
    assert sorted(map(tuple, rejected_scores(df).collect())) == [("delivery", 2), ("product_quality", 1)]


def test_money_keeps_every_digit_and_passes_nan_on(frame):
    df = frame("g int, x double", (1, 1.00004), (1, 0.00004), (1, 0.00004), (2, 0.123456), (2, 0.000001), (3, float("nan")), (3, 1.0), (4, None), (5, float("inf")))
    got = {r["g"]: (r["s"], r["a"]) for r in df.groupBy("g").agg(sum_money("x").alias("s"), avg_money("x").alias("a")).collect()}
    assert got[1] == (1.00012, 0.33337333333333335) or got[1][0] == 1.00012
    assert got[2][0] == 0.123457
    assert math.isnan(got[3][0]) and math.isnan(got[3][1])
    assert got[4] == (None, None) and got[5][0] == float("inf")


def test_result_fields(frame):
    lines = [
        '{"custom_id": "1", "response": {"status_code": 200, "body": {"choices": [{"message": {"content": "x"}}]}}}',
        '{"custom_id": "2", "response": null}',
        '{"custom_id": "3", "response": {"status_code": 200, "body": {"choices": []}}}',
        "not json",
    ]
    out = frame("c string", *[(x,) for x in lines]).select(result_fields("c").alias("r")).select("r.*")
    assert [tuple(r) for r in out.collect()] == [("1", 200, "x"), ("2", None, None), ("3", 200, None), (None, None, None)]


def test_json_doc_escapes(frame):
    df = frame("t string", ('say "hi"\n',))
    assert df.select(json_doc(text=F.col("t"))).first()[0] == '{"text":"say \\"hi\\"\\n"}'


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"delivery_speed": 0.5, "x": "delivery_speed"}', '{"delivery":0.5,"x":"delivery_speed"}'),
        ('{"delivery_speed": 0.5, "delivery": 1}', '{"delivery_speed":0.5,"delivery":1}'),
        ('{"a": {"delivery_speed": 1}}', '{"a":{"delivery_speed":1}}'),
        ("[1, 2]", "[1,2]"),
        ("null", "null"),
        ("{}", "{}"),
    ],
)
def test_rename_keys(frame, text, want):
    df = frame("c string", (text,))
    assert df.select(rename_keys("c", {"delivery_speed": "delivery"})).first()[0] == want
