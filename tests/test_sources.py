"""CSV, JSON lines and versioned tables."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from commerce_lens import session
from commerce_lens.catalog.fixtures import stand_in_scorer, stand_in_translator
from commerce_lens.plans.refresh import refresh
from commerce_lens.sources import csv_files, csv_records, jsonl, tables
from commerce_lens.sources.ingest import STAGING_TABLES, ingest, source_spec
from commerce_lens.sources.schemas import TRANSLATIONS
from tests.conftest import plan, rows

REVIEWS_CSV = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    '"17","o1",5,"","first line\nsecond ""quoted"" line, with comma",2018-01-02 00:00:00,2018-01-03 10:11:12\n'
    "34,o2,1,,,2018-01-02 00:00:00,2018-01-04 10:11:12\n"
    "34,o3,2,,late copy,2018-01-05 00:00:00,2018-01-06 10:11:12\n"
)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_inferred_csv(spark, tmp_path):
    df = csv_files.read_table_csv(spark, write(tmp_path / "r.csv", REVIEWS_CSV))
    assert dict(df.dtypes)["review_score"] == "int"
    assert dict(df.dtypes)["review_answer_timestamp"] == "timestamp"
    got = {(r["order_id"]): r for r in df.collect()}
    assert got["o1"]["review_comment_message"] == 'first line\nsecond "quoted" line, with comma'
    assert got["o1"]["review_comment_title"] == ""
    assert got["o2"]["review_comment_title"] is None and got["o2"]["review_comment_message"] is None


def test_header_only_csv(spark, tmp_path):
    path = write(tmp_path / "t.csv", "review_id,review_comment_message_en\n")
    assert csv_files.read_table_csv(spark, path, TRANSLATIONS, ["review_id"]).count() == 0


def test_declared_csv_keeps_leading_zeros_and_refuses_null_keys(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'review_id,review_comment_message_en\n007,\n"8",""\n')
    df = csv_files.read_table_csv(spark, path, TRANSLATIONS, ["review_id"])
    assert rows(df) == [("007", None), ("8", "")]
    bad = write(tmp_path / "bad.csv", "review_id,review_comment_message_en\n,text\n")
    broken = csv_files.read_table_csv(spark, bad, TRANSLATIONS, ["review_id"])
    # Also where the key itself is not read.
    with pytest.raises(Exception, match="NULL in required column review_id"):
        broken.select("review_comment_message_en").collect()


def test_enrichment_csv_round_trip(spark, tmp_path, frame):
    texts = ['a "b"', "line\nbreak", " padded\t", "", "back\\slash", ",", "é"]
    df = frame("review_id string, review_comment_message_en string", *[(str(i), t) for i, t in enumerate(texts)])
    path = str(tmp_path / "out")
    csv_files.write_enrichment_csv(df, path)
    assert rows(csv_files.read_table_csv(spark, path, TRANSLATIONS)) == rows(df)


def test_jsonl_order_of_lines(spark, tmp_path):
    line = '{"custom_id": "%s", "response": {"status_code": 200, "body": {"choices": [{"message": {"content": "%s"}}]}}}'
    write(tmp_path / "a.jsonl", "\n".join([line % ("1", "old"), line % ("2", "only"), "", line % ("1", "new"), ""]))
    got = jsonl.read_results(spark, str(tmp_path / "a.jsonl"))
    ordered = [r["content"] for r in got.orderBy("seq").collect()]
    assert ordered == ["old", "only", "new"]


def test_replace_table_reads_what_it_replaces(spark, tmp_path, frame):
    root = str(tmp_path)
    first = tables.replace_table(frame("a int", (1,), (2,)), root, "clean", "t")
    for _ in range(2):
        tables.replace_table(tables.table(spark, root, "clean", "t").select((F.col("a") + 10).alias("a")), root, "clean", "t")
    assert rows(tables.table(spark, root, "clean", "t")) == [(21,), (22,)]
    assert rows(first) == [(1,), (2,)]


def test_a_failed_write_publishes_nothing(spark, tmp_path, frame):
    root = str(tmp_path)
    tables.replace_table(frame("a int", (1,)), root, "clean", "t")
    broken = frame("a int", (2,)).select(F.raise_error(F.lit("stop")).cast("int").alias("a"))
    with pytest.raises(Exception, match="stop"):
        tables.replace_table(broken, root, "clean", "t")
    assert rows(tables.table(spark, root, "clean", "t")) == [(1,)]
    with pytest.raises(FileNotFoundError):
        tables.table(spark, root, "clean", "unknown")


def test_old_versions_expire(spark, tmp_path, frame):
    root = str(tmp_path)
    for i in range(4):
        tables.replace_table(frame("a int", (i,)), root, "clean", "t")
    assert tables.expire_versions(spark, root, "clean", "t", keep=1) == 3
    assert rows(tables.table(spark, root, "clean", "t")) == [(3,)]


def test_scratch_lives_in_the_shared_folder(spark, monkeypatch, frame):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.scratch_path(spark, "x").startswith(named.rstrip("/"))
    cut = session.cut_lineage(frame("a int, b string", (1, None)))
    assert rows(cut) == [(1, None)]


SOURCES = {
    "customers": "customer_id,customer_city,customer_state\nc1,sao paulo,SP\nc2,rio de janeiro,RJ\n",
    "geolocation": "geolocation_zip_code_prefix,geolocation_city\n01037,sao paulo\n",
    "order_items": "order_id,order_item_id,product_id,price,freight_value\no1,1,p1,10.50,2.25\no1,2,p2,4.50,1.75\no2,1,p1,10.50,\n",
    "order_payments": "order_id,payment_value\no1,19.00\n",
    "order_reviews": REVIEWS_CSV,
    "orders": (
        "order_id,customer_id,order_purchase_timestamp\no1,c1,2018-01-01 10:00:00\n"
        "o2,c2,2018-01-01 11:00:00\no3,c2,2018-02-01 11:00:00\no4,c9,2018-02-01 12:00:00\n"
    ),
    "products": "product_id,product_category_name\np1,beleza\np2,\n",
    "sellers": "seller_id,seller_city\ns1,sao paulo\n",
    "product_category_name_translation": "product_category_name,product_category_name_english\nbeleza,beauty\n",
}


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sources")
    specs = [source_spec(n, write(folder / f"{n}.csv", SOURCES[n])) for n in STAGING_TABLES]
    root = str(folder / "tables")
    return specs, root, refresh(spark, specs, root, stand_in_translator(), stand_in_scorer(), tasks=2)


def test_refresh_builds_every_layer(refreshed):
    _, root, out = refreshed
    assert len(out) == 9 + 12 + 3  # with what was rejected: answers and scores
    daily = {str(r["order_date"]): r for r in out["aggregated.agg_sales_daily"].collect()}
    first = daily["2018-01-01"]
    assert (first["total_orders"], first["total_revenue"], first["total_items_sold"]) == (2, 25.5, 3)
    # o1 has two items and score 5, o2 one item and score 1.
    assert first["avg_review_score"] == (5 * 2 + 1) / 3
    assert first["avg_freight_value"] == 2.0
    feb = daily["2018-02-01"]
    assert (feb["total_orders"], feb["total_revenue"], feb["total_items_sold"]) == (2, None, 0)
    assert (feb["avg_items_per_order"], feb["avg_review_score"]) == (0.0, None)
    cities = {(str(r["order_month"]), r["city"]): r for r in out["aggregated.agg_sales_by_city"].collect()}
    # The order of an unknown customer is in the daily mart only.
    assert cities[("2018-02-01", "rio de janeiro")]["total_orders"] == 1
    assert cities[("2018-01-01", "sao paulo")]["total_freight_value"] == 4.0
    product = out["aggregated.agg_aspect_score_by_product"].collect()
    # p2 has no category.
    assert [(r["product_id"], r["product_category_name_en"], r["total_reviews"]) for r in product] == [("p1", "beauty", 1)]
    reviews = {r["order_id"]: r for r in out["clean.order_reviews"].collect()}
    assert set(reviews) == {"o1", "o2"}
    assert reviews["o1"]["review_comment_message_en"].startswith("EN2: first line second")
    assert '"delivery":' in reviews["o1"]["review_aspect_scores"]


def test_refresh_can_keep_earlier_answers(spark, refreshed):
    specs, root, out = refreshed

    def no_model():
        def refuse(batch):
            raise AssertionError("called for a row that has its answer")

        return refuse

    again = refresh(spark, specs, root, no_model, no_model, previous=out["clean.order_reviews"], tasks=2)
    assert rows(again["clean.order_reviews"]) == rows(out["clean.order_reviews"])


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def as_csv(rows, newline="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=newline)
    writer.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("share", [0.0, 0.02, 0.7])
def test_records_that_span_lines_and_splits(spark, tmp_path, small_splits, share, newline):
    """Against the standard library, over several files of many splits."""
    rng, expected = random.Random(7), []
    for f in range(3):
        own = []
        for i in range(1500):
            text = " ".join(rng.choice(["a", 'say ""', "b,c", "é"]) for _ in range(rng.randrange(6)))
            if rng.random() < share:
                text += "\n" * rng.randrange(1, 4) + "x\n\ny" * rng.choice([1, 1, 1, 3000 if i == 700 else 2]) + ' "z"'
            own.append([f"{f}-{i}", text or "-", str(i)])
        expected += own
        write_bytes(tmp_path / f"f{f}.csv", as_csv([["id", "text", "n"], *own], newline))
    df = csv_files.read_table_csv(spark, str(tmp_path / "*.csv"), "id string, text string, n int", ["id"])
    assert rows(df) == sorted((a, b, int(c)) for a, b, c in expected)
    assert csv_records.splits(spark, str(tmp_path / "*.csv")).count() > 6
    inferred = csv_files.read_table_csv(spark, str(tmp_path / "*.csv"))
    assert dict(inferred.dtypes) == {"id": "string", "text": "string", "n": "int"}
    assert rows(inferred) == rows(df)


def write_bytes(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_headers_over_lines_blank_lines_and_marks(spark, tmp_path):
    text = '\ufeff"id","two\nlines"\n\n1,"a\nb"\n2,\n\n3,""\n'
    df = csv_files.read_table_csv(spark, write_bytes(tmp_path / "t.csv", text))
    assert df.columns == ["id", "two lines"]
    assert rows(df) == [(1, "a\nb"), (2, None), (3, "")]


def test_a_header_alone_with_a_newline(spark, tmp_path):
    df = csv_files.read_table_csv(spark, write_bytes(tmp_path / "t.csv", '"a\nb",c\n'))
    assert df.count() == 0 and df.columns == ["a b", "c"]


def test_unpaired_quotes_and_broken_rows_are_refused(spark, tmp_path):
    bad = write_bytes(tmp_path / "bad.csv", 'a,b\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="unpaired quotes in .*bad.csv"):
        csv_files.read_table_csv(spark, bad, "a int, b string").collect()
    worse = write_bytes(tmp_path / "worse.csv", 'a,b\n1,"x\ny"\nz,y\n')
    with pytest.raises(Exception, match="FAILFAST|[Mm]alformed"):
        csv_files.read_table_csv(spark, worse, "a int, b string").collect()


def test_text_of_splits_without_such_records_is_not_shuffled(spark, tmp_path, small_splits):
    plain = "id,text\n" + "".join(f"{i},text {i}\n" for i in range(20_000))
    write_bytes(tmp_path / "a.csv", plain)
    assert "Exchange" not in plan(csv_files.read_table_csv(spark, str(tmp_path), "id int, text string"))
    write_bytes(tmp_path / "b.csv", plain + '-1,"two\nlines"\n')
    known = csv_records.splits(spark, str(tmp_path))
    assert known.where("odds > 0").count() == 1 and known.count() > 20
    df = csv_files.read_table_csv(spark, str(tmp_path), "id int, text string")
    assert df.count() == 40_001 and rows(df.where("id = -1")) == [(-1, "two\nlines")]


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "big.csv"
    path.write_text("a,b\n" + "".join(f'{i},"text\n{i}"\n' for i in range(20_000)))
    spec = source_spec("orders", str(path), schema="a long, b string")
    df = csv_files.read_table_csv(spark, spec.path, spec.schema, spec.required, spec.quoted_newlines)
    assert csv_records.splits(spark, str(path)).count() > 8
    assert df.count() == 20_000 and df.where(F.col("b") == F.concat(F.lit("text\n"), F.col("a"))).count() == 20_000


def test_every_table_may_hold_quoted_newlines(spark, tmp_path):
    assert all(source_spec(n, "x").quoted_newlines for n in STAGING_TABLES)
    spec = source_spec("sellers", write_bytes(tmp_path / "s.csv", 'seller_id,seller_city\n1,"sao\npaulo"\n'))
    stored = ingest(spark, [spec], str(tmp_path / "t"))["sellers"]
    assert rows(stored) == [(1, "sao\npaulo")]


def test_records_within_a_split_are_neither_copied_nor_shuffled(spark, tmp_path, small_splits, monkeypatch):
    """Also where batches of a few lines end within records and headers."""
    expected = [[str(i), f"a {i}" + "\n\nb,\"c\"" * (i % 5) + ("\nx" * 9_000 if i == 321 else "")] for i in range(2_000)]
    for f in range(2):
        write_bytes(tmp_path / f"f{f}.csv", as_csv([["id", "two\nlines"], *expected[f::2]]))
    copies = []
    monkeypatch.setattr(csv_records, "cut_lineage", lambda df, label="cut", paths=None: copies.append(label) or session.cut_lineage(df, label, paths))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = csv_files.read_table_csv(spark, str(tmp_path / "*.csv"), "id string, text string")
        assert rows(df) == sorted(map(tuple, expected))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert copies == ["splits"]
    # Only records that go on in another split meet in an exchange.
    known = csv_records.splits(spark, str(tmp_path)).localCheckpoint()
    text = plan(csv_records.records(spark, str(tmp_path), known))
    whole = text[: text.index("ObjectHashAggregate")]
    assert "MapInArrow" in whole and "Exchange hash" not in whole
