"""The classifier on held-out documents, and at the edges."""

import random

import numpy as np

from commerce_lens.llm import quality
from commerce_lens.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.edge import SCHEMA, documents

LABELS = "doc_id long, quality int, extra string"


def test_held_out_accuracy(spark):
    found = QUERIES["op9_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = found.join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 80 and (got.predicted == got.quality).mean() > 0.95
    assert (got[got.quality == 1].predicted == 1).mean() > 0.97
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a, b = (sorted(map(tuple, quality.scores(docs, x).select("row.doc_id", "score").collect())) for x in (labels, flipped))
    assert a == b


def test_counts_match_a_dictionary(spark):
    texts = [(i, " ".join(random.Random(i).choices("ab cd !! ef , gh".split(), k=9))) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    parts = docs.selectExpr("text", "cast(doc_id % 2 AS int) AS label").mapInPandas(quality._count, "bin long, ones long, zeros long")
    got = {r["bin"]: (r["o"], r["z"]) for r in parts.groupBy("bin").agg({"ones": "sum", "zeros": "sum"}).toDF("bin", "o", "z").collect()}
    want = {}
    for i, t in texts:
        for b in quality.features(t):
            o, z = want.get(b, (0, 0))
            want[b] = (o + i % 2, z + 1 - i % 2)
    assert {b: tuple(sorted(v)) for b, v in got.items()} == {b: tuple(sorted(v)) for b, v in want.items()}


def test_descent_separates_what_is_separable():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.concatenate([[i % 2], rng.integers(2, 200, 8)])) for i in range(300)]
    w, bias = quality.descend(rows, np.array([i % 2 for i in range(300)]), np.ones(quality.BUCKETS) * 0.5)
    margins = np.array([w[r].sum() * 0.5 / np.sqrt(0.25 * len(r)) + bias for r in rows])
    assert np.corrcoef(margins, np.arange(300) % 2)[0, 1] > 0.5


def test_edges_and_missing_labels(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (3, 0, "x"), (5, 1, "x"), (None, 1, "x"), (7, None, "x"), (99, 1, "x")], LABELS)
    for known in (labels, labels.where("quality = 1"), labels.where("false")):
        got = quality.scores(docs, known).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
        blank = {r["score"] for r in got if not (r["row"]["text"] or "").strip()}
        assert len(blank) == 1
    assert quality.keep_good(docs, labels.where("false")).columns == docs.columns
    assert quality.scores(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_many_labels_are_joined_without_broadcast(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    a = quality.fit(docs, labels)
    monkeypatch.setattr(quality, "BROADCAST_LABELS", 0)
    b = quality.fit(docs, labels)
    assert np.allclose(a.weights, b.weights) and a.bias == b.bias


def test_a_repeated_id_is_one_row_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 3)
    known = spark.createDataFrame([(i, i % 2) for i in range(6)], "id long, label int")
    texts = [(i % 6, f"text {i % 12}" if i % 5 else None) for i in range(600)]
    got = [tuple(r) for r in quality.sampled(spark.createDataFrame(texts, "id long, text string"), known).collect()]
    assert len(got) == len({i for i, _, _ in got}) == 3
    again = quality.sampled(spark.createDataFrame(texts[::-1], "id long, text string").repartition(5), known).collect()
    assert sorted(got) == sorted(map(tuple, again)) and all(t for _, _, t in got)
