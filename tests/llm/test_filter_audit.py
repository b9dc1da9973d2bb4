"""Filter audits against loops over documents."""

import random
import re
from itertools import permutations

import pytest

from commerce_lens.llm import filter_audit as fa
from tests.conftest import SMALL
from tests.llm.edge import SCHEMA, documents, stored


def fails(texts):
    """The failed filters of each (id, part, text)."""
    first = {}
    for i, _, t in texts:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, _, t in texts:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": re.search(r"[#$%&*|]", t) is not None,
            "E": i is not None and i > first[t],
        }
        out.append({k for k, bad in own.items() if bad})
    return out


def brute(texts, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows, failed = {}, fails(texts)
    parts = {p or "" for _, p, _ in texts}
    for order in map("".join, permutations("ABCDE")):
        for part in parts:
            left = [(i, f) for (i, p, _), f in zip(texts, failed) if (p or "") == part]
            everything = left
            for step, own in enumerate(order, 1):
                gone = [x for x in left if own in x[1]]
                left = [x for x in left if own not in x[1]]
                redundant = sum(own in f for _, f in everything) - len(gone)
                alone = sum(f == {own} for _, f in everything)
                rows[part, order, step] = [len(left), len(gone), redundant, alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    total = {}
    for (part, order, step), r in rows.items():
        key = part, order[step - 1]
        total[key] = total.get(key, 0) + r[1]
    return {(part, order, step): (*r, total[part, order[step - 1]]) for (part, order, step), r in rows.items()}


def found(df):
    out = {}
    for r in df.collect():
        key = r["part"], r["filter_order"], r["step"]
        assert key not in out
        out[key] = tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return out


def test_whole_table(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    texts = list(map(tuple, docs.select("doc_id", "lang", "text").collect()))
    assert found(fa.audit_documents(docs, labels)) == brute(texts, list(map(tuple, labels.select("doc_id", "quality", "toxic").collect())))


def test_edges(spark, tmp_path):
    docs = stored(spark, documents(spark), tmp_path / "d")
    rows = [(1, 1, 0), (1, 0, 1), (5, 1, None), (None, 1, 1), (2, None, None), (99, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    texts = list(map(tuple, docs.select("doc_id", "lang", "text").collect()))
    assert found(fa.audit_documents(docs, labels)) == brute(texts, rows)


def test_random_tables_with_hot_texts_and_null_parts(spark, tmp_path):
    rng = random.Random(5)
    pool = ["", None, "WORD " * 120, "a $ b", " ".join(map(str, range(150))), " ".join(map(str, range(150))) + " |", "Ab"]
    texts = [(rng.choice([None, *range(60)]), rng.choice([None, "", "en", "fr"]), pool[0] if rng.random() < 0.4 else rng.choice(pool)) for _ in range(300)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(60)]
    docs = stored(spark, spark.createDataFrame(texts, "doc_id long, lang string, text string"), tmp_path / "d")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert found(fa.audit_documents(docs, known)) == brute(texts, labels)


@pytest.mark.parametrize("labelled", [False, True])
def test_empty_tables(spark, labelled):
    labels = spark.createDataFrame([(1, 1, 1)] if labelled else [], "doc_id long, quality int, toxic int")
    assert fa.audit_documents(spark.createDataFrame([], SCHEMA), labels).count() == 0
