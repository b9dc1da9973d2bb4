"""Exact dedup against a dictionary."""

import hashlib
import random
import re
from collections import defaultdict

from commerce_lens.llm import exact_dedup
from tests.conftest import plan
from tests.llm.edge import SCHEMA, documents, stored


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check(rows, texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[norm(t)].append(i)
    first = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    assert len(rows) == len(texts)
    kept = defaultdict(int)
    for r in rows:
        t = norm(r["row"]["text"])
        assert (r["keep_id"], r["group_size"], r["sha"]) == (first[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest())
        assert not r["kept"] or r["row"]["doc_id"] == first[t]
        kept[t] += r["kept"]
    assert set(kept.values()) <= {1}


def test_edges_leave_one_row_of_each_text(spark, tmp_path):
    docs = stored(spark, documents(spark), tmp_path / "d")
    marked = exact_dedup.mark_copies(exact_dedup.digest_rows(docs), docs.count())
    check(marked.collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns and out.count() == 7


def test_a_crowded_filter_changes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 4096)
    rng = random.Random(3)
    texts = [(i, "hot" if rng.random() < 0.33 else f"text {rng.randrange(1500)}" + " " * rng.randrange(3)) for i in range(2500)]
    docs = stored(spark, documents(spark, texts), tmp_path / "d")
    check(exact_dedup.mark_copies(exact_dedup.digest_rows(docs), docs.count()).collect(), texts)


def test_rows_without_an_equal_are_not_shuffled(spark, tmp_path):
    docs = stored(spark, documents(spark, [(i, f"t{i % 900}") for i in range(1000)]), tmp_path / "d")
    hashed = exact_dedup.digest_rows(docs).cache()
    blocks = exact_dedup.MAX_BITS // exact_dedup.BLOCK_BITS
    found = exact_dedup.repeat_filter(hashed, min(blocks, 1000 * exact_dedup.BITS_PER_ROW // exact_dedup.BLOCK_BITS))
    assert 0 < found.count() <= 4
    assert "BroadcastHashJoin" in plan(exact_dedup.mark_copies(hashed, 1000))
    hashed.unpersist()


def test_an_empty_table(spark):
    assert exact_dedup.drop_copies(spark.createDataFrame([], SCHEMA)).count() == 0
