"""Decontamination: the search against scoring every entry, and whole documents."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from commerce_lens.llm import decontaminate as dc
from tests.conftest import SMALL, rows
from tests.llm.edge import SCHEMA, documents

RNG = random.Random(11)
WORDS = [f"w{i}" for i in range(400)]
WEIGHTS = [1 / (i + 1) for i in range(400)]


def index(n=60, length=(3, 40)):
    items = [(i, RNG.choices(WORDS, WEIGHTS, k=RNG.randint(*length))) for i in range(n)]
    df = Counter(w for _, own in items for w in set(own))
    weights = {w: np.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
    return dc.Index(items, {i: (own[: len(own) // 2], own[len(own) // 2 :]) for i, own in items}, weights, 20.0)


def all_scores(ix, query):
    scores = Counter()
    for t in query:
        for e, x in zip(*ix.postings[t]):
            scores[e] += x
    return scores


@pytest.mark.parametrize("theta", [0.1, 0.3, 0.5, 0.9])
def test_search_finds_what_scoring_everything_finds(theta):
    ix = index()
    for _ in range(60):
        words = RNG.choices(WORDS, WEIGHTS, k=RNG.randint(0, 60)) + (ix.entries[RNG.randrange(60)][1] if RNG.random() < 0.5 else [])
        query = {ix.vocabulary[w] for w in words if w in ix.vocabulary}
        want = {e: s for e, s in all_scores(ix, query).items() if s >= theta}
        got = dict(ix.search(query, theta))
        assert got.keys() == want.keys() and all(abs(got[e] - want[e]) < 1e-9 for e in got)


@pytest.mark.parametrize("theta", [0.3, 0.7])
def test_no_window_that_holds_an_entry_is_passed_over(theta):
    ix = index()
    texts = []
    for _ in range(40):
        own = RNG.choices(WORDS, WEIGHTS, k=RNG.randint(0, 700))
        at = RNG.randint(0, len(own))
        texts.append(" ".join(own[:at] + ix.entries[RNG.randrange(60)][1] + own[at:]) if RNG.random() < 0.6 else " ".join(own))
    terms = [ix.terms(t) for t in texts]
    for own, windows in zip(terms, ix.possible(terms, theta)):
        for w in range(-(-len(own) // dc.PIECE)):
            part = own[w * dc.PIECE : (w + 2) * dc.PIECE]
            if any(s >= theta for s in all_scores(ix, set(part[part >= 0].tolist())).values()):
                assert w in windows


@pytest.mark.parametrize("expanded", [1, 50, 1000])
def test_slices_find_the_same_windows(monkeypatch, expanded):
    ix = index()
    terms = [ix.terms(" ".join(RNG.choices([*WORDS, "unknown"], k=RNG.randint(0, 900)) + ix.entries[i][1])) for i in range(30)]
    whole = ix.possible(terms, 0.4)
    assert any(whole)
    monkeypatch.setattr(dc, "_EXPANDED", expanded)
    assert ix.possible(terms, 0.4) == whole


def test_a_full_shard_is_searched_in_bounded_memory():
    rng = np.random.default_rng(5)
    n = dc.SHARD_WORDS // dc.PIECE
    own = [[f"w{x}" for x in row] for row in (50_000 * rng.random((n, dc.PIECE)) ** 3).astype(int).tolist()]
    df = Counter(w for row in own for w in set(row))
    ix = dc.Index([(i, row) for i, row in enumerate(own)], {}, {w: np.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}, float(dc.PIECE))
    texts = [ix.terms(" ".join(f"w{x}" for x in (50_000 * rng.random(400) ** 3).astype(int))) for _ in range(64)]
    texts.append(ix.terms(" ".join(own[17])))
    tracemalloc.start()
    windows = ix.possible(texts, dc.THRESHOLD)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert windows[-1] == [0] and peak < 100e6


def test_every_leak_of_the_table_is_found_and_nothing_else(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    item_words = [(r["item_id"], " ".join(dc.words(r["text"]))) for r in items.collect()]
    want = sorted((r["doc_id"], i) for r in docs.collect() for i, q in item_words if q in " ".join(dc.words(r["text"])))
    assert rows(dc.contaminated(docs, items), "doc_id", "item_id") == want
    left = dc.drop_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - len({d for d, _ in want})


def test_shards_find_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = rows(dc.contaminated(docs, items))
    real = dc.build
    monkeypatch.setattr(dc, "build", lambda items: real(items, shard_words=300))
    assert rows(dc.contaminated(docs, items)) == whole


def test_edges(spark):
    item = "Which of the seven rivers runs north past the old copper mill? The seventh river does, in spring."
    docs = documents(spark, [(1, f"Before. {item.upper()} After."), (2, None), (3, ""), (None, item), (4, "which of the seven rivers " * 90), (1, f"Before. {item.upper()} After."),
                             (5, "filler word " * 3000 + item), (6, item.split("?")[0])])
    items = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "...", "x"), (None, "no id at all here", "x")], "item_id long, text string, doc_id string")
    assert rows(dc.contaminated(docs, items), "doc_id", "item_id") == [(None, 1), (1, 1), (1, 1), (5, 1)]
    assert rows(dc.drop_contaminated(docs, items), "doc_id") == [(2,), (3,), (4,), (6,)]
    assert dc.contaminated(docs, items.where("false")).count() == 0 and dc.drop_contaminated(docs, items.where("false")).count() == 8
    assert dc.contaminated(spark.createDataFrame([], SCHEMA), items).count() == 0


def test_questions_and_answers():
    assert dc.question_and_answer("One two. Three four? Five!") == (["one", "two", "three", "four"], ["five"])
    assert dc.question_and_answer("one two three") == (["one"], ["two", "three"]) and dc.question_and_answer(None) == ([], [])


def test_texts_without_id_and_several_texts_of_an_id(spark):
    a = "Which of the seven rivers runs north past the old copper mill? The seventh river does, in spring."
    b = "Who first drew the harbour map of the western isles? A blind pilot named Orlando drew it."
    c = "When do grey herons leave their winter marshes? Herons depart after two warm nights."
    docs = documents(spark, [(1, f"Before. {a} After."), (2, f"Before. {b} After."), (3, f"Before. {c} After."), (4, f"{a} {b} {c}"), (5, "None of these.")])
    items = spark.createDataFrame([(7, a), (7, b), (7, b), (None, c), (None, c), (None, None)], "item_id long, text string")
    assert rows(dc.contaminated(docs, items), "doc_id", "item_id") == [(1, 7), (2, 7), (3, None), (4, None), (4, 7)]
    assert rows(dc.drop_contaminated(docs, items), "doc_id") == [(5,)]


def test_an_id_of_many_texts_is_spread_over_shards(spark, monkeypatch):
    said = [f"Question {i} asks which of the {i} rivers past mill {i} turns copper green in year {i}? Answer {i} is river {i} of valley {i}." for i in range(40)]
    docs = documents(spark, [(1, said[3] + " " + said[31]), (1, said[3] + " " + said[31]), (1, said[5]), (2, said[7]), (None, said[8]), (3, "Nothing."), (4, None)])
    items = spark.createDataFrame([(9, t) for t in said] + [(None, said[7]), (None, said[31])], "item_id long, text string")
    whole = rows(dc.contaminated(docs, items))
    assert [r[:2] for r in whole] == [(None, 9), (1, None), (1, None), (1, 9), (1, 9), (1, 9), (2, None), (2, 9)]
    real = dc.build
    monkeypatch.setattr(dc, "build", lambda items: real(items, shard_words=100))
    shards = list(dc.build(items))
    assert len(shards) > 5 and max(len(s.entries) for s in shards) < 20
    assert rows(dc.contaminated(docs, items)) == whole
    assert rows(dc.drop_contaminated(docs, items), "doc_id") == [(3,), (4,)]
