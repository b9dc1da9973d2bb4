"""Repeated spans against a dictionary of runs."""

import random
from collections import Counter, defaultdict

from commerce_lens.llm import span_dedup as sd
from tests.conftest import SMALL
from tests.llm.edge import SCHEMA, documents, stored


def brute(texts):
    """Texts in order of id without the runs that stand earlier."""
    seen, covered = set(), defaultdict(list)
    for k, (_, t) in enumerate(texts):
        for h, i, j in sd.runs(t):
            if h in seen:
                covered[k].append({"first": i, "last": j})
            seen.add(h)
    return [sd.without(t, covered[k])[0] if covered[k] else t for k, (_, t) in enumerate(texts)]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = sorted(map(tuple, docs.collect()))
    got = {r["row"]["doc_id"]: r["text"] for r in sd.dedup_spans(docs).collect()}
    assert [got[i] for i, _ in texts] == brute(texts)

    def grams(t):
        own = t.split()
        return {tuple(own[i : i + 50]) for i in range(len(own) - 49)}

    assert max(Counter(g for t in got.values() for g in grams(t)).values()) == 1


def test_a_passage_goes_wherever_it_stands_but_first(spark, tmp_path):
    rng = random.Random(4)

    def words(n):
        return " ".join(f"{rng.getrandbits(30):x}" for _ in range(n))

    passage = " ".join(words(rng.randint(4, 20)).capitalize() + "." for _ in range(6))
    long = words(70)  # one sentence
    texts = [(i, f"{words(30)} {passage if i % 2 else long} {words(30)}. {words(9)}.") for i in range(30)]
    docs = stored(spark, documents(spark, texts), tmp_path / "d")
    got = {r["row"]["doc_id"]: r for r in sd.dedup_spans(docs).collect()}
    assert all(got[i]["text"] == texts[i][1] and got[i]["removed"] == [] for i in (0, 1))
    for i in range(2, 30):
        own = (passage if i % 2 else long).split()
        left = got[i]["text"].split()
        assert sum(w in left for w in own) <= 25 and got[i]["from_ids"][0] == i % 2
        assert texts[i][1].split()[:25] == left[:25]


def test_sentences_and_runs():
    assert sd.sentences(None) == [] and sd.sentences(" \n ") == []
    text = "One two.  Three!\n\nFour five six? seven"
    assert [text[s:e] for s, e, _ in sd.sentences(text)] == ["One two.", "Three!", "Four five six?", "seven"]
    assert sd.runs("One two. Three. Four.") == []  # too few words
    assert sd.without(text, [{"first": 1, "last": 2}])[0] == "One two.  seven"


def test_edges(spark, tmp_path):
    docs = stored(spark, documents(spark), tmp_path / "d")
    got = sd.dedup_spans(docs).collect()
    assert len(got) == docs.count()
    texts = defaultdict(list)
    for r in got:
        texts[r["row"]["doc_id"]].append((r["row"]["text"], r["text"]))
    assert texts[2] == [(None, None)] and texts[3] == [("", "")] and texts[7] == [("x", "x")]
    assert all(len(new) < 200 for _, new in texts[5])  # it repeats itself, and its copy
    assert sd.dedup_spans(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_end_of_a_passage_goes_with_it(spark, tmp_path):
    passage = "A b c d e f g h i j. K. L. M. N."
    docs = stored(spark, documents(spark, [(1, f"One. {passage} Two."), (2, f"Three. {passage} Four.")]), tmp_path / "d")
    got = {r["row"]["doc_id"]: r["text"].split() for r in sd.dedup_spans(docs).collect()}
    assert got == {1: f"One. {passage} Two.".split(), 2: ["Three.", "Four."]}


def test_every_passage_of_fifty_words_shares_a_run():
    """In the middle of sentences, with end marks and without, of many words and of few."""
    rng = random.Random(8)
    for k in range(3000):
        names = [f"{rng.getrandbits(30):x}" for _ in range(rng.choice([1, 2, 4, 5000]))]
        marks = rng.choice([0, 0, 0.03, 0.1, 0.3])
        passage = " ".join(rng.choice(names) + "." * (rng.random() < marks) for _ in range(50 + k % 2))
        around = [" ".join(f"{rng.getrandbits(30):x}" for _ in range(rng.randint(0, 30))) for _ in range(4)]
        texts = [f"{a} {passage} {b}" for a, b in zip(around[:2], around[2:])]
        one, two = ({h for h, _, _ in sd.runs(t)} for t in texts)
        assert one & two, texts


def test_no_part_of_a_long_sentence_is_longer_than_a_window():
    rng = random.Random(9)
    for n in (11, 12, 100, 1000):
        text = " ".join(f"{rng.getrandbits(30):x}" for _ in range(n))
        parts = sd.sentences(text)
        assert max(w for _, _, w in parts) <= 8 and " ".join(text[s:e] for s, e, _ in parts) == text
