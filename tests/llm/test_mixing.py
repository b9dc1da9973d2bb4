"""Source mixes against a loop over documents."""

import hashlib
import math
import random

import pytest

from commerce_lens.llm import mixing
from tests.llm.edge import documents, stored


def levels(sizes, share=1.5, most=2, weights=(5, 2, 1)):
    """Targets by giving the excess away again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    stopped, left = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in stopped]
        whole = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / whole > most * sizes[s]]
        if not over:
            return stopped | {s: left * weight[s] / whole for s in rest}
        for s in over:
            stopped[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(stopped.values())


def brute(rows):
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + (n or 0)
    wanted, out = levels(sizes), []
    for s, whole in sizes.items():
        own = [(hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), (i is not None, i or 0), n or 0, i) for i, x, n in rows if x == s]
        budget, before = math.floor(wanted[s] + 1e-9), 0
        for _, _, n, i in sorted(own):
            turns, rest = divmod(budget, whole) if whole else (0, 0)
            out.append((i, s, n, turns * n + max(0, min(n, rest - before))))
            before += n
    return wanted, sorted(out, key=str)


def check(found, rows):
    got = found.collect()
    wanted, out = brute(rows)
    assert sorted(((r["id"], r["source"], r["size"], r["taken"]) for r in got), key=str) == out
    taken, sizes = {}, {}
    for r in got:
        assert r["target"] == pytest.approx(wanted[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        sizes[r["source"]] = r["source_size"]
    assert all(abs(n - wanted[s]) <= 1 for s, n in taken.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_sources(spark, seed):
    rng = random.Random(seed)
    names = ["hot", "B", "a", "é", "", None, *(f"s{i}" for i in range(seed * 4))]
    rows = [(rng.choice([None, *range(200)]), "hot" if rng.random() < 0.4 else rng.choice(names), rng.choice([None, 0, 1, 7, rng.randrange(2000)])) for _ in range(600)]
    check(mixing.mix(spark.createDataFrame(rows, "id long, source string, size long")), rows)


def test_sources_that_stop_and_one_that_fills_up(spark):
    rows = [(1, "a", 1), (2, "b", 1000), (3, "c", 1000), (4, None, 0)]
    check(mixing.mix(spark.createDataFrame(rows, "id long, source string, size long")), rows)


def test_many_sources(spark):
    rows = [(i, f"s{i % 500:03}", i % 37) for i in range(2000)]
    check(mixing.mix(spark.createDataFrame(rows, "id long, source string, size long")), rows)


def test_repeated_rows_and_carried_columns(spark):
    df = spark.createDataFrame([(1, "a", 10, "x")] * 50 + [(2, "b", 3, "y")], "id long, source string, size long, target2 string")
    found = mixing.mix(df, carry=["target2"])
    assert found.columns == ["id", "source", "target2", "size", "source_size", "target", "taken"]
    check(found, [(1, "a", 10)] * 50 + [(2, "b", 3)])


def test_reruns_agree_and_edges(spark, tmp_path):
    docs = stored(spark, documents(spark), tmp_path / "d")
    sized = docs.select(docs.doc_id.alias("id"), "source", mixing.n_words(docs.text).alias("size"))
    one, two = (sorted(map(str, mixing.mix(sized).collect())) for _ in range(2))
    assert one == two
    check(mixing.mix(sized), [tuple(r) for r in sized.collect()])


def test_words_are_cut_at_ascii_space_only(spark):
    texts = ["", None, " \t\n", "a b", " a b c  d\x0be", "x" * 100_000, "w " * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixing.n_words(df.text)).collect()] == [0, 0, 0, 2, 3, 1, 100_000]


def test_empty_and_wordless_tables(spark):
    empty = spark.createDataFrame([], "id long, source string, size long")
    assert mixing.mix(empty).count() == 0
    none = spark.createDataFrame([(1, "a", 0), (2, None, None)], "id long, source string, size long")
    assert [(r["taken"], r["target"]) for r in mixing.mix(none).collect()] == [(0, 0.0)] * 2
