"""Hard negatives against all inner products."""

import math
import random

import numpy as np
import pytest

from commerce_lens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec string, `window` int, rank int"


def brute(rows):
    """Sorted results; rows of (id, vector, label) by the contract, one result set for each anchor row."""
    use = [
        (i, (l + 1) % 10 if i % 7 == 0 else l, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, l in rows
        if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, l, v in use:
        if i % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in use if j != i)
        for s, j, _ in [x for x in scores if x[2] == l][:5]:
            fit = [x for x in scores if x[2] != l and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, k, x[1], -s, -x[0]) for k, x in enumerate(fit, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)


def found(df):
    return sorted(map(tuple, df.collect()))


def vectors(rng, n, dim=8, clusters=0):
    middle = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(clusters)]
    for i in range(n):
        m = rng.choice(middle) if clusters else [0] * dim
        yield i, [a + rng.gauss(0, 0.05 if clusters else 1) for a in m], rng.randrange(10)


@pytest.mark.parametrize("clusters", [0, 12])
@pytest.mark.parametrize("shard", [2, 2048])
def test_random_vectors(spark, monkeypatch, clusters, shard):
    monkeypatch.setattr(hn, "SHARD", shard)
    rows = list(vectors(random.Random(clusters), 500, clusters=clusters))
    assert found(hn.hard_negatives(frame(spark, rows))) == brute(rows) != []


def test_hot_vectors_labels_and_ties(spark):
    rng = random.Random(2)
    rows = list(vectors(rng, 600))
    hot = rows[3][1]
    rows = [(i, hot if i % 3 == 0 and i % 100 else [float(round(x)) for x in v], 4 if i % 2 else l) for i, v, l in rows]
    assert found(hn.hard_negatives(frame(spark, rows))) == brute(rows)


def test_edges(spark):
    nan, far = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [0.5, 0.5], 2), (1, [0.9, 0.1], 1), (1, [0.9, 0.1], 1), (2, [0.5], 2), (3, [], 3), (4, None, 1), (5, [1.0, None], 1),
        (6, [nan, 1.0], 1), (8, [far, 1.0], 1), (9, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (-100, [0.3, 0.3, 0.3], 9), (-7, [0.4, 0.1], -1), (10, [-1.0, 0.0], 1),
        (200, [0.7, 0.1], 1), (200, [0.7, 0.1], 1), (11, [0.4, 0.0], 5), (12, [0.4, 0.0], 5),
    ]
    got = found(hn.hard_negatives(frame(spark, rows)))
    want = brute([(i, v, l) for i, v, l in rows])
    assert got == want != []
    assert hn.hard_negatives(frame(spark, [])).count() == 0
    assert hn.hard_negatives(frame(spark, rows[2:4])).count() == 0  # no anchor


def test_huge_components_are_exact(spark):
    rows = [(0, [3e5, 1.0], 1), (1, [2e5, 3.0], 1), (2, [1e5, 1.0], 2), (3, [1.0, 1.0], 2), (4, [70000.0, 70000.0], 3)]
    assert found(hn.hard_negatives(frame(spark, rows))) == brute(rows) != []
    assert hn.hard_negatives(frame(spark, [(0, [3e38], 1), (1, [3e38], 1), (2, [3e38], 2)])).count() == 0


def test_bounds_spare_scores_of_near_anchors():
    rng = random.Random(1)
    own = list(vectors(rng, 2000, clusters=20))
    ids, labels = np.array([r[0] for r in own]), np.array([r[2] % 2 for r in own])
    vecs = hn.scaled([r[1] for r in own])
    at = np.flatnonzero(ids % 10 == 0)
    shard = hn.Shard(ids[at], labels[at], vecs[at], hn.spanning_tree(vecs[at]))
    windows = hn.start(shard, [(a, -hn._FAR, hn._FAR) for a in range(len(at))], True, 5)
    search = hn.Search(shard, windows, True, 5)
    search.add(ids, labels, vecs)
    assert search.rescored < 0.5 * (labels[:, None] == labels[at]).sum()


def test_the_tree_is_a_minimum_spanning_tree():
    rng = np.random.default_rng(3)
    points = rng.integers(-50, 50, (60, 3)).astype(float)
    tree = hn.spanning_tree(points)
    place = {a: k for k, a in enumerate(tree.order.tolist())}
    assert sorted(place) == list(range(60)) and all(place[tree.parent[a]] < place[a] for a in tree.order[1:])
    edges = sorted((np.linalg.norm(points[i] - points[j]), i, j) for i in range(60) for j in range(i))
    group, total = list(range(60)), 0.0
    for d, i, j in edges:
        if group[i] != group[j]:
            old, new, total = group[i], group[j], total + d
            group = [new if g == old else g for g in group]
    assert tree.edge.sum() == pytest.approx(total)
    assert hn.spanning_tree(np.zeros((1, 4))).order.tolist() == [0]
