"""SimHash groups against all pairs."""

import random
from itertools import combinations

import pytest
import xxhash

from commerce_lens.llm import components, simhash
from tests.conftest import rows
from tests.llm.edge import SCHEMA, documents, stored


def print_of(text):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def closure(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_every_pair_in_reach_shares_a_table():
    for i, j in combinations(range(64), 2):
        assert any(not (m >> i & 1) and not (m >> j & 1) for m in simhash.masks())


@pytest.mark.parametrize("text", [None, "", " \n", "One", "two words", "ÀÉ Upper\x0bcase\x1cnot space", "a b c d e f g", "w " * 70_000])
def test_fingerprints(text):
    assert simhash._fingerprint(text) == signed(print_of(text))


def test_words_in_blocks_give_the_same_print(monkeypatch):
    text = " ".join(f"w{i * 7919 % 1000}" for i in range(500))
    for size in (1, 2, 3, 7, 499, 500):
        monkeypatch.setattr(simhash, "BLOCK_WORDS", size)
        assert simhash._fingerprint(text) == signed(print_of(text))


@pytest.mark.parametrize("bucket", [2, 32])
def test_links_reach_as_far_as_all_pairs(spark, monkeypatch, bucket):
    """Dense clouds, so that buckets of both kinds are used."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(bucket)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(40)}
    prints = sorted(map(signed, prints))
    near = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 2 or ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    got = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in got)
    assert closure(prints, got) == closure(prints, near)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5)]
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(90)]
    rng.shuffle(edges)
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    edges = [e for e in edges if e[0] != e[1]]
    nodes = {x for e in edges for x in e}
    assert got == closure(nodes, edges)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges_are_grouped_and_one_of_each_stays(spark, tmp_path):
    docs = stored(spark, documents(spark), tmp_path / "d")
    got = simhash.near_groups(docs).collect()
    assert len(got) == docs.count()
    texts = {(r["row"]["doc_id"], r["row"]["text"]): (r["component_id"], r["fp"]) for r in got}
    assert texts[(2, None)] == texts[(3, "")] == texts[(4, "  \t\n ")] == (2, 0)
    assert {c for (i, _), (c, _) in texts.items() if i is None} == {None}
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == [(None,), (1,), (2,), (5,), (7,), (8,)]


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_groups(empty).count() == 0 and simhash.drop_near_copies(empty).count() == 0
