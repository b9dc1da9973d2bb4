"""The language model: counts, gradients, whole documents, and better than counts alone."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from commerce_lens.llm import language_model as lm
from commerce_lens.llm.queries import QUERIES
from tests.llm.edge import SCHEMA, documents


def base(texts, rows):
    counts = Counter(w for i, t in texts if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for w in [*lm.tokens(t), b""])
    n, v = sum(counts.values()), len(counts)
    for r, (i, t) in zip(rows, texts, strict=True):
        own = [*lm.tokens(t), b""]
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert (r["id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, len(own), sum(counts[w] > 0 for w in own), n)
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 7 == 2)
        assert math.isclose(r["base_score"], want, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


@pytest.mark.parametrize("known", [3, 1 << 17])
def test_edges_and_words_beyond_the_known(spark, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    monkeypatch.setattr(lm, "WORDS", 2)
    df = documents(spark).repartition(2).cache()
    texts = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = lm.scores(df)
    rows = {(r["id"], r["n_tokens"]): r for r in got.collect()}
    assert got.count() == len(texts)
    base(texts, [rows[(i, len(lm.tokens(t)) + 1)] for i, t in texts])


def test_no_rows_and_no_training_rows(spark):
    assert lm.scores(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = lm.scores(documents(spark, [(held, "unknown words only")])).first()
    assert (got["n_known"], got["train_tokens"], got["base_score"]) == (0, 0, 0.0) and math.isfinite(got["score"])


def test_held_out_documents_score_better_than_counts(spark):
    got = QUERIES["op6_language_model"](spark, "/root/testdata/sf0.01").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and held.score.sum() > held.base_score.sum()


def vocabulary():
    words = [b"w%d" % i for i in range(30)]
    return lm.Vocabulary(words, [60 - i for i in range(30)], 2000, 80, 40)


def test_probabilities_of_one_step_add_up(monkeypatch):
    monkeypatch.setattr(lm, "CLASS", 8)
    net = lm.Network.first(vocabulary())
    net.flat += np.random.default_rng(0).normal(0, 0.2, net.flat.shape).astype(np.float32) * (net.flat > -1e8)
    state = np.random.default_rng(1).normal(0, 1, (1, lm.STATE)).astype(np.float32)
    each = [net.output(state, np.array([t]))[0][0] for t in range(net.size)]
    assert math.isclose(sum(map(math.exp, each)), 1, abs_tol=1e-5)


def test_gradients_match_differences(monkeypatch):
    monkeypatch.setattr(lm, "CLASS", 8)
    net = lm.Network.first(vocabulary())
    rng = np.random.default_rng(2)
    net.flat += rng.normal(0, 0.2, net.flat.shape).astype(np.float32) * (net.flat > -1e8)
    targets = rng.integers(0, net.size, (5, 3))
    targets[4, 2] = -1
    inputs = np.vstack([np.zeros((1, 3), dtype=int), np.maximum(targets[:-1], 0)])
    fresh = np.zeros((5, 3), dtype=bool)
    fresh[2, 1] = True
    h = rng.normal(0, 0.5, (3, lm.STATE)).astype(np.float32)

    def loss():
        state, total = h, 0.0
        for t in range(5):
            state = net.step(inputs[t], state * ~fresh[t][:, None])[0]
            own = targets[t] >= 0
            total -= net.output(state[own], targets[t][own])[0].sum()
        return total / 14

    grad, _ = net.window(inputs, targets, fresh, h)
    for k in [*rng.integers(0, len(net.flat), 60), *np.argsort(-np.abs(grad))[:30]]:
        if net.flat[k] < -1e8:
            continue
        old, eps = net.flat[k], np.float32(1e-2)
        net.flat[k] = old + eps
        up = loss()
        net.flat[k] = old - eps
        down = loss()
        net.flat[k] = old
        assert math.isclose((up - down) / (2 * eps), grad[k], rel_tol=0.05, abs_tol=2e-4)


def test_state_is_carried_across_windows(monkeypatch):
    net = lm.Network.first(vocabulary())
    net.flat += np.random.default_rng(3).normal(0, 0.2, net.flat.shape).astype(np.float32) * (net.flat > -1e8)
    docs = [np.append(np.random.default_rng(n).integers(1, net.size, n), lm.END) for n in (0, 1, 15, 16, 17, 100)]
    whole = net.log10(docs)
    for steps, side in ((1, 2), (7, 512), (500, 3)):
        monkeypatch.setattr(lm, "STEPS", steps)
        monkeypatch.setattr(lm, "SIDE_BY_SIDE", side)
        assert np.allclose(net.log10(docs), whole, rtol=1e-5)


def test_training_lowers_the_loss():
    v = vocabulary()
    docs = [np.append(np.arange(2, 30), lm.END) for _ in range(6000)]
    net = lm.Network.first(v)
    before = net.log10(docs[:3])
    assert net.train(iter(docs)) == 6000 * 29 and (net.log10(docs[:3]) > 0.7 * before).all()


def test_a_thousand_words_have_their_own_input_and_sixteen_states():
    words = [b"w%d" % i for i in range(3000)]
    v = lm.Vocabulary(words, [3000 - i for i in range(3000)], 10**7, 3001, 40)
    own = v.training_ids(words)
    assert (own[:1022] == np.arange(2, 1024)).all() and (own[1022:-1] == lm.OTHER).all()
    assert (own == v.model_ids(v.look_up(words))).all()
    assert lm.Network.first(v).un.shape == (16, 16)


def test_a_long_document_beside_short_ones_takes_few_windows(monkeypatch):
    net, calls, output = lm.Network.first(vocabulary()), [], lm.Network.output
    net.flat += np.random.default_rng(4).normal(0, 0.2, net.flat.shape).astype(np.float32) * (net.flat > -1e8)
    docs = [np.append(np.random.default_rng(n).integers(1, net.size, n), lm.END) for n in (20_000, 300, 20, 0)]
    monkeypatch.setattr(lm.Network, "output", lambda *args: calls.append(len(args[2])) or output(*args))
    got = net.log10(docs)
    assert sum(calls) == sum(map(len, docs)) and len(calls) < 20
    state, own = np.zeros((1, lm.STATE), dtype=np.float32), 0.0
    for before, after in zip(np.append(lm.END, docs[1][:-1]), docs[1]):
        state = net.step(np.array([before]), state)[0]
        own += output(net, state, np.array([after]))[0][0]
    assert math.isclose(got[1], own / math.log(10), rel_tol=1e-5)


def test_classes_share_all_but_their_products(monkeypatch):
    calls, exp = [], np.exp
    monkeypatch.setattr(lm, "CLASS", 8)
    net = lm.Network.first(vocabulary())
    monkeypatch.setattr(lm.np, "exp", lambda *args, **kwargs: calls.append(args) or exp(*args, **kwargs))
    net.output(np.zeros((64, lm.STATE), dtype=np.float32), np.arange(64) % net.size)
    assert net.classes == 4 and len(calls) == 2
