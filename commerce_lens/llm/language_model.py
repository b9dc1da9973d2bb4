"""Scoring texts with a gated recurrent language model.

Words are counted over all training documents in Spark. The most frequent ones, an end mark and a mark for every other
word are the model's vocabulary; the output is factored into frequency classes, so a token costs two small softmaxes. A word
outside the vocabulary has the probability of its mark times its smoothed share of the counts outside.

Training covers every training document once. The documents are dealt into ROUNDS by a hash; in a round
each Spark task runs truncated backpropagation through its own documents from the same weights, and Spark averages
the tasks' weights by their tokens. Scoring carries the state across windows through the whole document.

Counts beyond the KNOWN most frequent words are never collected: such words leave the scoring tasks as rows and meet
their counts in a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lens.session import cut_lineage

# Words whose counts are broadcast at most, words of the model, words of a class, size of the state.
KNOWN = 1 << 17
WORDS = 1022
CLASS = 32
STATE = 16
ROUNDS = 3
# Documents side by side in training, steps of a window, documents side by side in scoring.
STREAMS = 128
STEPS = 16
SIDE_BY_SIDE = 512
# Documents scored together at least, so that those of like length stand side by side.
TOGETHER = 4000
# Of a training step: its rate, the memories of slope and size, and what keeps rare weights from large steps.
RATE, DECAY, SLOW_DECAY, CAUTION = 0.02, 0.9, 0.99, 1e-4
STRETCH = 256
# Distinct words that a counting task holds before it hands them on.
_HELD = 400_000
END, OTHER = 0, 1


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, without the end."""
    return (text or "").encode().lower().split()


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training; a row without id isn't."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(False))


# -- counts --------------------------------------------------------------------------------


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    own: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            own.update(tokens(text))
            own[b""] += 1
            if len(own) > _HELD:
                yield pd.DataFrame({"word": list(own.keys()), "n": list(own.values())})
                own.clear()
    yield pd.DataFrame({"word": list(own.keys()), "n": list(own.values())})


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts (`text`); the end of a text is the empty word."""
    return texts.select("text").mapInPandas(_tally, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """What scoring needs of the counts: the most frequent words, and totals of all."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, ends: int):
        self.total, self.distinct = total, distinct
        self.ids = {w: i for i, w in enumerate(words)}
        self.counts = np.array(counts, dtype=np.int64)
        self.ends = ends
        self.size = 2 + min(len(words), WORDS)
        self.few = {w: i + 2 for i, w in enumerate(words[:WORDS])}
        inside = int(self.counts[: self.size - 2].sum()) + ends
        self.outside = total - inside
        self.outside_whole = self.outside + distinct - (self.size - 2) - (1 if ends else 0) + 1
        self.log_base = math.log10(total + distinct + 1)
        self.log_outside = math.log10(max(1, self.outside_whole))
        self.log_counts = np.log10(self.counts + 1.0)

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """Places among the most frequent words; -1 for the others."""
        return np.fromiter(map(self.ids.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def model_ids(self, places: np.ndarray) -> np.ndarray:
        """The model's ids of a document from the places of its words: these, then the end."""
        ids = np.where((places >= 0) & (places < self.size - 2), places + 2, OTHER)
        return np.append(ids, END)

    def training_ids(self, words: list[bytes]) -> np.ndarray:
        """The same from the words themselves, by the model's few words alone."""
        ids = np.fromiter(map(self.few.get, words, repeat(OTHER)), dtype=np.int64, count=len(words))
        return np.append(ids, END)


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n"), F.sum(F.when(F.octet_length("word") == 0, F.col("n"))).alias("ends")).first()
    # Words of one count are known together or not at all, so that only the known ones are ever collected.
    named = counts.where(F.octet_length("word") > 0)
    sizes = named.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(KNOWN).collect()
    room, least = KNOWN, None
    for size in sizes:
        if size["words"] > room:
            break
        room, least = room - size["words"], size["n"]
    top = named.where(F.lit(False) if least is None else F.col("n") >= least).toPandas()
    top["word"] = top["word"].map(bytes)
    top = top.sort_values(["n", "word"], ascending=[False, True])
    words = top["word"].tolist()
    return Vocabulary(words, top["n"].tolist(), int(total["n"] or 0), int(total["v"]), int(total["ends"] or 0))


# -- network ---------------------------------------------------------------------------------


class Network:
    """A gated recurrent unit with class-factored output; all weights are one flat vector.

    The last weights of `wc` and `ww` are biases, which a state of one meets.
    """

    def __init__(self, size: int, flat: np.ndarray | None = None):
        self.size, self.classes = size, -(-size // CLASS)
        h, c = STATE, self.classes
        shapes = {"x": (size, 3 * h), "u": (h, 2 * h), "un": (h, h), "wc": (h + 1, c), "ww": (c, CLASS, h + 1)}
        self.flat = np.zeros(sum(math.prod(s) for s in shapes.values()), dtype=np.float32) if flat is None else flat.astype(np.float32)
        at = 0
        self.views: dict[str, tuple[int, int, tuple]] = {}
        for name, shape in shapes.items():
            n = math.prod(shape)
            self.views[name] = (at, at + n, shape)
            at += n
        for name in shapes:
            setattr(self, name, self.part(self.flat, name))

    def part(self, flat: np.ndarray, name: str) -> np.ndarray:
        low, high, shape = self.views[name]
        return flat[low:high].reshape(shape)

    @classmethod
    def first(cls, v: Vocabulary) -> Network:
        """Small random weights; the biases give every token its share of the counts."""
        net, rng = cls(v.size), np.random.default_rng(7)
        net.x[:] = rng.normal(0, 0.3, net.x.shape)
        net.u[:] = rng.normal(0, 0.25, net.u.shape)
        net.un[:] = rng.normal(0, 0.25, net.un.shape)
        share = np.zeros(net.classes * CLASS)
        share[:2] = v.ends + 1, v.outside + 1
        share[2 : v.size] = v.counts[: v.size - 2] + 1
        share = share.reshape(net.classes, CLASS)
        net.wc[-1] = np.log(share.sum(axis=1) / share.sum())
        net.ww[:, :, -1] = np.where(share > 0, np.log(np.maximum(share, 1) / share.sum(axis=1, keepdims=True)), -1e9)
        return net

    def step(self, ids: np.ndarray, h: np.ndarray) -> tuple:
        """The states (rows) after one token each, both gates and the candidates."""
        gates, n, new = (np.empty((k * STATE, len(h)), dtype=np.float32) for k in (2, 1, 1))
        self._move(self._turned(), self.x[ids].T, np.ascontiguousarray(h.T), gates, n, new)
        return new.T, gates.T, n.T

    def _turned(self) -> tuple[np.ndarray, np.ndarray]:
        """What _move takes: the gates' weights turned and negated, as the logistic function wants them, and the candidate's turned."""
        return np.ascontiguousarray(-self.u.T), np.ascontiguousarray(self.un.T)

    @staticmethod
    def _move(turned: tuple, x: np.ndarray, h: np.ndarray, gates: np.ndarray, n: np.ndarray, new: np.ndarray) -> None:
        """Fills both gates, candidates and new states; here and in a window a stream is a column, so that every part is one block."""
        np.matmul(turned[0], h, out=gates)
        gates -= x[: 2 * STATE]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.matmul(turned[1], gates[STATE:] * h, out=n)
        n += x[2 * STATE :]
        np.tanh(n, out=n)
        np.subtract(n, h, out=new)
        new *= gates[:STATE]
        new += h

    def output(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of the targets after the states; with grads, also the states' gradient.

        Targets are put in order of their class, so that a class is a slice and all but its products is done for all at once.
        """
        cls, word = targets // CLASS, targets % CLASS
        states = np.concatenate([states, np.ones((len(states), 1), dtype=np.float32)], axis=1)
        e = states @ self.wc
        flat, hit = e.reshape(-1), np.arange(len(targets)) * self.classes + cls
        logp = flat[hit]
        np.exp(e, out=e)
        whole = e.sum(axis=1, keepdims=True)
        logp -= np.log(whole[:, 0])
        back = None
        if grads is not None:
            e /= whole
            flat[hit] -= 1
            grads["wc"][:-1] = states[:, :-1].T @ e
            grads["wc"][-1] = e.sum(axis=0)
            back = e @ self.wc[:-1].T
        order = np.argsort(cls.astype(np.int16), kind="stable")
        placed = np.empty_like(order)
        placed[order] = np.arange(len(order))
        cuts = np.concatenate([[0], np.cumsum(np.bincount(cls, minlength=self.classes))]).tolist()
        used = [(c, cuts[c], cuts[c + 1]) for c in range(self.classes) if cuts[c] < cuts[c + 1]]
        s, e = states.take(order, axis=0), np.empty((len(order), CLASS), dtype=np.float32)
        for c, low, high in used:
            np.matmul(s[low:high], self.ww[c].T, out=e[low:high])
        flat, hit = e.reshape(-1), np.arange(len(order)) * CLASS + word[order]
        within = flat[hit]
        np.exp(e, out=e)
        whole = e.sum(axis=1, keepdims=True)
        within -= np.log(whole[:, 0])
        logp += within[placed]
        if grads is not None:
            e /= whole
            flat[hit] -= 1
            inner = np.empty_like(back)
            for c, low, high in used:
                own = e[low:high]
                np.matmul(own.T, s[low:high], out=grads["ww"][c])
                np.matmul(own, self.ww[c, :, :-1], out=inner[low:high])
            back += inner.take(placed, axis=0)
        return logp, back

    def window(self, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(gradient, last state) of one window of (steps, streams) arrays from the state h.

        A target of -1 is padding; where `fresh`, a stretch begins with the empty state.
        """
        flat = np.zeros(len(self.flat), dtype=np.float32)
        grads = {name: self.part(flat, name) for name in self.views}
        # Steps whose streams all go on have nothing to empty.
        keep = [~own if some else None for own, some in zip(fresh, fresh.any(axis=1).tolist())]
        steps, streams = inputs.shape
        x, turned = np.ascontiguousarray(self.x.take(inputs, axis=0).transpose(0, 2, 1)), self._turned()
        before, states, candidates = np.empty((3, steps, STATE, streams), dtype=np.float32)
        gates = np.empty((steps, 2 * STATE, streams), dtype=np.float32)
        last = np.ascontiguousarray(h.T)
        for t in range(steps):
            before[t] = last if keep[t] is None else last * keep[t]
            last = states[t]
            self._move(turned, x[t], before[t], gates[t], candidates[t], last)
        targets, dstates = targets.reshape(-1), states.transpose(0, 2, 1).reshape(-1, STATE)
        valid = targets >= 0
        if valid.all():
            _, dstates = self.output(dstates, targets, grads)
        else:
            _, back = self.output(dstates[valid], targets[valid], grads)
            dstates = np.zeros_like(dstates)
            dstates[valid] = back
        dstates = np.ascontiguousarray(dstates.reshape(steps, streams, STATE).transpose(0, 2, 1))
        dh = np.zeros((STATE, streams), dtype=np.float32)
        dx, rows = np.empty((3 * STATE, streams), dtype=np.float32), np.empty((steps, streams, 3 * STATE), dtype=np.float32)
        dg, dn = dx[: 2 * STATE], dx[2 * STATE :]
        gone, slope, drift = 1 - gates, 1 - candidates * candidates, candidates - before
        z, r = gates[:, :STATE], gates[:, STATE:]
        for t in range(steps - 1, -1, -1):
            dh += dstates[t]
            np.multiply(dh, z[t], out=dn)
            dn *= slope[t]
            drh = self.un @ dn
            np.multiply(dh, drift[t], out=dg[:STATE])
            np.multiply(drh, before[t], out=dg[STATE:])
            dg *= gates[t]
            dg *= gone[t]
            dh *= gone[t, :STATE]
            drh *= r[t]
            dh += drh
            rows[t] = dx.T
            dh += (rows[t, :, : 2 * STATE] @ self.u.T).T
            if keep[t] is not None:
                dh *= keep[t]
        # The last step comes first in both sums, as it does on the way back.
        for name, met, own in (("u", before, rows[..., : 2 * STATE]), ("un", r * before, rows[..., 2 * STATE :])):
            met = np.ascontiguousarray(met.transpose(0, 2, 1))
            np.matmul(met[::-1].transpose(0, 2, 1), own[::-1]).sum(axis=0, out=grads[name])
        self._add_rows(grads["x"], inputs.reshape(-1), rows.reshape(-1, 3 * STATE))
        flat /= max(1, int(valid.sum()))
        return flat, last.T

    @staticmethod
    def _add_rows(sums: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Sets sums[i] to the sum of the rows of each id i that occurs; most ids do once and need no sum."""
        order = np.argsort(ids.astype(np.int16) if len(sums) < 1 << 15 else ids, kind="stable")
        ids = ids[order]
        starts = np.empty(len(ids), dtype=bool)
        starts[0] = True
        np.not_equal(ids[1:], ids[:-1], out=starts[1:])
        once = starts.copy()
        once[:-1] &= starts[1:]
        sums[ids[once]] = rows[order[once]]
        order, starts = order[~once], starts[~once]
        if len(order):
            firsts = np.flatnonzero(starts)
            sums[ids[~once][firsts]] = np.add.reduceat(rows[order], firsts, axis=0)

    def train(self, docs: Iterator[np.ndarray]) -> int:
        """Truncated backpropagation through every document once, STREAMS side by side; returns the tokens seen.

        A document is dealt out in stretches of STRETCH tokens, so that a long one doesn't leave
        the other streams idle. A stretch knows the token before it and starts from the empty state.
        """

        def stretches() -> Iterator[np.ndarray]:
            for doc in docs:
                rows = np.zeros((len(doc), 3), dtype=np.int64)
                rows[0, 0], rows[1:, 0], rows[:, 1] = END, doc[:-1], doc
                rows[::STRETCH, 2] = 1
                for i in range(0, len(doc), STRETCH):
                    yield rows[i : i + STRETCH]

        dealt, seen, steps = stretches(), 0, 0
        # What each stream still has, from `at` to `upto`; less than a window and one more stretch.
        rest = np.zeros((STREAMS, STEPS + STRETCH, 3), dtype=np.int64)
        at, upto, more = np.zeros(STREAMS, dtype=np.int64), np.zeros(STREAMS, dtype=np.int64), True
        h = np.zeros((STREAMS, STATE), dtype=np.float32)
        mean, square, part = np.zeros_like(self.flat), np.zeros_like(self.flat), np.empty_like(self.flat)
        while True:
            for i in np.flatnonzero(upto - at < STEPS).tolist() if more else ():
                held = upto[i] - at[i]
                rest[i, :held] = rest[i, at[i] : upto[i]].copy()
                while held < STEPS and (own := next(dealt, None)) is not None:
                    rest[i, held : held + len(own)] = own
                    held += len(own)
                more = more and held >= STEPS
                at[i], upto[i] = 0, held
            live = np.flatnonzero(at < upto)
            if not len(live):
                return seen
            places = at[live] + np.arange(STEPS)[:, None]
            held = places < upto[live]
            rows = rest.reshape(-1, 3).take(np.minimum(places, rest.shape[1] - 1) + live * rest.shape[1], axis=0)
            if not held.all():
                rows[~held] = 0, -1, 0
            at[live] = np.minimum(at[live] + STEPS, upto[live])
            grad, h[live] = self.window(rows[..., 0], rows[..., 1], rows[..., 2] > 0, h[live])
            seen += int(held.sum())
            steps += 1
            np.subtract(grad, mean, out=part)
            part *= 1 - DECAY
            mean += part
            grad *= grad
            grad -= square
            grad *= 1 - SLOW_DECAY
            square += grad
            rate = RATE * math.sqrt(1 - SLOW_DECAY**steps) / (1 - DECAY**steps)
            np.sqrt(square, out=part)
            part += CAUTION
            np.multiply(mean, rate, out=grad)
            grad /= part
            self.flat -= grad

    def log10(self, docs: list[np.ndarray]) -> np.ndarray:
        """The log10 probability of each whole document, the state carried from window to window."""
        out, turned = np.zeros(len(docs)), self._turned()
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        for low in range(0, len(order), SIDE_BY_SIDE):
            group = order[low : low + SIDE_BY_SIDE]
            lengths = np.array([len(docs[i]) for i in group])
            firsts = np.cumsum(lengths) - lengths
            flat = np.concatenate([docs[i] for i in group])
            h = np.zeros((STATE, len(group)), dtype=np.float32)
            last = np.full(len(group), END)
            start = 0
            while start < lengths[0]:
                live = int((lengths > start).sum())  # the longest come first
                # The fewer are left, the longer the window.
                steps = min(STEPS * max(1, SIDE_BY_SIDE // live), int(lengths[0]) - start)
                places = np.arange(start, start + steps)[:, None]
                valid = places < lengths[:live]
                targets = flat[np.minimum(places, lengths[:live] - 1) + firsts[:live]].astype(np.int64)
                inputs = np.concatenate([last[None, :live], np.where(valid, targets, END)])
                last, x = inputs[-1], np.ascontiguousarray(self.x.take(inputs[:-1], axis=0).transpose(0, 2, 1))
                h, states = np.ascontiguousarray(h[:, :live]), np.empty((steps, STATE, live), dtype=np.float32)
                gates, n = (np.empty((k * STATE, live), dtype=np.float32) for k in (2, 1))
                for t in range(steps):
                    self._move(turned, x[t], h, gates, n, states[t])
                    h = states[t]
                at = np.flatnonzero(valid)
                logp, _ = self.output(states.transpose(0, 2, 1).reshape(-1, STATE).take(at, axis=0), targets.reshape(-1)[at])
                out[group[:live]] += np.bincount(at % live, weights=logp, minlength=live)
                start += steps
        return out / math.log(10)


# -- training and scoring in Spark ---------------------------------------------------------------


def _trainer(known, start):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = known.value
        net = Network(v.size, start.value)
        docs = (v.training_ids(tokens(text)) for batch in batches for text in batch["text"])
        seen = net.train(docs)
        if seen:
            yield pd.DataFrame({"at": np.arange(len(net.flat)), "value": net.flat.astype(np.float64) * seen, "seen": seen})

    return run


def fit(texts: DataFrame, v: Vocabulary, known) -> np.ndarray:
    """The weights after all rounds over the rows of `texts` (id, text)."""
    weights = Network.first(v).flat
    place = F.pmod(F.xxhash64("id", F.lit("round")), F.lit(ROUNDS))
    for r in range(ROUNDS):
        start = texts.sparkSession.sparkContext.broadcast(weights)
        tuned = texts.where(place == r).select("text").mapInPandas(_trainer(known, start), "at int, value double, seen long")
        mean = tuned.groupBy("at").agg((F.sum("value") / F.sum("seen")).alias("value")).toPandas()
        if len(mean):
            weights = np.zeros_like(weights)
            weights[mean["at"].to_numpy()] = mean["value"].to_numpy()
    return weights


def _scorer(known, weights):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = known.value
        net = Network(v.size, weights.value)
        ids, parts, keys = [], [], []

        def scored() -> pd.DataFrame:
            out = pd.DataFrame(parts, columns=["n_tokens", "n_inside", "log_inside", "log_outside", "n_other", "rare"])
            return pd.concat([pd.concat(keys, ignore_index=True), out.assign(model=net.log10(ids))], axis=1)

        for batch in batches:
            for text in batch["text"]:
                words = tokens(text)
                places = v.look_up(words)
                inside = places >= 0
                logs = v.log_counts[places[inside]]
                outside = places[inside] >= v.size - 2
                own = v.model_ids(places)
                ids.append(own.astype(np.int32))
                rare = [words[i] for i in np.flatnonzero(~inside)]
                parts.append((len(own), int(inside.sum()), float(logs.sum()), float(logs[outside].sum()), int((own == OTHER).sum()), rare))
            keys.append(batch[["no", "id", "held_out"]])
            if len(ids) >= TOGETHER:
                yield scored()
                ids, parts, keys = [], [], []
        if keys:
            yield scored()

    return run


def scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of df.

    Null, empty and blank texts are their end alone. Repeated rows are counted and scored each. Without training
    rows every word is unknown. Other columns don't matter. An empty table gives no rows.
    """
    spark: SparkSession = df.sparkSession
    rows = df.select(F.monotonically_increasing_id().alias("no"), F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    training = rows.where(~F.col("held_out"))
    counts = cut_lineage(count_words(training), "words")
    v = vocabulary(counts)
    known = spark.sparkContext.broadcast(v)
    weights = spark.sparkContext.broadcast(fit(training, v, known))
    schema = (
        "no long, id long, held_out boolean, n_tokens long, n_inside long, log_inside double, log_outside double, n_other long, "
        "rare array<binary>, model double"
    )
    seen = cut_lineage(rows.mapInPandas(_scorer(known, weights), schema), "scored")
    rare = seen.select("no", F.explode("rare").alias("word")).join(counts, "word")
    rare = rare.groupBy("no").agg(F.count(F.lit(1)).alias("n_rare"), F.sum(F.log10(F.col("n") + 1)).alias("log_rare"))
    both = seen.drop("rare").join(rare, "no", "left").fillna(0, ["n_rare", "log_rare"])
    end, ends = math.log10(v.ends + 1), 1 if v.ends else 0
    whole = F.col("log_inside") + F.col("log_rare") + end
    outside = F.col("log_outside") + F.col("log_rare")
    return both.select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("n_inside") + F.col("n_rare") + ends).alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"),
        (whole - F.col("n_tokens") * v.log_base).alias("base_score"),
        (F.col("model") + outside - F.col("n_other") * v.log_outside).alias("score"),
    )
