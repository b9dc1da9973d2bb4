"""Quality classifier: a support vector machine on naive Bayes features.

Features are the words, punctuation runs and pairs of neighbours of a text, hashed into BUCKETS
bins; a bin is in a text or not. Each bin is scaled by the logarithm of how much more often it is in
texts of class 1 than of class 0, counted over all labelled training rows. A linear model with
squared hinge loss is then fitted by dual coordinate descent, and its weights are drawn
towards their mean size.

Counting, the features of the sample and scoring run as Spark tasks; what reaches the driver
are BUCKETS numbers. Only the fit reads a bounded sample: at most SAMPLE_ROWS labelled rows, taken in
hash order of their ids, and of these the first that have SAMPLE_FEATURES features together.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
SAMPLE_ROWS = 8192
SAMPLE_FEATURES = 8_000_000
# Labels up to this many rows are broadcast to the texts (16 bytes each); more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
# How much of the fitted weights is kept against their mean size.
INTERPOLATION = 0.25
STEEPNESS = 4.0

_TOKENS = re.compile(r"\w+|[^\w\s]+")
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_MEMO_SIZE = 150_000


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) > _MEMO_SIZE:
            self.clear()
        self[token] = value = zlib.crc32(token.encode()) + 1
        return value


_HASHES = _Hashes()


def features(text: str | None) -> np.ndarray:
    """The distinct bins of a text, ascending; none for a null or blank text."""
    tokens = _TOKENS.findall(text or "")
    if not tokens:
        return np.empty(0, dtype=np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    with np.errstate(over="ignore"):
        one = h * _PAIR
        two = (one[:-1] + h[1:] * np.uint64(3)) * _PAIR
    return np.unique(np.concatenate([one, two]) >> np.uint64(46)).astype(np.int64)


@dataclass
class Model:
    """Weight and squared scale of each bin, and the bias."""

    weights: np.ndarray
    scales: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """Between 0 and 1; a text without features gets the bias alone."""
        bins = features(text)
        norm = float(np.sqrt(self.scales[bins].sum())) or 1.0
        margin = float(self.weights[bins].sum()) / norm + self.bias
        return float(1 / (1 + np.exp(-np.clip(STEEPNESS * margin, -500, 500))))


def log_count_ratios(counts: DataFrame) -> np.ndarray:
    """From (bin, ones, zeros), the log ratio of each bin's share of class 1 to its share of class 0."""
    got = counts.toPandas()
    sums = {c: np.full(BUCKETS, SMOOTHING) for c in ("ones", "zeros")}
    for c, total in sums.items():
        total[got["bin"].to_numpy(dtype=np.int64)] += got[c].to_numpy(dtype=np.float64)
    return np.log(sums["ones"] / sums["ones"].sum()) - np.log(sums["zeros"] / sums["zeros"].sum())


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            sums[int(label), features(text)] += 1
    seen = np.flatnonzero(sums.any(axis=0))
    yield pd.DataFrame({"bin": seen, "ones": sums[1, seen], "zeros": sums[0, seen]})


def descend(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for squared hinge loss over rows of bins, each class with the same total cost."""
    signs = np.where(labels == 1, 1.0, -1.0)
    share = {s: max(1, int((signs == s).sum())) for s in (1.0, -1.0)}
    diagonal = np.array([share[s] / (COST * len(rows)) for s in signs])
    values = [ratios[bins] / (np.sqrt((ratios[bins] ** 2).sum()) or 1.0) for bins in rows]
    squares = np.array([float((v * v).sum()) + 1.0 for v in values]) + diagonal
    alpha, w, bias = np.zeros(len(rows)), np.zeros(BUCKETS), 0.0
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (float(w[rows[i]] @ values[i]) + bias) - 1 + diagonal[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / squares[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    used = np.abs(w[w != 0])
    mean = float(used.mean()) if len(used) else 0.0
    return np.where(w != 0, INTERPOLATION * w + (1 - INTERPOLATION) * mean, 0.0), INTERPOLATION * bias


def sampled(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(id, label, text) of at most SAMPLE_ROWS ids of `known` (id, label), one row each: of several texts that of the least digest."""
    chosen = known.select("id", "label").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
    one = F.min(F.struct(F.col("text").isNull().alias("none"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "text")).alias("one")
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(one).select("id", "label", "one.text")


def fit(texts: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model of the labels' rows, found in `texts` by their id.

    Rows without id or label are left out; of several labels of one id the higher counts. Without a
    row of either class the model knows nothing and scores one half.
    """
    spark = texts.sparkSession
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(known, "id")
    parts = rows.select("text", "label").mapInPandas(_count, "bin long, ones long, zeros long")
    ratios = log_count_ratios(parts.groupBy("bin").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")))
    shared = spark.sparkContext.broadcast(ratios)

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, marks, total = [], [], 0
        for batch in batches:
            for own, label in zip(batch["bins"], batch["label"]):
                own = np.frombuffer(own, dtype="<i4").astype(np.int64)
                if total + len(own) <= SAMPLE_FEATURES:
                    bins.append(own)
                    marks.append(label)
                    total += len(own)
        marks = np.array(marks)
        if len(set(marks)) < 2:
            return
        w, bias = descend(bins, marks, shared.value)
        yield pd.DataFrame({"weights": [w.astype("<f8").tobytes()], "bias": [bias]})

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).astype("<i4").tobytes() for t in texts])

    sample = sampled(texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), known)
    sample = sample.select(F.xxhash64("id").alias("place"), "label", packed("text").alias("bins"))
    got = sample.repartition(1).sortWithinPartitions("place", "bins").mapInPandas(fitted, "weights binary, bias double").collect()
    if not got:
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0)
    w = np.frombuffer(got[0]["weights"], dtype="<f8")
    return Model(w * ratios, np.square(ratios), float(got[0]["bias"]))


def score_column(spark, model: Model, text: Column) -> Column:
    """The score of each text as a column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        known = shared.value
        return pd.Series([known.score(t) for t in texts], dtype="float64")

    return scored(text)


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training; a row without id isn't."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, held_out, score, predicted) for every row of df; the labels of held-out rows aren't read.

    Null and blank texts get the score of the bias. Repeated rows are scored alike. Columns of df
    other than the text don't influence a score. An empty table gives no rows.
    """
    spark = df.sparkSession
    model = fit(df, labels.where(~held_out(F.col(id_col))), id_col, text_col)
    out = df.select(F.struct("*").alias("row"), held_out(F.col(id_col)).alias("held_out"), score_column(spark, model, F.col(text_col)).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df that the classifier accepts, with df's columns."""
    return scores(df, labels, id_col, text_col).where("predicted = 1").select("row.*")
