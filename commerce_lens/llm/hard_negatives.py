"""Hard negatives by exact inner products, with spanning-tree bounds over the anchors.

Anchors are dealt into shards of bounded size, like ones together. The anchors of a shard are joined by their minimum
spanning tree. A row x is scored at the root; along an edge the score can't change by more than |child - parent| * |x|, so
the score at the parent, or the bounds known there, bound that at the child. Only where these bounds overlap a window in which
a result can still lie is x scored anew at the child; that score in turn bounds the next ones.

Each shard meets all rows in blocks, twice: once for the positives of its anchors, once for the negatives in the windows that the
positives set. Tasks keep the first few rows of each window, and these meet in Spark. What the driver and each task hold is
bounded by the shard, however many rows, anchors or equal vectors there are. Results of a shard are written before the next begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_lens.operators.dedup import rank_in
from commerce_lens.session import cut_lineage, scratch_path

SCALE = 256
ANCHOR_EVERY = 100
SHIFT_EVERY, CLASSES = 7, 10
POSITIVES, NEGATIVES = 5, 10
# The least and most of a negative's score, in hundredths of the positive's.
LEAST, MOST = 30, 90
# Anchors of a shard at most; rows that are bounded together.
SHARD = 2048
ROWS = 1024
# Scores stop here, which only components of a billion and more can reach.
_FAR = 1 << 62


class Tree(NamedTuple):
    """Anchors in an order in which parents come first; the root is its own parent."""

    order: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


class Shard(NamedTuple):
    """The anchors of one shard, all integers, and the tree over them."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    tree: Tree


def spanning_tree(vectors: np.ndarray) -> Tree:
    """The minimum spanning tree by Euclidean distance, grown from the first vector."""
    n, points = len(vectors), vectors.astype(np.float64)
    near, parent = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
    order, edge, now, free = [], np.zeros(n), 0, np.ones(n, dtype=bool)
    for _ in range(n):
        order.append(now)
        free[now] = False
        d = np.sqrt(((points - points[now]) ** 2).sum(axis=1))
        closer = free & (d < near)
        near[closer], parent[closer] = d[closer], now
        edge[now] = near[now] if len(order) > 1 else 0
        now = int(np.argmin(np.where(free, near, np.inf)))
    return Tree(np.array(order, dtype=np.int64), parent, edge)


def scaled(vectors: list, width: int = 0) -> np.ndarray:
    """floor(SCALE * x) of each component; shorter vectors are filled up with zeros. Integers beyond doubles become objects."""
    width = max([width, *map(len, vectors)])
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    out = np.floor(out * SCALE)
    if out.size and np.abs(out).max() >= 1 << 24:
        return np.array([[int(x) for x in row] for row in out], dtype=object).reshape(out.shape)
    return out


def _dot(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products. Doubles hold sums of up to 32 products of two numbers below 2^24; beyond that integers do."""
    if rows.dtype != object and vector.dtype != object:
        most = np.abs(rows).max(initial=0) * np.abs(vector).max(initial=0) * max(1, rows.shape[1])
        if most < 1 << 53:
            return (rows @ vector).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(row, vector)) for row in rows]
    return np.array([min(max(s, -_FAR), _FAR) for s in whole], dtype=np.int64)


class First:
    """The first k rows by (score downwards, id) that a place has met; `least` is a score that every further one must reach."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.scores, self.ids = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


class Search:
    """Windows of the anchors of a shard: (anchor, low, high, like), from low to high, of the anchor's label or of any other."""

    def __init__(self, shard: Shard, windows: list[tuple[int, int, int]], like: bool, k: int):
        self.shard, self.like = shard, like
        self.at: list[list[int]] = [[] for _ in shard.ids]
        self.high, self.found, self.rescored = [], [], 0
        for w, (anchor, low, high) in enumerate(windows):
            self.at[anchor].append(w)
            self.high.append(high)
            self.found.append(First(k, low))

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Meet a block of rows."""
        shard = self.shard
        if vectors.shape[1] < shard.vectors.shape[1]:
            vectors = np.pad(vectors, ((0, 0), (0, shard.vectors.shape[1] - vectors.shape[1])))
        # Components beyond an anchor's meet none; they still count for the norm, which only widens bounds.
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        vectors = vectors[:, : shard.vectors.shape[1]]
        low, high = np.empty((len(shard.ids), len(ids))), np.empty((len(shard.ids), len(ids)))
        for a in shard.tree.order:
            windows = self.at[a]
            parent = shard.tree.parent[a]
            if a == shard.tree.order[0]:
                low[a], high[a] = -np.inf, np.inf
            else:
                # What floating point may lose stays far below the share added.
                reach = shard.tree.edge[a] * norms * (1 + 1e-6) + 1
                low[a], high[a] = low[parent] - reach, high[parent] + reach
            overlaps = np.zeros(len(ids), dtype=bool)
            for w in windows:
                overlaps |= (high[a] >= self.found[w].least) & (low[a] <= self.high[w])
            overlaps &= (labels == shard.labels[a]) == self.like
            overlaps &= ids != shard.ids[a]
            # The root is scored for every row.
            own = np.arange(len(ids)) if a == shard.tree.order[0] else np.flatnonzero(overlaps)
            if not len(own):
                continue
            self.rescored += len(own)
            scores = _dot(vectors if len(own) == len(ids) else vectors[own], shard.vectors[a])
            low[a, own] = high[a, own] = scores
            fits = overlaps[own]
            for w in windows:
                good = fits & (scores >= self.found[w].least) & (scores <= self.high[w])
                if good.any():
                    self.found[w].add(scores[good], ids[own[good]])


def start(shard: Shard, windows: list[tuple[int, int, int]], like: bool, k: int) -> list[tuple[int, int, int]]:
    """The windows, raised to what the anchors of the shard alone, which are rows as well, already reach."""
    own = Search(shard, windows, like, k)
    for i in range(0, len(shard.ids), ROWS):
        own.add(shard.ids[i : i + ROWS], shard.labels[i : i + ROWS], shard.vectors[i : i + ROWS])
    return [(a, f.least, high) for (a, _, high), f in zip(windows, own.found)]


def _searcher(shared, like: bool, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, windows = shared.value
        own = Search(shard, windows, like, k)
        for batch in batches:
            for i in range(0, len(batch), ROWS):
                part = batch.iloc[i : i + ROWS]
                own.add(part["id"].to_numpy(np.int64), part["label"].to_numpy(np.int64), scaled(part["vec"].tolist()))
        for low in range(0, len(own.found), 4096):
            found = own.found[low : low + 4096]
            yield pd.DataFrame(
                {
                    "window": np.repeat(np.arange(low, low + len(found)), [len(f.ids) for f in found]),
                    "score": np.concatenate([np.empty(0, dtype=np.int64), *[f.scores for f in found]]),
                    "id": np.concatenate([np.empty(0, dtype=np.int64), *[f.ids for f in found]]),
                }
            )

    return run


def search(rows: DataFrame, shard: Shard, windows: list[tuple[int, int, int]], like: bool, k: int) -> DataFrame:
    """(window, rank, id, score): the first k rows in each window of the shard, over all rows (id, label, vec)."""
    shared = rows.sparkSession.sparkContext.broadcast((shard, start(shard, windows, like, k)))
    met = rows.mapInPandas(_searcher(shared, like, k), "window int, score long, id long")
    rank = F.row_number().over(Window.partitionBy("window").orderBy(F.desc("score"), "id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k)


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, vec) of the rows that take part: with an id, a label, and a vector of finite numbers."""
    bad = F.exists(F.col(vec_col), lambda x: F.coalesce(F.isnan(x) | (F.abs(x.cast("double")) == float("inf")), F.lit(True)))
    return df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("vec")
    )


def shift_labels(rows: DataFrame) -> DataFrame:
    """Every SHIFT_EVERY-th id gets the next label."""
    return rows.withColumn("label", F.when(F.col("id") % SHIFT_EVERY == 0, (F.col("label") + 1) % CLASSES).otherwise(F.col("label")))


def _shards(anchors: DataFrame) -> DataFrame:
    """The anchors with the number of their shard: SHARD each in order of the signs of the first components, the last with the rest."""
    signs = F.array_join(F.transform(F.slice("vec", 1, 16), lambda x: F.when(x >= 0, "1").otherwise("0")), "")
    ordered = anchors.withColumn("signs", signs).withColumn("all", F.lit(0)).withColumn("digest", F.xxhash64("vec", "label"))
    placed = rank_in(ordered, {"place": ("all", ["signs", "id", "digest"])})
    return placed.select("id", "label", "vec", F.expr(f"(place - 1) div {SHARD}").alias("shard"))


def _load(rows: list) -> Shard:
    ids = np.array([r["id"] for r in rows], dtype=np.int64)
    vectors = scaled([r["vec"] for r in rows])
    return Shard(ids, np.array([r["label"] for r in rows], dtype=np.int64), vectors, spanning_tree(vectors))


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows and anchors of (id, label, vec).

    Positives are an anchor's first POSITIVES rows of its label, negatives the first NEGATIVES rows of other labels whose score
    is from LEAST to MOST hundredths of the positive's; higher scores come first, equal ones by id. Rows of the anchor's own id
    are the anchor. Repeated rows count each, also as anchors. Shorter vectors are as if filled up with zeros. Where nothing
    fits there is no row; empty tables give none. Scores are exact integers that stop at 2^62.
    """
    spark = rows.sparkSession
    # Dealt evenly, whatever files they come from: a task's work is its rows times the anchors.
    stored = cut_lineage(rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), "vectors")
    dealt = cut_lineage(_shards(cut_lineage(anchors, "rows")), "anchors")
    path = scratch_path(spark, "negatives")
    numbers = sorted(r["shard"] for r in dealt.select("shard").distinct().collect())  # one number per SHARD anchors
    for number in numbers:
        shard = _load(dealt.where(F.col("shard") == number).orderBy("id").collect())
        everywhere = [(a, -_FAR, _FAR) for a in range(len(shard.ids))]
        positives = sorted(map(tuple, search(stored, shard, everywhere, True, POSITIVES).select("window", "rank", "id", "score").collect()))
        # Without a fitting score a window is empty, as it is below a negative positive.
        windows = [(a, -(-LEAST * score // 100), MOST * score // 100) for a, _, _, score in positives]
        found = search(stored, shard, windows, False, NEGATIVES)
        named = [(w, int(shard.ids[a]), i, score) for w, (a, _, i, score) in enumerate(positives)]
        pairs = spark.createDataFrame(named, "window int, anchor_id long, positive_id long, positive_score long")
        joined = found.join(F.broadcast(pairs), "window")  # POSITIVES rows an anchor of the shard
        joined.select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.parquet(f"{path}/shard={number}")
    if not numbers:
        return spark.createDataFrame([], _RESULT)
    return spark.read.schema(_RESULT).parquet(path).drop("shard")


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """mine() over the usable rows with shifted labels; every ANCHOR_EVERY-th id is an anchor. Other columns don't matter.

    Rows with a null id, label, vector or component, or with one that is not finite, take no part.
    """
    rows = shift_labels(usable(df, id_col, vec_col, label_col))
    return mine(rows, rows.where(F.col("id") % ANCHOR_EVERY == 0))
