"""Benchmark decontamination: training passages are queries against an inverted index of test items.

Items are cut into pieces of at most PIECE words, and each piece is an entry of a BM25 index whose
term statistics cover all items. An entry's impacts are divided by the score it gives itself, so that one
threshold means the same share for every entry. Documents are read in windows of two PIECEs that start every PIECE
words, so that a window holds any run of PIECE words; each window asks for every entry at or above
the threshold.

Retrieval is block-max WAND. Entries are numbered, postings are cut into blocks of BLOCK entries, and
each term keeps its greatest impact in each block. The same bounds are first summed for all windows of a batch
at once: a window goes on to the search only with a block whose bound reaches the threshold, so nothing
that could score is lost. Hits are then verified against the document's own words around the window: enough of
the item's question and enough of its answer must stand there.

The index is broadcast in shards of about SHARD_WORDS words of items; each shard is one pass over the documents. Items are dealt to
shards by a hash of id and text, so that an id which holds many texts is spread; its hits of all shards are brought together afterwards.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from commerce_lens.session import cut_lineage, discard

PIECE = 64
# Share of an entry's own score that a window must reach.
THRESHOLD = 0.7
# Share, by weight of words, of the question and of the answer that must stand around a hit.
OVERLAP = 0.75
K1, B = 1.2, 0.75
BLOCK = 4
SHARD_WORDS = 2_000_000
# Terms in more than this share of the entries are bounded together, by a constant per block, before the search.
COMMON = 0.05
_NOT_WORD = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_MEMO_SIZE = 150_000
# Postings of blocks that are expanded together; stretches of PIECE words are not divided.
_EXPANDED = 1 << 19


def words(text: str | None) -> list[str]:
    """Lower-cased words without punctuation, in order."""
    return [w for w in (_NOT_WORD.sub("", x) for x in (text or "").lower().split()) if w]


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """The words before an item's last sentence and those of it; an item of one sentence is cut in half."""
    parts = [p for p in map(words, _SENTENCE.split(text or "")) if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    own = parts[0] if parts else []
    return own[: len(own) // 2], own[len(own) // 2 :]


class _Terms(dict):
    """Term number of a word as it stands in a text; -1 for a word of no item, -2 for no word."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self._vocabulary = vocabulary

    def __missing__(self, raw: str) -> int:
        if len(self) > _MEMO_SIZE:
            self.clear()
        word = _NOT_WORD.sub("", raw)
        self[raw] = n = self._vocabulary.get(word, -1) if word else -2
        return n


@dataclass
class Index:
    """Entries (item, words), with postings by term; `weights` has the inverse frequency of every word of these items."""

    entries: list[tuple[int, list[str]]]
    parts: dict[int, tuple[list[str], list[str]]]
    weights: dict[str, float]
    mean_length: float
    # The item's id by its number, where these differ; None for an item without id.
    ids: dict[int, int | None] | None = None
    vocabulary: dict[str, int] = field(init=False)
    postings: list[tuple[list[int], list[float]]] = field(init=False)

    def __post_init__(self) -> None:
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, own in self.entries for w in own}))}
        rows: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        for e, (_, own) in enumerate(self.entries):
            norm = K1 * (1 - B + B * len(own) / self.mean_length)
            impacts = {w: self.weights[w] * n * (K1 + 1) / (n + norm) for w, n in Counter(own).items()}
            whole = sum(impacts.values())
            for w, x in impacts.items():
                rows[self.vocabulary[w]].append((e, x / whole))
        self.postings = [([e for e, _ in row], [x for _, x in row]) for row in rows]
        self.blocks = -(-len(self.entries) // BLOCK)
        self.block_max: list[dict[int, float]] = []
        self.most: list[float] = []
        for own, impacts in self.postings:
            best: dict[int, float] = defaultdict(float)
            for e, x in zip(own, impacts):
                best[e // BLOCK] = max(best[e // BLOCK], x)
            self.block_max.append(dict(best))
            self.most.append(max(impacts))
        limit = max(8, COMMON * len(self.entries))
        common = np.zeros(len(self.entries))
        starts, flat_blocks, flat_bounds = [0], [], []
        for own, best in zip(self.postings, self.block_max):
            if len(own[0]) > limit:
                common[own[0]] += own[1]
            else:
                flat_blocks += best.keys()
                flat_bounds += best.values()
            starts.append(len(flat_blocks))
        # What an entry can get from common terms at most; the block's greatest bounds all of its entries.
        self._constant = np.zeros(self.blocks)
        np.maximum.at(self._constant, np.arange(len(common)) // BLOCK, common)
        self._starts = np.array(starts)
        self._flat_blocks, self._flat_bounds = np.array(flat_blocks, dtype=np.int64), np.array(flat_bounds)
        self._memo = _Terms(self.vocabulary)

    def __reduce__(self):
        return Index, (self.entries, self.parts, self.weights, self.mean_length, self.ids)

    def terms(self, text: str | None) -> np.ndarray:
        """The term numbers of a text's words, -1 for words of no item."""
        own = np.fromiter(map(self._memo.__getitem__, (text or "").lower().split()), dtype=np.int64)
        return own[own > -2]

    def possible(self, texts: list[np.ndarray], theta: float) -> list[list[int]]:
        """For each text, the windows that hold a block whose bound reaches theta."""
        counts = [-(-len(t) // PIECE) for t in texts]
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        found: list[list[int]] = [[] for _ in texts]
        if not offsets[-1] or not self.entries:
            return found
        place = np.concatenate([np.arange(len(t)) // PIECE + o for t, o in zip(texts, offsets)])
        terms = np.concatenate(texts)
        known = terms >= 0
        pairs = np.unique(place[known] * len(self.vocabulary) + terms[known])
        place, terms = pairs // len(self.vocabulary), pairs % len(self.vocabulary)
        # Stretches are taken in slices of bounded size; the last one of a slice is the next slice's first, so that neighbours meet.
        begins = np.append(np.flatnonzero(np.diff(place, prepend=-1)), len(place))
        sizes = np.concatenate([[0], np.cumsum(self._starts[terms + 1] - self._starts[terms])])[begins]
        i, good = 0, []
        while i < len(begins) - 1:
            j = min(len(begins) - 1, max(i + 2, int(np.searchsorted(sizes, sizes[i] + _EXPANDED, "right")) - 1))
            good.append(self._good_windows(place[begins[i] : begins[j]], terms[begins[i] : begins[j]], theta))
            i = j if j == len(begins) - 1 else j - 1
        windows = np.unique(np.concatenate(good)) if good else np.zeros(0, dtype=np.int64)
        everywhere = bool((self._constant >= theta - 1e-9).any())
        for i in range(len(texts)):
            low, high = offsets[i], offsets[i + 1]
            if everywhere:
                found[i] = list(range(counts[i]))
            else:
                a, b = np.searchsorted(windows, [low, high])
                found[i] = (windows[a:b] - low).tolist()
        return found

    def _good_windows(self, place: np.ndarray, terms: np.ndarray, theta: float) -> np.ndarray:
        """The first stretches of windows with a block whose bound reaches theta, of all distinct (stretch, term) of some stretches in order."""
        lengths = self._starts[terms + 1] - self._starts[terms]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) - np.repeat(ends - lengths - self._starts[terms], lengths)
        keys, back = np.unique(np.repeat(place, lengths) * self.blocks + self._flat_blocks[at], return_inverse=True)
        sums = np.bincount(back, weights=self._flat_bounds[at], minlength=len(keys))
        place, block = keys // self.blocks, keys % self.blocks
        # The stretch that follows shares a window with this one; it may lack the block altogether.
        nxt = np.searchsorted(keys, keys + self.blocks)
        inside = nxt < len(keys)
        same = np.zeros(len(keys), dtype=bool)
        same[inside] = keys[nxt[inside]] == keys[inside] + self.blocks
        alone = sums + self._constant[block]
        both = alone.copy()
        both[same] += sums[nxt[same]]
        # A window is named by its first stretch; a stretch alone bounds the window before it, too.
        return np.unique(np.concatenate([place[both >= theta - 1e-9], place[alone >= theta - 1e-9] - 1]))

    def search(self, query: set[int], theta: float) -> list[tuple[int, float]]:
        """Every entry that scores theta or more against the query's terms, by block-max WAND."""
        theta -= 1e-9
        cursors = [[self.postings[t][0], self.postings[t][1], 0, self.most[t], self.block_max[t]] for t in query]
        out = []
        while True:
            cursors = [c for c in cursors if c[2] < len(c[0])]
            cursors.sort(key=lambda c: c[0][c[2]])
            bound, pivot = 0.0, None
            for i, c in enumerate(cursors):
                bound += c[3]
                if bound >= theta:
                    pivot = i
                    break
            if pivot is None:
                return out
            entry = cursors[pivot][0][cursors[pivot][2]]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0][cursors[pivot + 1][2]] == entry:
                pivot += 1
            block = entry // BLOCK
            if sum(c[4].get(block, 0.0) for c in cursors[: pivot + 1]) < theta:
                # No entry up to the block's end, or to the next cursor, can reach theta.
                target = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0][cursors[pivot + 1][2]])
                for c in cursors[: pivot + 1]:
                    c[2] = bisect.bisect_left(c[0], max(target, entry + 1), c[2])
            elif cursors[0][0][cursors[0][2]] == entry:
                score = 0.0
                for c in cursors[: pivot + 1]:
                    score += c[1][c[2]]
                    c[2] += 1
                if score >= theta:
                    out.append((entry, score))
            else:
                for c in cursors[:pivot]:
                    c[2] = bisect.bisect_left(c[0], entry, c[2])

    def share(self, part: list[str], there: set[str]) -> float:
        """How much of a part's words, by weight, is in a set of words; 1 for a part without words."""
        own = set(part)
        whole = sum(self.weights[w] for w in own)
        return sum(self.weights[w] for w in own & there) / whole if whole else 1.0

    def hits(self, text: str | None, terms: np.ndarray, windows: list[int], theta: float, overlap: float) -> list[tuple]:
        """(item, score, question share, answer share, first word) of the items that the text holds, each once, at its best."""
        best: dict[int, tuple] = {}
        own: list[str] | None = None
        for w in windows:
            window = terms[w * PIECE : (w + 2) * PIECE]
            for entry, score in self.search(set(window[window >= 0].tolist()), theta):
                own = own if own is not None else words(text)
                item = self.entries[entry][0]
                question, answer = self.parts[item]
                reach = len(question) + len(answer)
                there = set(own[max(0, w * PIECE - reach) : (w + 2) * PIECE + reach])
                q, a = self.share(question, there), self.share(answer, there)
                if q >= overlap and a >= overlap:
                    # The order of a sum's terms must not show.
                    best[item] = max(best.get(item, (-1.0,)), (*(round(x, 9) for x in (score, q, a)), -w * PIECE))
        return [(item, s, q, a, -p) for item, (s, q, a, p) in sorted(best.items())]

    def named(self, hits: list[tuple]) -> list[tuple]:
        """Hits with the items' ids for their numbers: those of one id are one hit, the best, those without id one each."""
        if self.ids is None:
            return hits
        best: dict = {}
        for item, score, q, a, place in hits:
            key = (self.ids[item], item if self.ids[item] is None else None)
            best[key] = max(best.get(key, (-1.0,)), (score, q, a, -place))
        return [(i, s, q, a, -p) for (i, _), (s, q, a, p) in sorted(best.items(), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[0][1] or 0))]


def build(items: DataFrame, id_col: str = "item_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> Iterator[Index]:
    """The index of all items, in shards; an item without words has no entry.

    Every distinct row of id and text is an item of its own, also without id. Items are dealt to shards by a hash of id and
    text, about `shard_words` words to each, however many texts an id has; the driver holds
    the items of one shard at a time. The weights of words come from all items, and are counted once.
    """
    kept = items.select(F.col(id_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    sized = kept.withColumn("words", F.size(F.split(F.trim("text"), r"\s+")))
    total = sized.agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).first()
    if not total["n"]:
        return
    shards = -(-int(total["words"] or 1) // shard_words)
    mean = max(1.0, min(PIECE, (total["words"] or 1) / total["n"]))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"word": [sorted(set(words(t))) for t in batch["text"]]})

    per_item = kept.select("text").mapInPandas(listed, "word array<string>").select(F.explode("word").alias("word"))
    frequency = per_item.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    copies: list[str] = []
    if shards > 1:
        kept, frequency = cut_lineage(kept, "items", copies), cut_lineage(frequency, "frequency", copies)

    for s in range(shards):
        mine = kept.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == s)
        rows = mine.orderBy("item", "text").collect()
        needed = mine.select("text").mapInPandas(listed, "word array<string>").select(F.explode("word").alias("word")).distinct()
        weights = {
            r["word"]: math.log(1 + (total["n"] - r["df"] + 0.5) / (r["df"] + 0.5)) for r in frequency.join(needed, "word", "left_semi").collect()
        }
        entries, parts = [], {}
        for item, r in enumerate(rows):
            question, answer = question_and_answer(r["text"])
            parts[item] = (question, answer)
            both = question + answer
            n = -(-len(both) // PIECE)
            entries += [(item, both[len(both) * i // n : len(both) * (i + 1) // n]) for i in range(n)]
        yield Index(entries, parts, weights, mean, {item: r["item"] for item, r in enumerate(rows)})
    discard(items.sparkSession, copies)


# Texts looked at together.
_ROWS = 512


def _found(index, batch: pd.DataFrame, theta: float, overlap: float) -> Iterator[tuple[int, list[tuple]]]:
    texts = batch["text"].tolist()
    for start in range(0, len(texts), _ROWS):
        part = texts[start : start + _ROWS]
        terms = [index.terms(t) for t in part]
        for i, windows in enumerate(index.possible(terms, theta)):
            if windows:
                yield start + i, index.hits(part[i], terms[i], windows, theta, overlap)


def _searcher(shared, names: list[str], theta: float, overlap: float):
    def looked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            rows = [
                (ids[i], *hit, hashlib.sha256(texts[i].encode("utf-8", "surrogatepass")).digest())
                for i, hits in _found(shared.value, batch, theta, overlap)
                for hit in shared.value.named(hits)
            ]
            yield pd.DataFrame(rows, columns=names)

    return looked


def _judge(shared, theta: float, overlap: float):
    def clean(texts: pd.Series) -> pd.Series:
        good = [True] * len(texts)
        for i, hits in _found(shared.value, texts.to_frame("text"), theta, overlap):
            good[i] = not hits
        return pd.Series(good, dtype=bool)

    return F.pandas_udf(clean, "boolean")


def _best_of_shards(found: DataFrame) -> DataFrame:
    """One row, the best, of each document and item_id that several shards have hits of; repeated documents stay repeated."""
    values = ["score", "question_overlap", "answer_overlap"]
    ranked = F.struct(*values, (-F.col("first_word")).alias("back"))
    named = found.where(F.col("item_id").isNotNull())
    per_shard = named.groupBy("doc_id", "text_digest", "item_id", "shard").agg(F.max(ranked).alias("best"), F.count(F.lit(1)).alias("copies"))
    best = per_shard.groupBy("doc_id", "text_digest", "item_id").agg(F.max("best").alias("best"), F.max("copies").alias("copies"))
    rows = best.select("doc_id", "item_id", "best", F.explode(F.sequence(F.lit(1), "copies")))
    return rows.select("doc_id", "item_id", *[f"best.{c}" for c in values], (-F.col("best.back")).alias("first_word")).unionByName(
        found.where(F.col("item_id").isNull()).drop("text_digest", "shard")
    )


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP
) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, first_word): every document and item it holds.

    Null and empty texts hold nothing, and items without words are held by nothing. Each text of an item_id
    is looked for by itself, and a document that holds any has one row, of the best. Every text without
    item_id is an item of its own, whose rows have a null item_id. Repeated documents give repeated rows. Empty tables give no rows.
    """
    spark = docs.sparkSession
    schema = StructType().add("doc_id", docs.schema[id_col].dataType).add("item_id", "long").add("score", "double")
    schema = schema.add("question_overlap", "double").add("answer_overlap", "double").add("first_word", "long")
    hits = StructType([*schema.fields]).add("text_digest", "binary")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out, shards = None, 0
    for index in build(items):
        shared = spark.sparkContext.broadcast(index)
        found = slim.mapInPandas(_searcher(shared, hits.names, threshold, overlap), hits).withColumn("shard", F.lit(shards))
        out, shards = found if out is None else out.unionByName(found), shards + 1
    if out is None:
        return spark.createDataFrame([], schema)
    return _best_of_shards(cut_lineage(out, "hits")) if shards > 1 else out.drop("text_digest", "shard")


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP
) -> DataFrame:
    """The rows of docs that hold no item, with docs' columns; every row is looked at by itself."""
    for index in build(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.where(_judge(shared, threshold, overlap)(F.col(text_col)))
    return docs
