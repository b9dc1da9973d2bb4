"""Removal of passages that repeat anywhere in the corpus, by sliding spans of sentences.

A text falls into sentences; long sentences are cut further after words that have the least hash of WINDOW words
in a row, so that a passage is cut alike wherever it stands, but for its first and last WINDOW - 1 words, and no part
is longer than WINDOW. A passage of 50 words thus holds a run of SENTENCES parts and WORDS words in any surroundings.
From every sentence the shortest run on from it, and the shortest run
up to it, is hashed that has at least SENTENCES sentences and WORDS words. All runs meet by hash: the first
place, by document id and position, keeps its run, and the sentences that any later one covers go.

Hashes alone are counted first, and places are compared only of those that repeat. These are pre-aggregated to one first
place each before the runs are joined with it, so a passage that a third of all
documents share has one row on the other side, and adaptive execution can split its runs. Texts stay where they
are until a document's own list of covered sentences is known.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from commerce_lens.session import cut_lineage, discard

SENTENCES = 3
WORDS = 12
# Sentences of more words than this are cut after the word of least hash, the last of equals, of every WINDOW words.
LONG, WINDOW = 10, 8
# Characters whose words are hashed together.
_CHARS = 1 << 20

_U = np.uint64
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)])  # no white space lies above
_ENDS = np.array([chr(c) in ".!?" for c in range(128)])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number as another that looks random, one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Sums:
    """Hashes of stretches of a sequence of 64-bit numbers: differences of prefix sums of a polynomial modulo 2^64.

    The powers of an odd base and of its inverse are kept as far as any sequence has needed them.
    """

    def __init__(self, base: int):
        self._base = np.array([base, pow(base, -1, 1 << 64)], dtype=_U)
        self._powers = np.ones((2, 1), dtype=_U)

    def stretches(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        while self._powers.shape[1] <= len(values):
            more = self._powers[:, -1:] * self._base[:, None]
            self._powers = np.concatenate([self._powers, self._powers * more], axis=1)
        powers, inverse = self._powers
        sums = np.zeros(len(values) + 1, dtype=_U)
        np.cumsum(values * powers[: len(values)], out=sums[1:])
        return (sums[ends] - sums[starts]) * inverse[starts]


_LETTERS = _Sums(0x9E3779B97F4A7C15)
_RUNS = _Sums(0xD1342543DE82EF95), _Sums(0xC2B2AE3D27D4EB4F)


def _words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, starts, ends, hashes) of the words between white space."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = _SPACE[np.minimum(points, len(_SPACE) - 1)] & (points < len(_SPACE))
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    hashes, at = np.empty(len(starts), dtype=_U), 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + _CHARS)))
        letters = _mixed(points[low : ends[to - 1]].astype(_U) + _U(1))
        hashes[at:to] = _LETTERS.stretches(letters, starts[at:to] - low, ends[at:to] - low)
        at = to
    return points, starts, ends, _mixed(hashes)


def _units(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first and last word of every sentence, starts, ends and hashes of the words)."""
    points, starts, ends, hashes = _words(text)
    if not len(starts):
        none = np.empty(0, dtype=np.int64)
        return none, none, starts, ends, hashes
    # A sentence ends at white space after a mark, and at white space with a line break in it.
    breaks = np.flatnonzero(points == 10)
    mark = points[ends - 1]
    stop = _ENDS[np.minimum(mark, 127)] & (mark < 128)
    stop[:-1] |= np.searchsorted(breaks, starts[1:]) > np.searchsorted(breaks, ends[:-1])
    stop[-1] = True
    sizes = np.diff(np.flatnonzero(stop), prepend=-1)
    if sizes.max() > LONG:
        # A later word is the lesser of equals.
        least = ((hashes & _U(0x7FFFFFFF)).astype(np.int64) << 32) - np.arange(len(starts))
        for step in (1, 2, 4):
            least = np.minimum(least[:-step], least[step:])
        of = np.repeat(np.arange(len(sizes)), sizes)
        whole = (of[: len(least)] == of[WINDOW - 1 :]) & (sizes[of[: len(least)]] > LONG)
        stop[-least[whole] & 0xFFFFFFFF] = True
    last = np.flatnonzero(stop)
    return np.append(0, last[:-1] + 1), last, starts, ends, hashes


def sentences(text: str | None) -> list[tuple[int, int, int]]:
    """(start, end, words) of every sentence of a text, by its code points, white space at the edges left out."""
    first, last, starts, ends, _ = _units(text or "")
    return list(zip(starts[first].tolist(), ends[last].tolist(), (last - first + 1).tolist()))


def _run_table(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last) of every run, as arrays.

    A run's hash is that of its words, from two prefix sums over all words of the text with different bases: words joined anew for
    every run would be read some ten times over.
    """
    low, high, _, _, hashes = _units(text or "")
    n = len(low)
    if n < SENTENCES:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    sizes, place = np.append(0, high + 1), np.arange(n)
    last = np.maximum(np.searchsorted(sizes, sizes[:-1] + WORDS), place + SENTENCES) - 1
    first = np.minimum(np.searchsorted(sizes, sizes[1:] - WORDS, side="right") - 1, place + 1 - SENTENCES)
    on, upto = last < n, first >= 0
    pairs = np.unique(np.concatenate([place[on] * n + last[on], first[upto] * n + place[upto]]))
    i, j = pairs // n, pairs % n
    one, two = (own.stretches(hashes, low[i], high[j] + 1) for own in _RUNS)
    return _mixed(_mixed(one) + two).view(np.int64), i, j


def runs(text: str | None) -> list[tuple[int, int, int]]:
    """(hash, first, last) of every run of sentences, each pair of ends once; any white space between words is alike."""
    return list(zip(*(a.tolist() for a in _run_table(text))))


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for low in range(0, len(batch), 256):
            part = batch.iloc[low : low + 256]
            found = [_run_table(t) for t in part["text"]]
            rows = np.repeat(np.arange(len(part)), [len(h) for h, _, _ in found])
            own = part[["no", "id"]].iloc[rows].reset_index(drop=True)
            yield own.assign(**{name: np.concatenate([f[k] for f in found]) for k, name in enumerate(("hash", "first", "last"))}).astype({"id": "Int64"})


def repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", copies: list[str] | None = None) -> DataFrame:
    """(no, id, first, last, from_id): the runs of each row that stand earlier, in the row `from_id` has.

    `no` numbers df's rows and settles which of several rows with the same id comes first; null
    ids come last. The result reads copies whose paths are added to `copies`; the larger ones before them are deleted here.
    """
    spark, early = df.sparkSession, []
    rows = df.select(F.monotonically_increasing_id().alias("no"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInPandas(_spread, "no long, id long, hash long, first int, last int")
    found = cut_lineage(found, "runs", early)
    # Both sides are written, so that the joins below have a plain shuffle on either side and can split the runs of a hot passage.
    twice = cut_lineage(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "twice", early)
    found = cut_lineage(found.join(twice, "hash"), "shared", copies)
    discard(spark, early)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "no", "first", "last")
    firsts = found.groupBy("hash").agg(F.min(place).alias("place"))
    later = found.join(cut_lineage(firsts, "firsts", copies), "hash")
    here = F.struct(F.col("id").isNull(), "id", "no", "first", "last")
    return later.where(here != F.col("place")).select("no", "id", "first", "last", F.col("place.id").alias("from_id"))


def without(text: str, covered: Iterable[dict]) -> tuple[str, list[dict]]:
    """A text without its covered sentences, and the spans that went; what follows a span closes up to its start."""
    units = sentences(text)
    gone = np.zeros(len(units) + 1, dtype=np.int64)
    for c in covered:
        gone[c["first"]] += 1
        gone[c["last"] + 1] -= 1
    edges = np.flatnonzero(np.diff(np.cumsum(gone) > 0, prepend=False))
    spans, kept, at = [], [], 0
    for i, j in edges.reshape(-1, 2):
        spans.append({"start": units[i][0], "end": units[j - 1][1], "sentences": int(j - i)})
        kept.append(text[at : units[i][0]])
        at = units[j][0] if j < len(units) else len(text)
    return "".join([*kept, text[at:]]), spans


_SPAN = StructType().add("start", "integer").add("end", "integer").add("sentences", "integer")
_NEW = StructType().add("text", "string").add("removed", ArrayType(_SPAN))


@F.pandas_udf(_NEW)
def _cut(texts: pd.Series, covered: pd.Series) -> pd.DataFrame:
    made = [(None, []) if t is None or c is None else without(t, c) for t, c in zip(texts, covered)]
    return pd.DataFrame(made, columns=["text", "removed"])


def dedup_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, removed, from_ids) of every row of df: its text without repeated passages, what went, and whence.

    removed lists (start, end, sentences) in code points of the old text; from_ids the ids of rows that keep the passages.
    Rows that keep everything have empty lists and their old text, null included; texts of fewer than SENTENCES
    sentences repeat nothing. A row equal to an earlier one loses all its runs; of rows with the same id the one read first keeps
    a passage. A very long text is hashed in pieces of bounded size, but held whole. Other columns are carried in `row`.
    df is read twice and should come from a stored table.
    """
    copies: list[str] = []
    covered = repeated(df, id_col, text_col, copies).groupBy("no").agg(
        F.collect_set(F.struct("first", "last")).alias("covered"), F.array_sort(F.collect_set("from_id")).alias("from_ids")
    )
    covered = cut_lineage(covered, "covered")
    discard(df.sparkSession, copies)
    rows = df.select(F.monotonically_increasing_id().alias("no"), F.struct("*").alias("row"), F.col(text_col).alias("text"))
    joined = rows.join(covered, "no", "left")
    # Only texts that lose something go through Python.
    new = joined.withColumn("new", _cut(F.when(F.col("covered").isNotNull(), F.col("text")), F.col("covered")))
    return new.select(
        "row",
        F.when(F.col("covered").isNull(), F.col("text")).otherwise(F.col("new.text")).alias("text"),
        F.col("new.removed").alias("removed"),
        F.coalesce("from_ids", F.expr("cast(array() AS array<long>)")).alias("from_ids"),
    )
