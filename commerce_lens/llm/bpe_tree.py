"""Byte-level BPE as a tree of joins.

A text is cut in half again and again; a leaf is encoded by itself and two neighbours are
joined. Pieces of the split pattern are encoded one by one, and no piece reaches from a
character that isn't white space into a space or newline after it. Such a place is a piece boundary
whatever stands around it, so the ids outside it don't change by a join. The join therefore
looks for such a place on both sides of the seam, in windows that double until each has one
(or is the whole half), and encodes only what lies between.

Where a window finds none, the text has a very long run without a break. Its pieces are encoded
by the same tree over bytes: two token lists may stand side by side exactly if the two tokens
at the seam, encoded together, stay these two; otherwise the window around the seam grows.

A document is one row and is encoded by one task; its memory is a few times its length.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters of a leaf, of the first window, and of the longest piece given to the leaf encoder.
LEAF = 2048
WINDOW = 64
LONG_PIECE = 4096
# Ids decoded at a leaf.
LEAF_IDS = 4096
# White space of the pattern and of Python; a boundary needs a character outside both before it.
BREAKS = " \n"


class TreeCodec:
    """Encodes and decodes one text. `ranks` maps the bytes of a token to its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._ranks = ranks
        self._leaf = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._pattern = regex.compile(pattern)
        self._bytes: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._alone = lru_cache(1 << 16)(lambda data: tuple(self._merged(data)))

    # -- text ---------------------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        return self._span(text, 0, len(text))

    def _span(self, text: str, start: int, end: int) -> list[int]:
        if end - start <= LEAF:
            return self._leaf.encode_ordinary(text[start:end])
        seam = (start + end) // 2
        a, b = self._before(text, start, seam), self._after(text, seam, end)
        if (a, b) == (start, end):  # not a break in it: the window is all there is
            return self._window(text[start:end])
        left, right = self._span(text, start, seam), self._span(text, seam, end)
        drop, skip = len(self._window(text[a:seam])), len(self._window(text[seam:b]))
        return left[: len(left) - drop] + self._window(text[a:b]) + right[skip:]

    @staticmethod
    def _is_break(text: str, i: int) -> bool:
        return text[i] in BREAKS and not text[i - 1].isspace()

    def _before(self, text: str, start: int, seam: int) -> int:
        """The last sure boundary left of the seam, else the start of the half."""
        low, width = seam, WINDOW
        while low > start:
            high, low = low, max(start, seam - width)
            for i in range(high - 1, max(low, start + 1) - 1, -1):
                if self._is_break(text, i):
                    return i
            width *= 2
        return start

    def _after(self, text: str, seam: int, end: int) -> int:
        """The first sure boundary right of the seam, else the end of the half."""
        high, width = seam + 1, WINDOW
        while high < end:
            low, high = high, min(end, seam + width)
            for i in range(low, high):
                if self._is_break(text, i):
                    return i
            width *= 2
        return end

    def _window(self, text: str) -> list[int]:
        if len(text) <= LONG_PIECE:
            return self._leaf.encode_ordinary(text)
        out: list[int] = []
        for piece in self._pattern.findall(text):
            out += self._leaf.encode_ordinary(piece) if len(piece) <= LEAF and not piece.isspace() else self._piece(piece.encode())
        return out

    # -- bytes of one piece -----------------------------------------------------------

    def _piece(self, data: bytes) -> list[int]:
        whole = self._ranks.get(data)
        return [whole] if whole is not None else self._halves(data)

    def _halves(self, data: bytes) -> list[int]:
        if len(data) <= 64:
            return self._merged(data)
        middle = len(data) // 2
        left, right = self._halves(data[:middle]), self._halves(data[middle:])
        width = 1
        while True:
            l, r = left[len(left) - min(width, len(left)) :], right[:width]
            window = self._merged(self.decode(l + r))
            before, after = left[: len(left) - len(l)], right[len(r) :]
            if self._fits(before, window) and self._fits(window, after):
                return before + window + after
            width *= 2

    def _fits(self, left: list[int], right: list[int]) -> bool:
        """Whether the tokens at a seam stay as they are when encoded together."""
        if not left or not right:
            return True
        return self._alone(self._bytes[left[-1]] + self._bytes[right[0]]) == (left[-1], right[0])

    def _merged(self, data: bytes) -> list[int]:
        """Merge the neighbours of the lowest rank, the leftmost first, until none has a rank."""
        rank, parts, n = self._ranks.get, [data[i : i + 1] for i in range(len(data))], len(data)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] else n
            if j >= n or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two has been merged since
            parts[i], parts[j] = parts[i] + parts[j], b""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for l, r in ((before[i], i), (i, k)):
                if l >= 0 and r < n and (found := rank(parts[l] + parts[r])) is not None:
                    heapq.heappush(heap, (found, l, len(parts[l]) + len(parts[r])))
        return [self._ranks[p] for p in parts if p]

    # -- decoding -----------------------------------------------------------------------

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, concatenated up the tree."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self._bytes.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


_CODECS: dict[str, TreeCodec] = {}


def codec(name: str) -> TreeCodec:
    """The codec of a rank file of the installed tokenizers, read once per process."""
    if name not in _CODECS:
        import public_tokenizers

        with open(public_tokenizers.path(name), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _CODECS[name] = TreeCodec(ranks, public_tokenizers.PATTERN)
    return _CODECS[name]


# Rows handed back at once: an answer is a few times as large as its texts.
_ROWS = 256


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _with_column(batch: pa.RecordBatch, values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["row", "out"])


def _mapped(df: DataFrame, value: Column, work, out: str) -> DataFrame:
    """(row, out): `work` turns the value of each row into bytes."""
    packed = df.select(F.struct("*").alias("row"), value.alias("value"))
    from pyspark.sql.types import BinaryType, StructType

    schema = StructType([packed.schema["row"]]).add("out", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield _with_column(batch, [work(v) for v in batch.column(1).to_pylist()])

    return packed.mapInArrow(run, schema).select("row", F.col("out").alias(out))


def encode(df: DataFrame, text_col: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(row, ids): every row of df as a struct, and the ids of its text as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Control strings in a text are ordinary text. Rows, repeated
    ones too, stay one to one; other columns, whatever their names, are carried in `row`.
    """

    def work(text: str | None) -> bytes:
        return np.array(codec(vocabulary).encode(text or ""), dtype="<u4").tobytes()

    return _mapped(df, F.col(text_col), work, "ids")


def decode(df: DataFrame, ids_col: str = "ids", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(row, decoded): every row of df as a struct, and the bytes that its ids stand for. Null counts as no ids."""

    def work(ids: bytes | None) -> bytes:
        return codec(vocabulary).decode(np.frombuffer(ids or b"", dtype="<u4").tolist())

    return _mapped(df, F.col(ids_col), work, "decoded")
