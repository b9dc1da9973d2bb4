"""Token ids as files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are renamed by their rank in the corpus, the most frequent first, and a rank takes one to four
bytes. The number of bytes of four ranks is one control byte, and control bytes stand apart from
the data, so a block is decoded by one table lookup per control byte and a few array operations.

A folder holds `ranks` (rank, id, count) and `blocks`, both as Parquet. A block is a row: the part and
number that order it, the documents in it with their lengths, the control bytes and the data. Parts are
ranges of ids in ascending order, so `part` and `block` give the order of the whole corpus.

Texts are read and encoded once: their ids, packed in the same coding, are stored, counted and put in order, and no text is
shuffled. Only their names change at the end. Within a process, words are encoded once.
"""

from __future__ import annotations

import string
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commerce_lens.session import discard, scratch_path

# Ids of a block, at least, unless the part ends; a document is never cut.
BLOCK_IDS = 1 << 18
_MEMO_SIZE = 1_600_000
_ROWS = 256
# White space other than space and newline: pieces that end in it can't be told apart from what follows.
_OTHER_SPACE = tuple(c for c in map(chr, (*range(9, 14), *range(28, 32), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)) if c != "\n")


# The byte alphabet of byte-level tokenizers: printable bytes stand for themselves, the others follow from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_ALPHABET = {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - _PRINTABLE))}


_ID = attrgetter("id")


class _Memory(dict):
    """Remembers what `work` makes of a key, until it is full: frequent keys come early."""

    def __init__(self, work):
        super().__init__()
        self._work = work

    def __missing__(self, key: str) -> bytes:
        value = self._work(key)
        if len(self) < _MEMO_SIZE:
            self[key] = value
        return value


class WordEncoder:
    """Encodes texts with a tokenizer file, word by word.

    The split pattern never runs from a character that isn't white space into a space or newline, so
    a text falls there into words that are encoded alone, each once as long as it is remembered: a word is split
    by the pattern, and the library's model encodes the pieces. Texts with doubled or unusual white
    space, and single words in front, are encoded whole.

    Splitting is done here, by the published pattern and byte alphabet of such tokenizers, since the library's
    call for it costs more than encoding.
    """

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        # Control strings become their own ids, as in the library; a text that holds one is encoded whole.
        self._control = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._tokenize = self._tokenizer.model.tokenize
        self._split = regex.compile(public_tokenizers.PATTERN).findall
        self._pieces = _Memory(self._piece)
        self._words = _Memory(self._word)
        self.size = self._tokenizer.get_vocab_size()

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _packed(self, piece: str) -> bytes:
        """The ids of one piece, written in the byte alphabet."""
        return array("I", map(_ID, self._tokenize(piece))).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._packed(piece.encode().decode("latin-1").translate(_ALPHABET))

    def _word(self, word: str) -> bytes:
        """A word as it stands between spaces: a space goes before it, unless a newline begins it."""
        if word.isalpha():
            return self._packed("\u0120" + word) if word.isascii() else self._piece(" " + word)  # U+0120: the space
        stem = word.rstrip(string.punctuation)
        if stem.isalpha():  # punctuation that ends a word is one piece
            return self._words[stem] + self._pieces[word[len(stem) :]]
        if stem[:1] == "\n" and stem[1:].isalpha():
            return self._pieces["\n"] + self._pieces[stem[1:]] + (self._pieces[word[len(stem) :]] if stem != word else b"")
        return b"".join(map(self._pieces.__getitem__, self._split(word if word[:1] == "\n" else " " + word)))

    def words(self, text: str) -> list[str] | None:
        """The first word and the words behind each space and newline; None if the text can't be cut at all of them."""
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n"):
            return None
        if any(c in text for c in _OTHER_SPACE) or any(c in text for c in self._control):
            return None
        return text.replace("\n", " \n").split(" ")

    def packed(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers; null and empty texts have none."""
        words = self.words(text) if text else []
        if words is None:
            return self._whole(text)
        if not words:
            return b""
        return self._whole(words[0]) + b"".join(map(self._words.__getitem__, words[1:]))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        return [np.frombuffer(self.packed(text), dtype="<u4") for text in texts]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = WordEncoder(name)
    return _ENCODERS[name]


# -- coding ------------------------------------------------------------------------------

# Bytes, less one, of each of the four ranks that a control byte describes; and which of a rank's four bytes are kept for each.
_CODES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) % 4).astype(np.uint8).view("<u4")[:, 0]
_KEPT = (np.arange(4) <= np.arange(4)[:, None]).view("<u4")[:, 0]


def _runs(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents that are coded together: one, or as many as have no more than BLOCK_IDS ids."""
    start = held = 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and held + n > BLOCK_IDS:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def _bounds(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Where each document begins and ends."""
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends], ends))


def pack_each(values: np.ndarray, lengths: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control bytes and data of each document; `values` are the ids of all of them."""
    values = np.ascontiguousarray(values, dtype="<u4")
    code = (values > 0xFF).view(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    docs, controls = _bounds(lengths), _bounds(-(-lengths // 4))
    padded = np.zeros(4 * int((-(-lengths // 4)).sum()), dtype=np.uint8)
    for (i, j), (at, _) in zip(docs, controls):
        padded[4 * at : 4 * at + j - i] = code[i:j]
    fours = padded.view("<u4")
    control = (fours | fours >> 6 | fours >> 12 | fours >> 18).astype(np.uint8).tobytes()
    data = values.view(np.uint8)[_KEPT.take(code).view(bool)].tobytes()
    whole = np.concatenate([[0], np.cumsum(code, dtype=np.int64)])
    sizes = _bounds(np.array([whole[j] - whole[i] + j - i for i, j in docs], dtype=np.int64))
    return [control[i:j] for i, j in controls], [data[i:j] for i, j in sizes]


def unpack_each(controls: list[bytes], data: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """The ids of all documents, one after the other."""
    padded = _CODES.take(np.frombuffer(b"".join(controls), dtype=np.uint8)).view(np.uint8)
    docs, code = _bounds(lengths), np.empty(int(lengths.sum()), dtype=np.uint8)
    for (i, j), (at, _) in zip(docs, _bounds(np.array([len(c) for c in controls], dtype=np.int64))):
        code[i:j] = padded[4 * at : 4 * at + j - i]
    out = np.zeros(4 * len(code), dtype=np.uint8)
    out[_KEPT.take(code).view(bool)] = np.frombuffer(b"".join(data), dtype=np.uint8)
    return out.view("<u4")


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data) of unsigned 32-bit integers."""
    control, data = pack_each(values, np.array([len(values)]))
    return control[0], data[0]


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n integers of a block."""
    return unpack_each([control], [data], np.array([n]))


# -- writing -----------------------------------------------------------------------------


# A document's ids, packed. A task's counts follow its documents as rows of n = -1: ids and counts, as plain integers.
_ENCODED = "id long, n int, control binary, data binary"


def _encode(name: str, end: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, stop = encoder(name), np.array([end], dtype="<u4").tobytes()
        sums = np.zeros(max(own.size, end + 1), dtype=np.int64)
        for batch in batches:
            for i in range(0, len(batch), _ROWS):
                part = batch.iloc[i : i + _ROWS]
                texts = [own.packed(text) + stop for text in part["text"]]
                keys, lengths = part["id"].astype("Int64").to_numpy(), np.array([len(x) // 4 for x in texts])
                for low, high in _runs(lengths):
                    ids = np.frombuffer(b"".join(texts[low:high]), dtype="<u4")
                    sums += np.bincount(ids, minlength=len(sums))
                    control, data = pack_each(ids, lengths[low:high])
                    yield pd.DataFrame({"id": keys[low:high], "n": lengths[low:high], "control": control, "data": data})
        used = np.flatnonzero(sums)
        yield pd.DataFrame({"id": pd.array([None], dtype="Int64"), "n": -1, "control": [used.tobytes()], "data": [sums[used].tobytes()]})

    return run


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for ids, sums in zip(batch["control"], batch["data"]):
            yield pd.DataFrame({"id": np.frombuffer(ids, np.int64), "n": np.frombuffer(sums, np.int64)})


def _writer(rank_of):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        docs: list[int | None] = []

        def block() -> pd.DataFrame:
            control, data = pack(np.concatenate(ids))
            row = {"part": part, "block": number, "n_ids": held, "docs": docs, "lengths": [len(x) for x in ids], "control": control, "data": data}
            return pd.DataFrame([row])

        for batch in batches:
            lengths = batch["n"].to_numpy()
            for low, high in _runs(lengths):
                rows, sizes = batch.iloc[low:high], lengths[low:high]
                ranks = rank_of.value[unpack_each(rows["control"].tolist(), rows["data"].tolist(), sizes)]
                for key, own in zip(rows["id"].astype("Int64"), np.split(ranks, np.cumsum(sizes)[:-1])):
                    ids.append(own)
                    docs.append(None if key is pd.NA else int(key))
                    held += len(own)
                    if held >= BLOCK_IDS:
                        yield block()
                        ids, docs, number, held = [], [], number + 1, 0
        if ids:
            yield block()

    return write


_BLOCKS = "part int, block int, n_ids long, docs array<long>, lengths array<long>, control binary, data binary"


def write_tokens(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k.json", end: int = 0
) -> None:
    """Write the ids of all texts, each followed by `end`, in ascending order of an integer id.

    Null ids come first, rows with the same id in an order that their ids alone decide; null and empty texts are
    their end id alone. A document, however long, is one row and one block. Other columns don't matter. An empty table gives
    no blocks.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    copy = scratch_path(spark, "encoded")
    docs.mapInPandas(_encode(name, end), _ENCODED).write.option("compression", "zstd").parquet(copy)
    encoded = spark.read.schema(_ENCODED).parquet(copy)
    tallied = encoded.where("n < 0").select("control", "data").mapInPandas(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # No more rows than the vocabulary has; what no text uses comes last.
    counts = np.zeros(max(encoder(name).size, end + 1), dtype=np.int64)
    found = np.array(sorted(map(tuple, tallied.collect())), dtype=np.int64).reshape(-1, 2)
    counts[found[:, 0]] = found[:, 1]
    order = np.lexsort((np.arange(len(counts)), -counts))
    rank_of = np.zeros(len(counts), dtype="<u4")
    rank_of[order] = np.arange(len(counts))
    ranks = pd.DataFrame({"rank": np.arange(len(counts)), "id": order, "n": counts[order]})
    spark.createDataFrame(ranks, "rank long, id long, n long").coalesce(1).write.parquet(f"{path}/ranks")
    shared = spark.sparkContext.broadcast(rank_of)
    # The bounds of the ranges are sampled without reading the data.
    ordered = encoded.where("n >= 0").repartitionByRange("id", F.xxhash64("control")).sortWithinPartitions("id", F.xxhash64("control"), "control", "data")
    ordered.mapInPandas(_writer(shared), _BLOCKS).write.parquet(f"{path}/blocks")
    discard(spark, [copy])


# -- reading -----------------------------------------------------------------------------


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, before): the ids of all blocks before each block. The one unpartitioned window has a row per part."""
    sizes = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").select("part", "block", "n_ids")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = parts.select("part", F.coalesce(F.sum("n").over(earlier.orderBy("part")), F.lit(0)).alias("first"))
    within = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sizes.withColumn("within", within).join(starts, "part").select("part", "block", (F.col("first") + F.col("within")).alias("before"))


def _reader(id_of):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                ids = id_of.value[unpack(b.control, b.data, int(b.n_ids))]
                ends = np.cumsum(b.lengths)
                for i in range(0, len(ends), _ROWS):
                    stops = ends[i : i + _ROWS]
                    starts = stops - np.asarray(b.lengths)[i : i + _ROWS]
                    keys = pd.array([None if k is None or k != k else int(k) for k in b.docs[i : i + _ROWS]], dtype="Int64")
                    values = [ids[s:e].tobytes() for s, e in zip(starts, stops)]
                    yield pd.DataFrame({"part": b.part, "block": b.block, "id": keys, "at": starts, "n": stops - starts, "ids": values})

    return read


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, id, at, n, ids): each document's ids as little-endian unsigned 32-bit integers, and where they start in their block."""
    ranks = spark.read.parquet(f"{path}/ranks").select("rank", "id").toPandas()
    id_of = np.zeros(len(ranks), dtype="<u4")
    id_of[ranks["rank"].to_numpy()] = ranks["id"].to_numpy()
    shared = spark.sparkContext.broadcast(id_of)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    return blocks.mapInPandas(_reader(shared), "part int, block int, id long, at long, n long, ids binary")
