"""Token files: coding, and whole tables against the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from commerce_lens.llm import token_files as tf
from tests.llm.edge import SCHEMA, documents, stored

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = st.sampled_from([" ", "  ", "\n", "a", "The", "thnt", "'s", ".", "1", "é", "漢", "\t", "\x1c", "\xa0", " \n", "<|endoftext|>", "😀"])


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300) | st.integers(0, 70_000), max_size=70))
@settings(deadline=None)
def test_packing_is_exact(values):
    control, data = tf.pack(np.array(values, dtype="<u4"))
    assert len(control) == -(-len(values) // 4)
    assert tf.unpack(control, data, len(values)).tolist() == values


@given(st.lists(st.lists(PIECES, max_size=25).map("".join), max_size=4))
@settings(max_examples=150, deadline=None)
def test_words_encode_as_whole_texts_do(texts):
    got = tf.encoder("byte_bpe_50k.json").encode(texts)
    assert [g.tolist() for g in got] == [ids(t) for t in texts]


def test_a_full_memory_forgets_without_harm(monkeypatch):
    monkeypatch.setattr(tf, "_MEMO_SIZE", 3)
    own = tf.WordEncoder("byte_bpe_50k.json")
    for _ in range(3):
        assert [g.tolist() for g in own.encode(["a few words here", "and others there"])] == [ids("a few words here"), ids("and others there")]


@pytest.mark.parametrize("block", [1, 1 << 18])
def test_tables_come_back_in_order(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(tf, "BLOCK_IDS", block)
    docs = stored(spark, documents(spark), tmp_path / "d")
    path = str(tmp_path / "t")
    tf.write_tokens(docs, path)
    found = tf.read_tokens(spark, path).join(tf.offsets(spark, path), ["part", "block"])
    got = [(r["before"] + r["at"], r["id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found.collect()]
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r))
    at = 0
    for (start, key, own), (want, text) in zip(sorted(got, key=lambda r: r[0]), rows, strict=True):
        assert (start, key, own) == (at, want, ids(text) + [0])
        at += len(own)
    counts = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()
    assert counts["n"].is_monotonic_decreasing and counts["n"].sum() == at


def test_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tf.write_tokens(spark.createDataFrame([], SCHEMA), path)
    assert tf.read_tokens(spark, path).count() == 0 and tf.offsets(spark, path).count() == 0


def test_checksums_are_those_of_the_ids(spark):
    row = spark.createDataFrame([(bytearray(np.array([5, 70000], "<u4").tobytes()),)], "b binary").select(F.crc32("b")).first()
    assert row[0] == zlib.crc32(np.array([5, 70000], "<u4").tobytes())


@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=9), max_size=12))
@settings(deadline=None)
def test_documents_coded_together_are_coded_as_alone(docs):
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    control, data = tf.pack_each(np.array([x for d in docs for x in d], dtype="<u4"), lengths)
    assert list(zip(control, data)) == [tf.pack(np.array(d, dtype="<u4")) for d in docs]
    assert tf.unpack_each(control, data, lengths).tolist() == [x for d in docs for x in d]


def test_documents_are_coded_together_up_to_a_block(monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 10)
    assert list(tf._runs(np.array([3, 7, 1, 25, 2, 8, 0, 1]))) == [(0, 2), (2, 3), (3, 4), (4, 7), (7, 8)]


def test_words_that_end_in_punctuation_are_not_split_by_the_pattern():
    own, text = tf.WordEncoder("byte_bpe_50k.json"), "One (two) thrée), 漢字*** five.\" six-'\nseven\neight!!_ it's 9, x2."
    calls, split = [], own._split
    own._split = lambda word: calls.append(word) or split(word)
    assert own.encode([text])[0].tolist() == ids(text) and calls == [" (two)", " it's", " 9,", " x2."]
