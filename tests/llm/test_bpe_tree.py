"""BPE by tree against the tiktoken library."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from commerce_lens.llm import bpe_tree
from tests.llm.edge import SCHEMA, TEXTS, documents

CODEC = bpe_tree.codec("byte_bpe_50k.tiktoken")
PIECES = st.sampled_from([" ", "  ", "\n", "a", "the", "thnt", "'s", "'", "ll", "1", "!", "é", "漢", "\t", "\x1c", " ", "　", "😀"])


@pytest.fixture(params=[(4, 1, 4), (16, 4, 8), (64, 8, 32)])
def small(request, monkeypatch):
    for name, value in zip(("LEAF", "WINDOW", "LONG_PIECE"), request.param):
        monkeypatch.setattr(bpe_tree, name, value)


@given(st.lists(PIECES, max_size=120).map("".join))
@settings(max_examples=150, deadline=None)
def test_any_text_encodes_as_the_library_does(text):
    for leaf, window, piece in ((4, 1, 4), (32, 4, 16), (2048, 64, 4096)):
        bpe_tree.LEAF, bpe_tree.WINDOW, bpe_tree.LONG_PIECE = leaf, window, piece
        ids = CODEC.encode(text)
        assert ids == CODEC._leaf.encode_ordinary(text)
        assert CODEC.decode(ids) == text.encode()


@given(st.text(alphabet="abth", min_size=65, max_size=600))
@settings(max_examples=100, deadline=None)
def test_one_piece_without_breaks(text):
    assert CODEC._piece(text.encode()) == CODEC._leaf.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 20_000, "thnt" * 9_000, "w " * 50_000 + "ab" * 9_000, "\n" * 9_000 + "x"])
def test_long_runs(text):
    ids = CODEC.encode(text)
    assert ids == CODEC._leaf.encode_ordinary(text) and CODEC.decode(ids) == text.encode()


def test_documents_at_the_edges(spark):
    docs = documents(spark)
    ids = bpe_tree.encode(docs)
    assert ids.columns == ["row", "ids"]
    got = bpe_tree.decode(ids.select("row.doc_id", "row.text", "ids")).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        text = r["row"]["text"] or ""
        assert bytes(r["decoded"]) == text.encode()
        assert np.frombuffer(r["row"]["ids"], "<u4").tolist() == CODEC._leaf.encode_ordinary(text)


def test_an_empty_table(spark):
    assert bpe_tree.encode(spark.createDataFrame([], SCHEMA)).count() == 0
