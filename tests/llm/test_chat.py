"""Chat formatting: round trips, parts, ties."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commerce_lens.llm import chat

MARKS = st.sampled_from(["<turn>", "</turn>", "<says>", "<image>", "<", "\\", ">", "turn", "/", "a", "\n", "é", "<\\turn>", "</document>", "😀"])
SCHEMA = "conv_id long, turn long, role string, text string, row string, conv string, segment string"


def formatted(df, parts=None):
    turns = chat.format_turns(df, "conv_id", "turn", "role", chat.text_part(F.col("text")) if parts is None else parts)
    return chat.format_conversations(turns)


def read(found):
    return found.select("conv", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"))


@given(st.lists(st.tuples(st.lists(MARKS, max_size=6).map("".join), st.lists(MARKS, max_size=12).map("".join)), min_size=1, max_size=5))
@settings(max_examples=25, deadline=None)
def test_any_turns_come_back(spark, turns):
    turns = [*turns, ("assistant", turns[0][1])]
    df = spark.createDataFrame([(1, i, r, t, "", "", "") for i, (r, t) in enumerate(turns)], SCHEMA)
    got = read(formatted(df)).first()
    assert [tuple(t) for t in got["turns"]] == turns
    assert got["learned"] == "".join(t for r, t in turns if r == "assistant")
    assert got["formatted"].count("<turn>") == len(turns) == got["formatted"].count("</turn>")


def test_nulls_ties_and_empty_tables(spark):
    rows = [(None, 1, "user", "a"), (1, None, "b", None), (1, 2, None, "x"), (1, 2, "assistant", "y"), (1, 2, "assistant", "y"), (1, 1, "user", "")]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    got = {r["conv"]: r for r in read(formatted(df)).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("b", ""), ("user", ""), ("", "x"), ("assistant", "y"), ("assistant", "y")]
    assert got[1]["learned"] == "yy" and [tuple(t) for t in got[None]["turns"]] == [("user", "a")]
    assert formatted(df.where("false")).count() == 0


def test_parts_become_placeholders_in_order(spark):
    part = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    rows = [
        (1, 0, "user", [("text", "see <image>: ", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None), ("text", " and ", None, None, None, None, None),
                        ("audio", None, "b.wav", None, None, 2.0, None), ("document", None, "c.pdf", None, None, None, 3), ("image", None, None, None, None, None, None), ("other", "?", None, None, None, None, None)]),
        (1, 1, "assistant", None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    got = formatted(df, F.col("parts")).first()
    assert got["formatted"] == "<turn>user<says>see <\\image>: <image> and <audio><document><image>?</turn>\n<turn>assistant<says></turn>\n"
    assert [tuple(a) for a in got["attachments"]] == [("image", "a.png", 3), ("audio", "b.wav", 25), ("document", "c.pdf", 768), ("image", None, 1)]
    assert got["loss"] == []


PIECES = st.lists(st.sampled_from(["<tu", "rn>", "</", "turn>", "<", "says>", "<image>", "\\", "a", "", None, "image>"]), max_size=10)


@given(st.lists(PIECES, min_size=1, max_size=4))
@settings(max_examples=25, deadline=None)
def test_parts_side_by_side_build_no_control_strings(spark, turns):
    schema = f"conv_id long, turn long, role string, parts array<{chat.PART}>"
    rows = [(1, i, "assistant", [(None if k % 2 else "text", t, None, None, None, None, None) for k, t in enumerate(own)]) for i, own in enumerate(turns)]
    got = read(formatted(spark.createDataFrame(rows, schema), F.col("parts"))).first()
    texts = ["".join(t or "" for t in own) for own in turns]
    assert [tuple(t) for t in got["turns"]] == [("assistant", t) for t in texts]
    assert got["learned"] == "".join(texts) and got["formatted"].count("<turn>") == len(turns)
