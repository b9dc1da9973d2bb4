"""Formatting conversations with typed content parts, in DataFrame functions only.

A turn has a role and a list of parts: text, image, audio or document. A visitor for each kind turns a part into
its piece of the formatted text, and attachments into an ordered placeholder, a reference and the number of tokens
that the placeholder expands to. A formatted turn is

    <turn>role<says>content</turn>\\n

and a control string inside a role or text gets a backslash after its `<` (one more, if it has some),
so that the marks are the only unescaped control strings and escaping can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ATTACHMENTS = ("image", "audio", "document")
_CONTROL = r"(/?(?:turn|says|image|audio|document)>)"
# Pixels of an image patch side, audio tokens a second, tokens of a document page.
PATCH, PER_SECOND, PER_PAGE = 28, 12.5, 256
#: What a part may hold; parts of other kinds are formatted as their text.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    """Quote every control string by one level; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)" + _CONTROL, r"<\\$1$2")


def unescape(text: Column) -> Column:
    """Undo escape()."""
    return F.regexp_replace(text, r"<\\(\\*)" + _CONTROL, "<$1$2")


def text_part(text: Column) -> Column:
    """A list of one text part."""
    part = F.struct(F.lit("text").alias("kind"), text.alias("text"))
    rest = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(part["kind"].alias("kind"), part["text"].alias("text"), *rest))


# The number of tokens an attachment stands for, by kind; unknown sizes count as one patch, nothing, or one page.
_TOKENS = {
    "image": lambda p: F.greatest(F.lit(1), F.ceil(F.coalesce(p["width"], F.lit(1)) / PATCH)) * F.greatest(F.lit(1), F.ceil(F.coalesce(p["height"], F.lit(1)) / PATCH)),
    "audio": lambda p: F.ceil(F.greatest(F.lit(0.0), F.coalesce(p["seconds"], F.lit(0.0))) * PER_SECOND),
    "document": lambda p: F.greatest(F.lit(1), F.coalesce(p["pages"], F.lit(1))) * PER_PAGE,
}


def _visited(parts: Column) -> Column:
    """The content of a turn. Texts side by side are joined before they are escaped, so that no two build a control string."""

    def visit(seen: Column, p: Column) -> Column:
        kind = p["kind"]
        attached = F.coalesce(kind.isin(*ATTACHMENTS), F.lit(False))
        return F.struct(
            F.when(attached, F.concat(seen["done"], escape(seen["text"]), F.lit("<"), kind, F.lit(">"))).otherwise(seen["done"]).alias("done"),
            F.when(attached, F.lit("")).otherwise(F.concat(seen["text"], F.coalesce(p["text"], F.lit("")))).alias("text"),
        )

    start = F.struct(F.lit("").alias("done"), F.lit("").alias("text"))
    return F.aggregate(parts, start, visit, lambda seen: F.concat(seen["done"], escape(seen["text"])))


def _attachment(p: Column) -> Column:
    tokens = F.lit(0).cast("long")
    for kind in ATTACHMENTS:
        tokens = F.when(p["kind"] == kind, _TOKENS[kind](p).cast("long")).otherwise(tokens)
    return F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), tokens.alias("tokens"))


def format_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, parts: Column, learn: str = "assistant") -> DataFrame:
    """(conv, turn, role, segment, head, body, attachments) of every row of df.

    segment is the formatted turn; of it, `body` code points after the first `head` are under the loss mask
    (0 for roles other than `learn`). Null roles, texts, parts and lists are empty; a very long text is one value like any other.
    """
    content = _visited(F.col("parts"))
    turns = df.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(parts, F.expr(f"cast(array() AS array<{PART}>)")).alias("parts"),
    )
    opened = F.concat(F.lit("<turn>"), escape(F.col("role")), F.lit("<says>"))
    turns = turns.select("conv", "turn", "role", "parts", opened.alias("opened"), content.alias("content"))
    attached = F.transform(F.filter("parts", lambda p: p["kind"].isin(*ATTACHMENTS)), _attachment)
    return turns.select(
        "conv",
        "turn",
        "role",
        F.concat("opened", "content", F.lit("</turn>\n")).alias("segment"),
        F.length("opened").cast("long").alias("head"),
        F.when(F.col("role") == learn, F.length("content")).otherwise(0).cast("long").alias("body"),
        attached.alias("attachments"),
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv, formatted, loss, attachments) of each conversation from format_turns().

    Turns come in order of number, nulls first; turns with the same number by role, then text. loss lists the spans
    (start, size) of `formatted`, in code points, that are learned; attachments are in order of their
    placeholders. A conversation becomes one text, and so one row; its turns are formatted before they meet.
    """
    order = ["turn", "role", "segment"]
    before = F.sum(F.length("segment")).over(Window.partitionBy("conv").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)).cast("long")
    placed = turns.withColumn("start", start + F.col("head"))
    whole = placed.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("start", "segment", "body", "attachments"))).alias("turns"))
    return whole.select(
        "conv",
        F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"),
        F.expr("transform(filter(turns, t -> t.body > 0), t -> struct(t.start AS start, t.body AS size))").alias("loss"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) of every turn of a formatted conversation, placeholders as they are."""
    segments = F.slice(F.split(formatted, "<turn>", -1), 2, 1 << 30)

    def read(s: Column) -> Column:
        role = F.substring_index(s, "<says>", 1)
        text = F.regexp_replace(F.substr(s, F.length(role) + F.lit(len("<says>") + 1)), r"</turn>\n\z", "")
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(segments, read)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    taken = F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["size"].cast("int"))))
    return F.array_join(taken, "")
