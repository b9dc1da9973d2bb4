"""Documents at the edges: nulls, empty and long texts, repeated rows and ids, columns named like inner ones."""

CLASHING = ("row", "id", "no", "sha", "fp", "kept", "label", "value", "out", "component_id", "hit", "block", "covered", "new", "score")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
LONG = "alpha beta gamma delta. " * 20_000
TEXTS = [
    (1, "One plain text, with a few words in it. And a second sentence of it."),
    (2, None),
    (3, ""),
    (4, "  \t\n "),
    (5, LONG),
    (5, LONG),
    (6, "One plain text,  with a few words in it. And a second\nsentence of it."),
    (None, "A text without an id, which stands here twice for good measure."),
    (None, "A text without an id, which stands here twice for good measure."),
    (7, "x"),
    (8, "Ünïcode — 漢字   and spaces; <|endoftext|> 😀 'll don't"),
]


def documents(spark, texts=None, schema=SCHEMA):
    rows = [(i, t, "en", "s", None, *["x"] * len(CLASHING)) for i, t in (TEXTS if texts is None else texts)]
    return spark.createDataFrame(rows, schema)


def stored(spark, df, path):
    """df as a stored table in several files."""
    df.repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))
