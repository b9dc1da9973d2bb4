"""JSON held as text: validation, score extraction, documents and model results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from commerce_lens.functions.scalars import as_col

# The aspect names read by the marts, in mart order.
ASPECTS = ("delivery", "product_quality", "customer_service", "refund_process", "packaging_condition")

RESULT_SCHEMA = (
    "custom_id string, response struct<status_code:int,"
    "body:struct<choices:array<struct<message:struct<content:string>>>>>"
)

# Naming the default mode keeps the parse expression identical for every field, so it is
# evaluated once per row; without it each field gets its own single-field parse (2x slower).
PARSE_ONCE = {"mode": "PERMISSIVE"}


# What the source's cast to a number reads, what Spark's cast reads beyond that, and an object or a list.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
SUFFIXED = r"(?i)[\d.][df]\s*$"
NESTED = r"^\s*[\{\[]"


def json_valid(c: Column | str) -> Column:
    """TRUE for well-formed JSON text, FALSE for malformed text, NULL for NULL."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.try_parse_json(c).isNotNull())


def json_checked(c: Column | str, tolerant: bool = False) -> Column:
    """The text itself when well-formed. Malformed text is an error, or NULL when tolerant."""
    c = as_col(c)
    bad = F.lit(None).cast("string") if tolerant else F.raise_error(F.concat(F.lit("malformed JSON: "), c))
    return F.when(F.try_parse_json(c).isNotNull(), c).when(c.isNotNull(), bad)


def _score_texts(c: Column | str, keys: Iterable[str]) -> Column:
    """The text of each key's value. Declared as STRING, a nested value arrives as its own JSON text."""
    c = as_col(c)
    fields = ", ".join(f"`{k}` string" for k in keys)
    return F.from_json(F.when(F.ltrim(c).startswith("{"), c), fields, PARSE_ONCE)


def json_scores(c: Column | str, keys: Iterable[str] = ASPECTS, strict: bool = False) -> Column:
    """STRUCT of DOUBLE, one field per key, from one pass over the document.

    A missing key, null, an object or an array gives NULL; a number written as text is
    read. Other text, "1d" included, is NULL (json_rejects counts it), or an error when strict.
    """
    doc = _score_texts(c, keys)

    def score(text: Column) -> Column:
        if strict:
            suffixed = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double")
            number = F.when(text.rlike(SUFFIXED), suffixed).otherwise(text.cast("double"))
            return F.when(~text.rlike(NESTED), number)
        return F.when(text.rlike(NUMBER), text.cast("double"))

    return F.struct(*[score(doc[k]).alias(k) for k in keys])


def json_rejects(c: Column | str, keys: Iterable[str] = ASPECTS) -> Column:
    """The keys whose value json_scores leaves out although it is neither missing, null nor nested."""
    doc = _score_texts(c, keys)
    bad = [F.when(doc[k].isNotNull() & ~doc[k].rlike(NUMBER) & ~doc[k].rlike(NESTED), F.lit(k)) for k in keys]
    return F.array_compact(F.array(*bad))


def json_doc(**cols: Column) -> Column:
    """A JSON document from named columns."""
    return F.to_json(F.struct(*[as_col(v).alias(k) for k, v in cols.items()]))


def result_fields(c: Column | str) -> Column:
    """STRUCT(id, status, content) of one model result document; NULL fields where absent."""
    doc = F.from_json(as_col(c), RESULT_SCHEMA, PARSE_ONCE)
    return F.struct(
        doc["custom_id"].alias("id"),
        doc["response"]["status_code"].alias("status"),
        F.get(doc["response"]["body"]["choices"], F.lit(0))["message"]["content"].alias("content"),
    )
