"""Audit of filters that are applied one after another: what each removes in every order, alone and beside the others.

A document is one row of pass or fail bits. Rows are counted by part and bits, which leaves at most 32 cells a part, and
every question about an order of filters is a contraction of the cells, reshaped to 2x2x2x2x2: along the axis of each filter a
step takes those that pass, those that fail, or all. One einsum answers all steps of all orders for a batch of parts.

Equal texts meet by their digest. A text's first id is pre-aggregated, so that a text of a third of all rows has one row on
the other side of its join, and adaptive execution can split its rows. Only digests, bits and ids are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lens.session import cut_lineage

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITALS_PERCENT = 10
MARKS = "[#$%&*|]"
WORD = "([^\\x20\\x09-\\x0D]+)"
# Parts that are contracted together.
_PARTS = 64


def text_failures(text: Column, words: Column) -> list[Column]:
    """The failure conditions of the filters that see one text: too few words, too few distinct ones, capitals, marks."""
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    n = F.size(words)
    return [
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n,
        100 * capitals.cast("long") > MAX_CAPITALS_PERCENT * F.length(text),
        text.rlike(MARKS),
    ]


def failing(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, bits, good, toxic) of every row: bit k of bits is set where the row fails filter k.

    A null text counts as empty, a null part as the empty string. A row fails the last filter where any row with a
    smaller id has the same text; a row without id neither fails it nor makes others fail, and repeated ids don't either.
    A document is good or toxic where any of its label rows says so; without id or label it is neither.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(1)).alias("words"),
    )
    bits = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(text_failures(F.col("text"), F.col("words")))), F.lit(0))
    slim = cut_lineage(rows.select("id", "part", bits.alias("bits"), F.unhex(F.sha2("text", 256)).alias("sha")), "failing")
    firsts = slim.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("last > first").drop("last")
    # Written, so that the join has a plain shuffle on either side and can split the rows of a hot text.
    copies = slim.join(cut_lineage(firsts, "firsts"), "sha", "left")
    all_bits = F.col("bits") + F.when(F.col("id") > F.col("first"), 1 << (len(FILTERS) - 1)).otherwise(0)
    known = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    joined = copies.select("id", "part", all_bits.alias("bits")).join(known.where("good = 1 OR toxic = 1"), "id", "left")
    return joined.select("part", "bits", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])


def _steps() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """Every step of every order, and what each question selects along each axis: (steps, filters, pass and fail)."""
    passed, failed, whole = (1, 0), (0, 1), (1, 1)
    names, picks = [], {"kept": [], "removed": [], "failing": [], "alone": []}
    for order in permutations(range(len(FILTERS))):
        for k, own in enumerate(order):
            names.append(("".join(FILTERS[i] for i in order), k + 1))
            earlier = order[:k]
            axes = range(len(FILTERS))
            picks["kept"].append([passed if i in earlier or i == own else whole for i in axes])
            picks["removed"].append([failed if i == own else passed if i in earlier else whole for i in axes])
            picks["failing"].append([failed if i == own else whole for i in axes])
            picks["alone"].append([failed if i == own else passed for i in axes])
    return names, {name: np.array(p, dtype=np.int64) for name, p in picks.items()}


def contract(cells: np.ndarray) -> pd.DataFrame:
    """All steps of (parts, 2, 2, 2, 2, 2, measures) counts of rows, good and toxic ones; a row per part and step, parts outside."""
    names, picks = _steps()

    def along(name: str) -> np.ndarray:
        axes = [picks[name][:, i] for i in range(len(FILTERS))]
        return np.einsum("pabcdem,sa,sb,sc,sd,se->psm", cells, *axes, optimize=True)

    kept, removed, fails, alone = (along(n) for n in ("kept", "removed", "failing", "alone"))
    own = np.array([FILTERS.index(order[step - 1]) for order, step in names])
    over_orders = removed[:, :, 0] @ (own[:, None] == np.arange(len(FILTERS))).astype(np.int64)
    parts = len(cells)
    return pd.DataFrame(
        {
            "filter_order": [order for order, _ in names] * parts,
            "step": np.tile(np.array([step for _, step in names], dtype=np.int32), parts),
            "kept": kept[:, :, 0].reshape(-1),
            "removed": removed[:, :, 0].reshape(-1),
            "redundant": (fails - removed)[:, :, 0].reshape(-1),
            "unique_fails": alone[:, :, 0].reshape(-1),
            "good_lost": removed[:, :, 1].reshape(-1),
            "toxic_lost": removed[:, :, 2].reshape(-1),
            "shapley": over_orders[:, own].reshape(-1),
        }
    )


def _audit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for low in range(0, len(batch), _PARTS):
            own = batch.iloc[low : low + _PARTS]
            cells = np.zeros((len(own), 1 << len(FILTERS), 3), dtype=np.int64)
            for p, found in enumerate(own["cells"]):
                for cell in found:
                    cells[p, cell["bits"]] = cell["n"], cell["good"], cell["toxic"]
            # Bit 0 is the last axis of the reshape, the first filter the first axis.
            shaped = cells.reshape(len(own), *[2] * len(FILTERS), 3).transpose(0, *range(len(FILTERS), 0, -1), len(FILTERS) + 1)
            steps = contract(shaped)
            steps.insert(0, "part", np.repeat(own["part"].to_numpy(), len(steps) // len(own)))
            yield steps


_RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def audit(failures: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, zeros included, from rows of failing().

    kept and removed are of this step; redundant fails the step's filter, but went earlier; unique_fails fails no other filter;
    good_lost and toxic_lost are removed here; shapley is what the filter removes, summed over all orders. Repeated rows count
    each. Without rows there are no parts and no result.
    """
    cells = failures.groupBy("part", "bits").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    # At most 32 cells a part.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("cells"))
    return parts.mapInPandas(_audit, _RESULT)


def audit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """audit() of failing(). Other columns, whatever their names, don't matter; very long texts are one row like any other."""
    return audit(failing(docs, labels, id_col, text_col, part_col))
