"""Aggregate column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commerce_lens.functions.scalars import amount, as_col, divide, money


def count_col(c: Column | str) -> Column:
    """Rows where c is not NULL."""
    return F.count(as_col(c))


def count_distinct(c: Column | str) -> Column:
    return F.count_distinct(as_col(c))


def money_sum(c: Column | str) -> Column:
    """STRUCT(exact, odd): the sum of a column of amounts, to be added up further or shown by amount()."""
    parts = money(c)
    return F.struct(F.sum(parts["exact"]).alias("exact"), F.sum(parts["odd"]).alias("odd"))


def add_money(sums: str) -> Column:
    """The sum of a column of money_sum() results."""
    return F.struct(F.sum(f"{sums}.exact").alias("exact"), F.sum(f"{sums}.odd").alias("odd"))


def sum_money(c: Column | str) -> Column:
    """Exact sum, returned as DOUBLE; NULL for an all-NULL group, NaN if an amount is NaN."""
    return amount(money_sum(c))


def avg_money(c: Column | str) -> Column:
    """Exact sum over the non-NULL count; NULL for an all-NULL group, NaN if an amount is NaN."""
    return F.try_divide(sum_money(c), count_col(c).cast("double"))


def avg_col(c: Column | str) -> Column:
    return F.avg(as_col(c))


def count_where(pred: Column) -> Column:
    """Rows where pred is TRUE; 0 if there are none."""
    return F.count_if(pred)


def ratio(a: Column, b: Column) -> Column:
    """Fractional ratio of two aggregates; a zero divisor is an error."""
    return divide(a, b)


def weighted_avg(total: Column | str, weight: Column | str) -> Column:
    """sum(total) / sum(weight), NULL when the weights add up to nothing."""
    return F.try_divide(F.sum(as_col(total)).cast("double"), F.sum(as_col(weight)).cast("double"))
