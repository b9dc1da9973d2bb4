"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits after the point that amounts are summed with; the sum is exact for amounts of no more digits and
# doesn't depend on partition order.
MONEY_SCALE = 10


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(c: Column | str) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(as_col(c))


def month_start(c: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(to_day(c), "MM")


def year_month(c: Column | str) -> Column:
    """Month as six digits, e.g. 201803."""
    return F.date_format(to_day(c), "yyyyMM")


def year_of(c: Column | str) -> Column:
    return F.year(as_col(c))


def month_of(c: Column | str) -> Column:
    return F.month(as_col(c))


def to_ts(c: Column | str) -> Column:
    """Text or date to timestamp."""
    return F.to_timestamp(as_col(c))


def to_double(c: Column | str, tolerant: bool = False) -> Column:
    """Text to DOUBLE. Unreadable text is an error, or NULL when tolerant."""
    return as_col(c).try_cast("double") if tolerant else as_col(c).cast("double")


def clean_text(c: Column | str) -> Column:
    """Newlines become spaces, then whitespace of any kind is stripped at both ends."""
    one_line = F.translate(as_col(c), "\n", " ")
    return F.regexp_replace(one_line, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def prompt(prefix: str, c: Column | str, suffix: str = "") -> Column:
    """Constant text around a column."""
    return F.concat(F.lit(prefix), as_col(c), F.lit(suffix))


def divide(a: Column | str, b: Column | str) -> Column:
    """Fractional division; a zero divisor is an error."""
    return as_col(a).cast("double") / as_col(b).cast("double")


def money(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """STRUCT(exact, odd): an amount as DECIMAL, or as it is where it is not a finite number."""
    c = as_col(c)
    finite = F.abs(c) < F.lit(float("inf"))
    return F.struct(F.when(finite, c.cast(f"decimal(38, {scale})")).alias("exact"), F.when(~finite, c).alias("odd"))


def amount(sums: Column | str) -> Column:
    """A sum of money as DOUBLE: NULL for no amount, NaN or infinite if an amount was."""
    sums = as_col(sums)
    exact, odd = sums["exact"].cast("double"), sums["odd"]
    return F.when(odd.isNull(), exact).otherwise(odd + F.coalesce(exact, F.lit(0.0)))
