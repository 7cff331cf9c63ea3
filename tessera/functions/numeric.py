"""Aggregates with a fixed result regardless of partitioning.

A double sum depends on the order rows are added in, so two runs (or two
engines) can differ in the last bits. For values with a known number of
decimals, which the caller states, we sum as DECIMAL, which is exact, and divide
once at the end. A value with more decimals raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.strings import as_col


def exact_decimal(c, scale: int, precision: int = 38) -> Column:
    """The value as DECIMAL(precision, scale); a value that has more digits than
    that, or is not finite, is an error instead of being cut."""
    x = as_col(c)
    d = x.try_cast(f"decimal({precision},{scale})")
    lossless = x.isNull() | (d.cast("double") == x.cast("double"))
    return F.when(F.coalesce(lossless, F.lit(False)), d).otherwise(
        F.raise_error(F.format_string(f"%s does not fit DECIMAL({precision},{scale})", x.cast("string"))))


def exact_sum(c, scale: int, precision: int = 38) -> Column:
    """Sum of values with at most ``scale`` decimals, exact."""
    return F.sum(exact_decimal(c, scale, precision - 10)).cast("double")


def exact_avg(c, scale: int, precision: int = 38) -> Column:
    """Average of values with at most ``scale`` decimals: an exact sum, one division."""
    x = as_col(c)
    return F.try_divide(exact_sum(x, scale, precision), F.count(x))


def safe_ratio(a, b) -> Column:
    """a / b, null when b is 0 (ANSI mode raises on division by zero)."""
    return F.try_divide(as_col(a), as_col(b))
