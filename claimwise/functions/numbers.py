"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_NUMERIC = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def nan_to_null(c: Column) -> Column:
    """DOUBLE with missing values as NULL only."""
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def coerce_number(c: Column) -> Column:
    """Text to DOUBLE; malformed text and NaN become NULL."""
    text = c.cast("string")
    return F.when(F.rlike(text, F.lit(_NUMERIC)), F.trim(text).try_cast("double"))


def as_double(c: Column, dtype: T.DataType) -> Column:
    """DOUBLE view of a column of the given type for statistics.

    Adding zero turns -0.0 into 0.0: grouping treats the two as equal, but a
    search among bucket borders does not.
    """
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return nan_to_null(c) + F.lit(0.0)
    return c.cast("double")


def round_cents(c: Column) -> Column:
    """Two decimals, rounding the scaled value half to even."""
    return F.rint(c * F.lit(100.0)) / F.lit(100.0)


def format_thousands(c: Column) -> Column:
    """No decimals, half to even, dot as thousands separator."""
    return F.translate(F.format_number(c, 0), ",", ".")
