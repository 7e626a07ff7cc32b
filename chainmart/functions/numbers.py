"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hex_digits_to_long(digits: Column) -> Column:
    """Hex digits (no prefix) to long; 2^63 and above is NULL.

    ``conv`` reads 16 digits at most, so longer inputs must be stripped of
    leading zeros and screened by the caller's pattern first.
    """
    return F.conv(F.regexp_replace(digits, "^0+(?=.)", ""), 16, 10).try_cast("bigint")


def hex_to_long(c: Column) -> Column:
    """``0x`` text as base 16, any other integer text as base 10, junk as NULL."""
    x = F.lower(F.trim(c.cast("string")))
    return F.when(
        x.rlike("^0x0*[0-9a-f]{1,16}$"), _hex_digits_to_long(F.regexp_replace(x, "^0x", ""))
    ).when(x.rlike("^[+-]?[0-9]+$"), x.try_cast("bigint"))


def base16_to_long(c: Column) -> Column:
    """Always base 16, with or without the ``0x`` prefix; junk as NULL."""
    x = F.lower(F.trim(c.cast("string")))
    return F.when(
        x.rlike("^(0x)?0*[0-9a-f]{1,16}$"), _hex_digits_to_long(F.regexp_replace(x, "^0x", ""))
    )


def as_decimal(c: Column, precision: int, scale: int) -> Column:
    """Fixed-scale cast that yields NULL on overflow, NaN or junk instead of failing."""
    return c.try_cast(f"decimal({precision},{scale})")


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over pairs with both sides present; NULL for a constant side.

    ``corr`` fails under ANSI when a side is constant, so the quotient is spelled out.
    """
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))
