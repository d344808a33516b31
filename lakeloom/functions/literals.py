"""Typed literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(text: str) -> Column:
    """Zone-less timestamp literal; comparing with one keeps the filter inside the scan."""
    return F.lit(text).cast("timestamp_ntz")


def iso(c: str | Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(c, pattern)


def half_up(c: Column, digits: int) -> Column:
    """Rounding on the binary value, so that every IEEE engine gives the same digits.

    From 2^53 units of the last digit on a double has no digits left to round and stays as it is; the whole numbers below fit a long.
    """
    scale = float(10**digits)
    return F.when(F.abs(c) >= 2.0**53 / scale, c.cast("double")).otherwise(F.floor(c * scale + 0.5) / scale)


def units(c: str | Column, digits: int = 2) -> Column:
    """Amount in whole units of its last decimal, as an integer decimal.

    Casting a double to a decimal goes through text; flooring it to a long first does not. The sum stays
    a decimal, since a long would overflow on very large tables.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * float(10**digits) + 0.5).cast("decimal(18,0)")


def exact_sum(c: str | Column, digits: int = 2) -> Column:
    """Sum of amounts with a fixed number of decimals, free of floating-point order effects."""
    return F.sum(units(c, digits)).cast("double") / float(10**digits)


def exact_mean(c: str | Column, digits: int = 2) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_divide(exact_sum(c, digits), F.count(c))
