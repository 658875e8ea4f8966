"""Rounding rules of the reference (NumPy rounds half to even)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(c: Column, scale: int = 0) -> Column:
    """Half-to-even rounding (``bround``); ``round`` would round halves up."""
    return F.bround(c, scale)


def clamp_round_long(c: Column) -> Column:
    """Quantile to stored integer: max(0, x), half-even to 0 decimals, bigint.

    The value is first rounded to 6 decimals so that float noise from the
    percentile interpolation cannot flip a .5 tie.
    """
    return F.bround(F.greatest(F.lit(0.0), F.bround(c.cast("double"), 6)), 0).cast("long")
