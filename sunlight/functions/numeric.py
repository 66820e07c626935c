"""Arithmetic helpers with the rounding rules written down."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sunlight.functions._col import as_col


def round_half_up(c, digits: int, to: str = "double") -> Column:
    """ROUND on the decimal value rather than the binary double.

    ``round(1.005, 2)`` on a raw double depends on the engine (1.0 or 1.01);
    going through DECIMAL(38,6) makes it 1.01 everywhere.
    """
    r = F.round(as_col(c).cast("decimal(38,6)"), digits)
    return r.cast(to) if to else r


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an ANSI division error."""
    return as_col(num) / F.nullif(as_col(den), F.lit(0))
