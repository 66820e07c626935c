"""Postal-code and coordinate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sunlight.functions._col import as_col


def postal_code(c) -> Column:
    """Five-character postal code: left-pad with '0', truncate longer text."""
    return F.lpad(as_col(c).cast("string"), 5, "0")


def department_code(c) -> Column:
    """Department = first two characters of the padded postal code.

    A numeric postal code never yields '2A'/'2B' (Corsica), so 20xxx codes
    find no department row; that is the source behaviour and is kept.
    """
    return F.substring(postal_code(c), 1, 2)


def split_coordinate(c, index: int, sep: str = ",", strict: bool = True) -> Column:
    """Part ``index`` (1-based) of a ``"lat, lon"`` text as DOUBLE.
    A missing part is '' which fails the cast unless ``strict`` is off."""
    part = F.split_part(as_col(c), F.lit(sep), F.lit(index))
    return part.cast("double") if strict else part.try_cast("double")
