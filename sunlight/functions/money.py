"""Parsers for the two number dialects found in administrative files.

* payments write ``1200,50`` (decimal comma, no grouping): only ',' is
  replaced, so a grouped value such as ``1.234,56`` is an error;
* prescriptions write ``12.345,50`` (dot groups thousands, comma marks the
  decimals): every '.' is removed first, so ``12.50`` reads as 1250.

Both are plain ``replace`` + ``cast`` (or ``try_cast`` when ``strict`` is
off), so they run in codegen and keep ANSI's error on malformed input.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sunlight.functions._col import as_col


def _cast(c: Column, type_: str, strict: bool) -> Column:
    return c.cast(type_) if strict else c.try_cast(type_)


def parse_comma_decimal(c, precision: int = 18, scale: int = 2,
                        strict: bool = True) -> Column:
    """``'1200,50'`` -> DECIMAL(precision, scale); rounds half-up on the scale."""
    text = as_col(c).cast("string")
    return _cast(F.replace(text, F.lit(","), F.lit(".")),
                 f"decimal({precision},{scale})", strict)


def parse_fr_number(c, to: str = "decimal(18,3)", strict: bool = True,
                    null_as: str | None = None) -> Column:
    """``'12.345,50'`` -> number. ``null_as`` substitutes NULL *and* blank
    text before parsing (``coalesce(nullif(trim(x), ''), null_as)``)."""
    text = as_col(c).cast("string")
    if null_as is not None:
        text = F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(null_as))
    no_groups = F.replace(text, F.lit("."), F.lit(""))
    return _cast(F.replace(no_groups, F.lit(","), F.lit(".")), to, strict)


def to_money_text(c, scale: int = 2, grouped: bool = False) -> Column:
    """Render a number the way the source files write it (used to build
    round-trip inputs): decimal comma, optionally dot-grouped thousands."""
    d = as_col(c).cast(f"decimal(38,{scale})")
    if not grouped:
        return F.replace(d.cast("string"), F.lit("."), F.lit(","))
    whole = F.abs(d).cast("decimal(38,0)") if scale == 0 else F.floor(F.abs(d))
    frac = F.abs(d) - whole
    sign = F.when(d < 0, F.lit("-")).otherwise(F.lit(""))
    grouped_whole = F.replace(F.format_number(whole, 0), F.lit(","), F.lit("."))
    frac_txt = F.lpad((frac * (10 ** scale)).cast("bigint").cast("string"), scale, "0")
    return F.concat(sign, grouped_whole, F.lit(","), frac_txt)
