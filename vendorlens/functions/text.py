"""Text helpers: stripping, residue checks and dollar labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters that stripping removes: Unicode white space and the four ASCII separators.
_BLANK = r"[\s\x1c-\x1f]"


def strip(column: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` would remove spaces only)."""
    return F.regexp_replace(column, rf"(?U)^{_BLANK}+|{_BLANK}+\z", "")


def digit_residue(column: Column) -> Column:
    """What is left of a text without its digits: empty for a whole number."""
    return F.regexp_replace(column, "[0-9]", "")


def _two_decimals(x: Column) -> Column:
    """``x >= 1`` with two decimals, rounded from its exact binary value, half to even.

    The product with 100 may itself be rounded onto a tie. The high and low halves of
    ``x`` have few enough bits for exact products, so what is left over the rounded
    cents is exact and shows on which side of the tie ``x`` lies.
    """
    split = x * 134217729.0  # 2**27 + 1 parts a double into two halves
    high = split - (split - x)
    cents = F.rint(x * 100.0)
    rest = (high * 100.0 - cents) + (x - high) * 100.0
    exact = cents + F.when(rest > 0.5, 1.0).when(rest < -0.5, -1.0).otherwise(0.0)
    return (exact.cast("decimal(17,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("string")


def _plain(x: Column) -> Column:
    """A double in plain notation with at least one decimal, e.g. ``-12000000.0``."""
    digits = x.cast("decimal(38,16)").cast("string")
    return F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")


def dollars(column: Column) -> Column:
    """``1.50M`` from a million up, ``1.50K`` from a thousand up, else the plain number.

    Negative amounts always read as the plain number.
    """
    x = column.cast("double")
    millions = x >= 1_000_000
    scaled = x / F.when(millions, 1_000_000.0).otherwise(1_000.0)
    unit = F.when(millions, "M").otherwise("K")
    return F.when(x >= 1_000, F.concat(_two_decimals(scaled), unit)).otherwise(_plain(x))
