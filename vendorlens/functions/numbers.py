"""Guarded arithmetic, rounding, and sums that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Amounts are added as decimals, so a sum does not depend on the order of its rows.
AMOUNT = "decimal(28,12)"


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; 0 where the denominator is 0."""
    return F.when(
        denominator != 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))


def finite_or_zero(column: Column) -> Column:
    """0 for NULL, NaN and both infinities."""
    bounded = F.when(F.abs(column) == float("inf"), F.lit(0.0)).otherwise(F.nanvl(column, F.lit(0.0)))
    return F.coalesce(bounded, F.lit(0.0))


def round_cents(column: Column) -> Column:
    """Two decimals by scale, round half to even, unscale: the rule of array libraries."""
    return F.rint(column * 100.0) / 100.0


def exact_sum(column: Column) -> Column:
    """Sum of values taken to twelve decimals; 0 when there is nothing to add."""
    return F.coalesce(F.sum(column.cast(AMOUNT)).cast("double"), F.lit(0.0))


def exact_mean(column: Column) -> Column:
    """Mean of values taken to twelve decimals; NULL when there is none."""
    return F.sum(column.cast(AMOUNT)).cast("double") / F.nullif(F.count(column), F.lit(0))
