"""Cleaning of the vendor x product summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.numbers import finite_or_zero
from ..functions.text import strip


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]


def _volume(strict: bool) -> Column:
    text = strip(F.col("Volume").cast("string"))
    return text.cast("double") if strict else text.try_cast("double")


def clean_summary(summary: DataFrame, strict: bool = True) -> DataFrame:
    """Volume as a number, missing and infinite numbers as 0, names without padding.

    Text that is no number fails in ``strict`` mode and becomes 0 otherwise
    (``rejected_volumes`` counts it). Missing names stay NULL.
    """
    numbers = summary.withColumn("Volume", _volume(strict))
    numbers = numbers.withColumns({c: finite_or_zero(F.col(c)) for c in double_columns(numbers)})
    names = {c: strip(F.col(c)) for c in ("VendorName", "BrandName")}
    return numbers.fillna(0).withColumns(names)


def rejected_volumes(summary: DataFrame) -> DataFrame:
    """How many Volume texts are no number, as one row."""
    bad = F.col("Volume").isNotNull() & _volume(strict=False).isNull()
    return summary.agg(F.count_if(bad).alias("rejected"))
