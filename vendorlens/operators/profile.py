"""Looking at tables: counts, previews, columns, distinct values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.text import digit_residue


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview(df: DataFrame, rows: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first rows; with ``order`` they are the same on every run."""
    return (df.orderBy(*order) if order else df).limit(rows)


def rows_of(df: DataFrame, column: str, value) -> DataFrame:
    """The rows of one vendor (or any other value)."""
    return df.where(F.col(column) == value)


def column_profile(df: DataFrame) -> DataFrame:
    """Rows, NULLs and type of each column, in one pass."""
    one_row = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return one_row.unpivot("row_count", df.columns, "column", "nulls").select(
        "column", F.element_at(types, F.col("column")).alias("type"), "row_count", "nulls"
    )


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column."""
    return column_profile(df).select("column", "nulls")


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values, NULL not counted."""
    return df.agg(F.count_distinct(column).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, NULL included."""
    return df.select(column).distinct()


def top_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The most frequent values; equal counts in value order."""
    return (
        df.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), column).limit(n)
    )


def residue(df: DataFrame, column: str) -> DataFrame:
    """Distinct leftovers of a text column after its digits are removed."""
    return df.select(digit_residue(F.col(column)).alias("residue")).distinct()
