"""Duplicate rows: show, remove, count; key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

COPIES_PER_TASK = 1_000_000


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row of each group of equal rows; NULLs compare equal.

    Equal rows collapse on the map side, so a group holding any share of the table
    reaches the shuffle as one row per map task.
    """
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; every other column is kept.

    The rank filter is applied before the shuffle as well, so each map task sends at
    most one row per key.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _copy_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def duplicate_rows(df: DataFrame, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Every surplus copy of a row, numbered from 2 in ``rank_``.

    Copies are equal in all columns, so they are counted first and written out again
    from the count. A row with many copies is split into ranges of ranks, and the
    ranges are spread over the tasks.
    """
    step = F.lit(copies_per_task).cast("bigint")
    first = F.explode(F.sequence(F.lit(2).cast("bigint"), F.col("copies"), step))
    last = F.least(F.col("copies"), F.col("first") + step - 1)
    return (
        _copy_counts(df, df.columns)
        .withColumn("first", first)
        .repartition(*df.columns, "first")
        .withColumn("rank_", F.explode(F.sequence(F.col("first"), last)))
        .drop("copies", "first")
    )


def remaining_duplicates(df: DataFrame) -> DataFrame:
    """The number of surplus copies, as one row."""
    surplus = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint")
    return _copy_counts(df, df.columns).agg(surplus.alias("remaining_duplicates"))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return _copy_counts(df, keys).withColumnRenamed("copies", "row_count")
