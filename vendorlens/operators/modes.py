"""The most frequent value of each column, from bounded counts of frequent items.

A task keeps at most `KEPT` values of a column with their counts. Where there are more, the count of the first value
that is not kept is taken off all others and noted as *lost*; so a value's true count lies between what
is kept of it, added up over the tasks, and that plus all that is lost. A value whose lower bound is above the upper bound of
every other one, kept or not, is the mode, and no value was shuffled for it but the kept ones. Without losses the
counts are exact. Columns where the bounds leave the mode open, by a tie or too flat a distribution, are counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..sources.shared import ship
from .clean import numeric_columns
from .quantiles import long_form

#: Values of a column that a task keeps.
KEPT = 4096
_ITEMS = "column string, number double, text string, n bigint, lost bigint"


class _Frequent:
    """Bounded counts of the values of one column."""

    def __init__(self, kept: int):
        self.kept, self.counts, self.lost = kept, {}, 0

    def add(self, values: pa.Array) -> None:
        for pair in pc.value_counts(values).to_pylist():
            self.counts[pair["values"]] = self.counts.get(pair["values"], 0) + pair["counts"]
        if len(self.counts) > 2 * self.kept:
            self.cut()

    def cut(self) -> None:
        if len(self.counts) <= self.kept:
            return
        off = sorted(self.counts.values(), reverse=True)[self.kept]
        self.counts = {v: n - off for v, n in self.counts.items() if n > off}
        self.lost += off


def _items(names: list[str], numbers: int, kept: int):
    """A task's kept values of each column (the first ``numbers`` are numbers), and what it has lost."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_Frequent(kept) for _ in names]
        for batch in batches:
            for i, column in enumerate(batch.columns):
                column = column.drop_null()
                if i < numbers:
                    column = pc.add(column.filter(pc.invert(pc.is_nan(column))), 0.0)  # one zero
                found[i].add(column)
        for i, (name, items) in enumerate(zip(names, found)):
            items.cut()
            values, counts = list(items.counts), list(items.counts.values())
            none = [None] * (len(values) + 1)
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * len(none), pa.string()), pa.array([*values, None] if i < numbers else none, pa.float64()),
                pa.array(none if i < numbers else [*values, None], pa.string()), pa.array([*counts, 0], pa.int64()),
                pa.array([0] * len(values) + [items.lost], pa.int64())], [c.split()[0] for c in _ITEMS.split(", ")])

    return task


def _smallest_mode(pairs: DataFrame) -> DataFrame:
    """The most frequent value per column, the smallest where several are."""
    counts = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("copies"))
    return counts.groupBy("column").agg(
        F.min(F.struct((-F.col("copies")).alias("order"), "value")).alias("best")
    ).select("column", F.col("best.value").alias("value"))


def modes(df: DataFrame, kept: int = KEPT) -> DataFrame:
    """The smallest most frequent value of each column, numeric and text; none for a column without values."""
    ship(df.sparkSession)
    numbers = numeric_columns(df)
    texts = [c for c, t in df.dtypes if t == "string"]
    names = [*numbers, *texts]
    rows = df.select(
        *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(numbers)],
        *[F.col(f"`{c}`").alias(f"c{len(numbers) + i}") for i, c in enumerate(texts)])
    items = rows.mapInArrow(_items(names, len(numbers), kept), _ITEMS).groupBy("column", "number", "text").agg(
        F.sum("n").alias("n"), F.sum("lost").alias("lost"))
    # by count: how many values have it, and the least of them; there are far fewer counts than values
    levels = items.groupBy("column", F.when(F.col("lost") + F.col("n") > 0, F.col("n")).alias("n"), (F.col("n") == 0).alias("none")).agg(
        F.count(F.lit(1)).alias("values"), F.min("number").alias("number"), F.min("text").alias("text"), F.sum("lost").alias("lost"))
    columns = levels.groupBy("column").agg(
        F.sum("lost").alias("lost"),
        F.array_sort(F.collect_list(F.when(~F.col("none"), F.struct((-F.col("n")).alias("order"), "n", "values", "number", "text")))).alias("by_count"))
    top, next_ = F.get("by_count", F.lit(0)), F.coalesce(F.get("by_count", F.lit(1))["n"], F.lit(0))
    proven = (F.col("lost") == 0) | ((top["values"] == 1) & (top["n"] > next_ + F.col("lost")))
    judged = columns.where(F.size("by_count") > 0).select("column", top["number"].alias("number"), top["text"].alias("text"), proven.alias("proven"))
    # lost values may be all there is of a column
    open_ = columns.select("column", (F.coalesce(F.size("by_count") > 0, F.lit(False)) & F.coalesce(proven, F.lit(False))).alias("proven"), "lost")
    unproven = open_.where("NOT proven AND lost > 0").agg(F.collect_list("column")).scalar()
    found = judged.where("proven").select("column", "number", "text")

    def left(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("_open", unproven).where(F.array_contains("_open", F.col("column"))).drop("_open")

    if numbers:
        found = found.unionByName(_smallest_mode(left(long_form(df, numbers))).select(
            "column", F.col("value").alias("number"), F.lit(None).cast("string").alias("text")))
    if texts:
        words = df.select([F.col(f"`{c}`") for c in texts]).unpivot([], texts, "column", "value").dropna(subset=["value"])
        found = found.unionByName(_smallest_mode(left(words)).select(
            "column", F.lit(None).cast("double").alias("number"), F.col("value").alias("text")))
    return found
