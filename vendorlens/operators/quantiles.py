"""Exact quantiles of columns of any length by radix selection, in one plan that runs no job of its own.

A double becomes a 64-bit key that sorts like it. Each of `PASSES` scans counts one digit of 16 bits: the first
one of all values, the later ones only of values whose earlier digits are those of a wanted rank.
A task counts its values in Arrow batches of the wide rows, all columns at once, and sends
counts of digits; no value is shuffled, sorted or sketched, whatever the spread of a column. The state between two
scans, a few numbers for each wanted rank, is a scalar subquery that rides on the first row of every partition.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.shared import ship

BITS, PASSES = 16, 4
_SIGN = np.uint64(1 << 63)
_ROW_BITS = 33  # monotonically_increasing_id: partition number above 33 row bits
_COUNTED = "label string, prefix bigint, digit int, place int, rank bigint, n bigint, v double"


def long_form(df: DataFrame, columns: Sequence[str], label: str = "column") -> DataFrame:
    """One (column, value) row for each number in ``columns``, without NULL and NaN."""
    doubles = df.select([F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([], list(columns), label, "value").dropna(subset=["value"])  # drops NaN too


def keys_of(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit keys that sort like the values; both zeros have one key."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def values_of(keys: np.ndarray) -> np.ndarray:
    return np.where(keys & _SIGN, keys & ~_SIGN, ~keys).view(np.float64)


class _Counter:
    """A task's counts of the ``number``-th digit, by label and the digits before it."""

    def __init__(self, number: int, state: list[dict]):
        self.number, self.shift = number, np.uint64(64 - BITS * (number + 1))
        self.state = state
        self.wanted: dict[str, np.ndarray] = {}
        for label in {s["label"] for s in self.state}:
            self.wanted[label] = np.array(sorted({s["prefix"] for s in self.state if s["label"] == label}), dtype=np.uint64)
        self.counts: dict[str, np.ndarray] = {}

    def add(self, label: str, column: pa.Array) -> None:
        values = column.drop_null().to_numpy(zero_copy_only=False)
        values = values[~np.isnan(values)]
        wanted = self.wanted.get(label, np.zeros(1, np.uint64)) if self.number == 0 else self.wanted.get(label)
        if wanted is None or not len(values):
            return
        keys = keys_of(values)
        digits = (keys >> self.shift) & np.uint64((1 << BITS) - 1)
        if self.number:
            prefixes = keys >> (self.shift + np.uint64(BITS))
            place = np.minimum(np.searchsorted(wanted, prefixes), len(wanted) - 1)
            mine = wanted[place] == prefixes
            digits = digits[mine] + (place[mine].astype(np.uint64) << np.uint64(BITS))
        if label not in self.counts:
            self.counts[label] = np.zeros(len(wanted) << BITS, dtype=np.int64)
        self.counts[label] += np.bincount(digits.astype(np.int64), minlength=len(wanted) << BITS)

    def out(self) -> Iterator[pa.RecordBatch]:
        """Cells that hold values; and the wanted ranks, from each task alike."""
        names = [c.split()[0] for c in _COUNTED.split(", ")]
        for label, counts in self.counts.items():
            at = np.flatnonzero(counts)
            prefix = self.wanted[label][at >> BITS] if self.number else np.zeros(len(at), np.uint64)
            digit = (at & ((1 << BITS) - 1)).astype(np.int32)
            none = np.ones(len(at), dtype=bool)
            last = values_of((prefix << np.uint64(BITS)) | digit.astype(np.uint64)) if self.number == PASSES - 1 else np.zeros(len(at))
            yield pa.RecordBatch.from_arrays([
                pa.array([label] * len(at), pa.string()), pa.array(prefix.astype(np.int64)), pa.array(digit),
                pa.array(np.zeros(len(at), np.int32), mask=none), pa.array(np.zeros(len(at), np.int64), mask=none),
                pa.array(counts[at]), pa.array(last)], names)
        s = self.state
        yield pa.RecordBatch.from_arrays([
            pa.array([x["label"] for x in s], pa.string()), pa.array([x["prefix"] for x in s], pa.int64()), pa.array([-1] * len(s), pa.int32()),
            pa.array([x["place"] for x in s], pa.int32()), pa.array([x["rank"] for x in s], pa.int64()),
            pa.array([0] * len(s), pa.int64()), pa.array([0.0] * len(s), pa.float64())], names)


def _count_digits(number: int, labels: list[str] | None):
    """A scan's task: the state is in the first row; then come columns of numbers, or a label and its number."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if counter is None:
                counter = _Counter(number, json.loads(batch.column(0)[0].as_py() or "[]"))
            if labels is not None:
                for i, label in enumerate(labels):
                    counter.add(label, batch.column(i + 1))
                continue
            coded = batch.column(1).dictionary_encode()
            place = coded.indices.to_numpy(zero_copy_only=False)
            for i, label in enumerate(coded.dictionary.to_pylist()):
                counter.add(label, batch.column(2).filter(pa.array(place == i)))
        if counter is not None:
            yield from counter.out()

    return task


def _selected(rows: DataFrame, labels: list[str] | None, probs: Sequence[float]) -> DataFrame:
    """The values of the wanted ranks: (label, place, v); ``place`` counts two ranks for each of ``probs``."""
    wanted = ", ".join(f"{float(p)!r}D" for p in probs)
    ranks = f"""flatten(transform(array({wanted}), (p, i) -> array(
        struct(int(2 * i) AS place, bigint(floor((total - 1) * p)) AS rank),
        struct(int(2 * i + 1) AS place, bigint(least(floor((total - 1) * p) + 1, total - 1)) AS rank))))"""
    first_row = F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1) == 0
    state = None
    for number in range(PASSES):
        carried = F.lit(None).cast("string") if state is None else F.when(first_row, state)
        counted = rows.select(carried.alias("_state"), *rows.columns).mapInArrow(_count_digits(number, labels), _COUNTED)
        cells = counted.groupBy("label", "prefix", "digit", "place", "rank").agg(F.sum("n").alias("n"), F.max("v").alias("v"))
        group = Window.partitionBy("label", "prefix")
        upto = group.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        if state is None:
            cells = cells.withColumn("total", F.sum("n").over(group)).withColumn("ranks", F.expr(ranks))
        else:  # the ranks that the tasks sent along
            cells = cells.withColumn("ranks", F.collect_list(F.when(F.col("digit") < 0, F.struct("place", "rank"))).over(group))
        found = cells.where("digit >= 0").withColumn("past", F.sum("n").over(upto)).select(
            "label", "prefix", "digit", "v", "n", "past",
            F.expr("inline(filter(ranks, r -> r.rank >= past - n AND r.rank < past))"))
        found = found.select(
            "label", "place", ((F.col("prefix") * (1 << BITS)) + F.col("digit")).alias("prefix"),
            (F.col("rank") - F.col("past") + F.col("n")).alias("rank"), "v")
        if number < PASSES - 1:  # the last prefix would be the whole key, which is not wanted
            # as text: a nested column costs far more on its way to the tasks, even where it is NULL
            state = found.agg(F.to_json(F.collect_list(F.struct("label", "place", "prefix", "rank")))).scalar()
    return found.select("label", "place", "v")


def _interpolated(rows: DataFrame, labels: list[str] | None, probs: Sequence[float], counts: DataFrame) -> DataFrame:
    """Quantiles with linear interpolation: (label, p, quantile). ``counts`` has n for each label."""
    ship(rows.sparkSession)
    index = F.floor(F.col("place") / 2).cast("int")
    ends = _selected(rows, labels, probs).groupBy("label", index.alias("i")).agg(
        F.max(F.when(F.col("place") % 2 == 0, F.col("v"))).alias("low"), F.max(F.when(F.col("place") % 2 == 1, F.col("v"))).alias("high"))
    p = F.element_at(F.array(*[F.lit(float(x)) for x in probs]), F.col("i") + 1)
    sizes = counts.agg(F.map_from_entries(F.collect_list(F.struct("label", "n")))).scalar()
    share = (F.col("n") - 1) * F.col("p") - F.floor((F.col("n") - 1) * F.col("p"))
    return ends.withColumn("p", p).withColumn("n", F.element_at(sizes, F.col("label"))).select(
        "label", "p", (F.col("low") + (F.col("high") - F.col("low")) * share).alias("quantile"))


def wide_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], label: str = "column") -> DataFrame:
    """Quantiles of several columns at once, as rows (``label``, p, quantile), without unpivoting a row.

    NULL and NaN are left out; a column without values gives no rows.
    """
    names = list(columns)
    rows = df.select([F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    there = [F.struct(F.lit(c).alias("label"), F.count_if(F.col(f"v{i}").isNotNull() & ~F.isnan(f"v{i}")).alias("n")) for i, c in enumerate(names)]
    counts = rows.agg(F.array(*there).alias("c")).select(F.inline("c"))
    return _interpolated(rows, names, probs, counts).withColumnRenamed("label", label)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: str | None = None) -> DataFrame:
    """Quantiles with linear interpolation, as rows (``by``, p, quantile).

    ``by`` names a column with a small fixed set of values, such as measure names or
    size labels: a task holds the counts of each. NULL and NaN values are left out, as are rows without a label;
    a group without values gives no rows. The column is scanned five times and never shuffled: only counts move.
    """
    if by is None:
        return wide_quantiles(df, [value], probs, "_label").drop("_label")
    rows = df.select(F.col(by).cast("string").alias("label"), F.col(value).cast("double").alias("v"))
    rows = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return _interpolated(rows, None, probs, counts).withColumnRenamed("label", by)


def quantile_columns(quantiles: DataFrame, names: dict[str, float], by: str | None = None) -> DataFrame:
    """The rows of ``exact_quantiles`` as columns, one per name."""
    picked = [F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(n) for n, p in names.items()]
    return quantiles.groupBy(*([by] if by else [])).agg(*picked)


def quantile_row(df: DataFrame, value: str, names: dict[str, float]) -> DataFrame:
    """Named quantiles of one column, as one row."""
    return quantile_columns(exact_quantiles(df, value, list(names.values())), names)


def with_quantiles(df: DataFrame, value: str, names: dict[str, float]) -> DataFrame:
    """Attach named quantiles of a column to each row, through a scalar subquery."""
    one = quantile_row(df, value, names).select(F.struct(*names).alias("q")).scalar()
    return df.withColumn("_q", one).select("*", *[f"_q.{n}" for n in names]).drop("_q")
