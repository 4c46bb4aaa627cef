"""Descriptive statistics, distributions, correlation and tests."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import exact_mean
from ..functions.student import t_critical, t_two_sided_p
from ..sources.shared import ship
from .clean import numeric_columns
from .modes import modes
from .quantiles import exact_quantiles, long_form, quantile_columns, wide_quantiles, with_quantiles

BINS = 30
GRID = 200
#: Values of a column that a task counts before it adds them to its curve.
HELD = 1 << 19
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per numeric column."""
    columns = list(columns or numeric_columns(df))
    values = long_form(df, columns)
    moments = values.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = wide_quantiles(df, columns, list(QUARTILES.values()))
    return moments.join(quantile_columns(quartiles, QUARTILES, by="column"), "column").select(
        "column", "count", "mean", "std", "min", *QUARTILES, "max"
    )


def _merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows as those of both: n, both means, both sums of squares and that of products about the means."""
    n = one[0] + other[0]
    safe = np.where(n > 0, n, 1.0)
    x, y = other[1] - one[1], other[2] - one[2]
    weight, share = one[0] * other[0] / safe, other[0] / safe
    return np.stack([
        n, one[1] + x * share, one[2] + y * share,
        one[3] + other[3] + x * x * weight, one[4] + other[4] + y * y * weight, one[5] + other[5] + x * y * weight])


def _pair_moments(names: list[str]):
    """A task's moments of every pair of columns, one row per pair; rows missing either value are left out of a pair."""
    a, b = np.triu_indices(len(names))

    def moments(x: np.ndarray) -> np.ndarray:
        there = ~np.isnan(x)
        count = np.maximum(there.sum(0), 1)
        middle = np.where(there, x, 0.0).sum(0) / count  # any number near the values will do
        x, there = np.where(there, x - middle, 0.0), there.astype("float64")
        n, sums, square = there.T @ there, x.T @ there, x * x
        safe = np.maximum(n, 1.0)
        left = sums / safe  # mean of a, about its middle, over the rows that have b
        parts = [n, left + middle[:, None], left.T + middle[None, :],
                 square.T @ there - left * sums, there.T @ square - left.T * sums.T, x.T @ x - left * sums.T]
        return np.stack(parts)[:, a, b]

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            found = moments(batch.to_numpy(dtype="float64"))
            total = found if total is None else _merged(total, found)
        if total is not None:
            yield pd.DataFrame({"i": a, "j": b, **dict(zip(("n", "x", "y", "xx", "yy", "xy"), total))})

    return add_up


def _all_merged(rows: pd.DataFrame) -> pd.DataFrame:
    """The moments of a pair over all tasks, two by two; a row for each task."""
    parts = rows[["n", "x", "y", "xx", "yy", "xy"]].to_numpy().T
    while parts.shape[1] > 1:
        half = parts.shape[1] // 2
        rest = parts[:, 2 * half :]
        parts = np.concatenate([_merged(parts[:, :half], parts[:, half : 2 * half]), rest], axis=1)
    return pd.DataFrame({"i": rows["i"].iloc[:1], "j": rows["j"].iloc[:1], **dict(zip(("n", "x", "y", "xx", "yy", "xy"), parts))})


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson r of every pair of numeric columns, as rows (a, b, r).

    Rows missing either value are left out of that pair. A column without spread has
    no correlation: NULL, also with itself. One scan: a task keeps means, and sums of squares and products about them, of
    its rows; these are merged two by two, so a spread far below the mean is not lost. A task sends one
    row per pair.
    """
    ship(df.sparkSession)
    names = list(columns or numeric_columns(df))
    shape = "i int, j int, n double, x double, y double, xx double, yy double, xy double"
    sums = df.select([F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(names)]).mapInPandas(
        _pair_moments(names), shape).groupBy("i", "j").applyInPandas(_all_merged, shape)

    def spread(square: str, mean: str) -> Column:
        """Sum of squares about the mean; nothing but rounding noise counts as none."""
        noise = F.col("n") * F.col(mean) * F.col(mean) * 1e-28
        return F.when(F.col(square) > noise, F.col(square))

    r = F.when(F.col("i") == F.col("j"), F.when(spread("xx", "x").isNotNull(), 1.0)).otherwise(
        F.try_divide(F.col("xy"), F.sqrt(spread("xx", "x")) * F.sqrt(spread("yy", "y"))))
    label = F.array(*[F.lit(c) for c in names])
    both = F.array_distinct(F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b"))))
    return sums.select(F.explode(both).alias("pair"), r.alias("r")).select(
        F.get(label, F.col("pair.a")).alias("a"), F.get(label, F.col("pair.b")).alias("b"), "r")


def _edges(values: DataFrame, bins: int) -> DataFrame:
    """Range, row count and spread per column; a column without range gets a range of 1."""
    low, high = F.min("value"), F.max("value")
    flat = low == high
    return values.groupBy("column").agg(
        F.when(flat, low - 0.5).otherwise(low).alias("low"),
        F.when(flat, high + 0.5).otherwise(high).alias("high"),
        F.count("value").alias("n"), F.stddev_samp("value").alias("std"),
    ).withColumn("step", (F.col("high") - F.col("low")) / bins)


def _with_facts(values: DataFrame, facts: DataFrame, *names: str) -> DataFrame:
    """Attach a row of facts to each value by its column: few by the meaning of ``column``, so no value is shuffled for it."""
    found = facts.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct(*names))))).scalar()
    placed = values.withColumn("_facts", found).withColumn("_fact", F.try_element_at("_facts", F.col("column")))
    return placed.where("_fact IS NOT NULL").select("column", "value", "_fact.*")


def _edge(i: Column, bins: int) -> Column:
    return F.when(i == bins, F.col("high")).otherwise(i * F.col("step") + F.col("low"))


def _bin_of(bins: int) -> Column:
    """The bin whose edges hold the value: first guess by division, then set by the edges."""
    guess = F.least(F.floor((F.col("value") - F.col("low")) / F.col("step")), F.lit(bins - 1))
    below = F.col("value") < _edge(guess, bins)
    above = (guess < bins - 1) & (F.col("value") >= _edge(guess + 1, bins))
    return F.when(below, guess - 1).when(above, guess + 1).otherwise(guess)


def histogram(values: DataFrame, bins: int = BINS) -> DataFrame:
    """Equal-width bins of (column, value) rows, the last one closed; empty bins count 0.

    ``column`` has a small fixed set of values: measure names or group labels.
    """
    edges = _edges(values, bins)
    counts = (
        _with_facts(values, edges, "low", "high", "step")
        .groupBy("column", _bin_of(bins).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    )
    frame = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(counts, ["column", "bin"], "left").select(
        "column", "bin", _edge(F.col("bin"), bins).alias("bin_start"),
        _edge(F.col("bin") + 1, bins).alias("bin_end"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("count"),
    )


class _Curve:
    """A task's share of a column's curve: a weight for each grid point. Equal values are counted first and added up once."""

    def __init__(self, low: float, high: float, width: float, grid: int):
        self.x, self.width = low + np.arange(grid) * ((high - low) / (grid - 1)), width
        self.x[-1] = high
        self.weights, self.waiting, self.held = np.zeros(grid), [], 0
        self.at, self.copies = np.zeros(0), np.zeros(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.held += len(values)
        if self.held > HELD:
            self._count()
            if len(self.at) > HELD // 2:
                self._spend()

    def _count(self) -> None:
        """Put the waiting values to those that are counted."""
        at, place = np.unique(np.concatenate([self.at, *self.waiting]), return_inverse=True)
        old = len(self.at)
        copies = np.bincount(place[old:], minlength=len(at))
        copies[place[:old]] += self.copies
        self.at, self.copies, self.waiting, self.held = at, copies, [], 0

    def _spend(self) -> None:
        for start in range(0, len(self.at), 1024):
            u = (self.x[:, None] - self.at[None, start : start + 1024]) / self.width
            np.multiply(u, u, out=u)
            u *= -0.5
            self.weights += np.exp(u, out=u) @ self.copies[start : start + 1024]
        self.at, self.copies = np.zeros(0), np.zeros(0, np.int64)

    def done(self) -> np.ndarray:
        self._count()
        self._spend()
        return self.weights


def _curve_rows(curves: dict[str, _Curve], grid: int) -> Iterator[pd.DataFrame]:
    for column, curve in curves.items():
        yield pd.DataFrame({"column": column, "point": np.arange(grid, dtype="int32"), "weight": curve.done()})


def _kernel_sums(grid: int):
    """A task's share of the curves: per column a weight for each grid point."""

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        curves: dict[str, _Curve] = {}
        for batch in batches:
            for (column, low, high, width), rows in batch.groupby(["column", "low", "high", "bandwidth"]):
                if column not in curves:
                    curves[column] = _Curve(low, high, width, grid)
                curves[column].add(rows["value"].to_numpy())
        yield from _curve_rows(curves, grid)

    return add_up


def _wide_kernel_sums(names: list[str], grid: int):
    """The same over columns side by side; the facts, as text, are in the first row of a task."""

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        curves: dict[str, _Curve] | None = None
        for batch in batches:
            if not len(batch):
                continue
            if curves is None:
                facts = {f["column"]: f for f in json.loads(batch.iloc[0, 0] or "[]")}
                curves = {c: _Curve(float(f["low"]), float(f["high"]), float(f["bandwidth"]), grid) for c, f in facts.items()}
            for i, name in enumerate(names):
                if name in curves:
                    values = batch.iloc[:, i + 1].to_numpy(dtype="float64")
                    curves[name].add(values[~np.isnan(values)])
        yield from _curve_rows(curves or {}, grid)

    return add_up


def _curve_facts(values: DataFrame, bins: int) -> DataFrame:
    """Range, bin width and Scott bandwidth of each column with a spread."""
    return _edges(values, bins).where("std > 0").select(
        "column", "low", "high", "step",
        (F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bandwidth"),
    )


def density(values: DataFrame, grid: int = GRID, bins: int = BINS) -> DataFrame:
    """Gaussian density curve over the range of each column, on the histogram's count scale.

    Scott bandwidth; exact, not binned. Values are not shuffled: a task adds its values to all
    grid points, and one row per column and grid point leaves it.
    """
    edges = _curve_facts(values, bins)
    ship(values.sparkSession)
    sums = (
        _with_facts(values, edges, "low", "high", "bandwidth")
        .mapInPandas(_kernel_sums(grid), "column string, point int, weight double")
    )
    return _scaled(sums, edges, grid)


def density_columns(df: DataFrame, columns: Sequence[str] | None = None, grid: int = GRID, bins: int = BINS) -> DataFrame:
    """`density` of numeric columns side by side, without a row for each number on the way to the tasks."""
    names = list(columns or numeric_columns(df))
    edges = _curve_facts(long_form(df, names), bins)
    ship(df.sparkSession)
    # as texts, since JSON has no infinite numbers
    facts = edges.agg(F.to_json(F.collect_list(F.struct("column", *[F.col(c).cast("string").alias(c) for c in ("low", "high", "bandwidth")])))).scalar()
    first_row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    rows = df.select(F.when(first_row, facts).alias("_facts"), *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    return _scaled(rows.mapInPandas(_wide_kernel_sums(names, grid), "column string, point int, weight double"), edges, grid)


def _scaled(parts: DataFrame, edges: DataFrame, grid: int) -> DataFrame:
    """Curves from the tasks' shares."""
    sums = parts.groupBy("column", "point").agg(F.sum("weight").alias("weight"))
    spacing = (F.col("high") - F.col("low")) / (grid - 1)
    at = F.when(F.col("point") == grid - 1, F.col("high")).otherwise(F.col("point") * spacing + F.col("low"))
    area = F.col("bandwidth") * (2.0 * 3.141592653589793) ** 0.5
    return sums.join(edges, "column").select(
        "column", "point", at.alias("x"), (F.col("weight") / area * F.col("step")).alias("density"))


def boxplot(values: DataFrame) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and the rows beyond them, of (column, value) rows."""
    return _boxplot(values, exact_quantiles(values, "value", list(QUARTILES.values()), by="column"))


def boxplot_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """`boxplot` of numeric columns side by side."""
    columns = list(columns or numeric_columns(df))
    return _boxplot(long_form(df, columns), wide_quantiles(df, columns, list(QUARTILES.values())))


def _boxplot(values: DataFrame, quantiles: DataFrame) -> DataFrame:
    quartiles = quantile_columns(quantiles, QUARTILES, by="column")
    reach = (F.col("q75") - F.col("q25")) * 1.5
    low, high = F.col("q25") - reach, F.col("q75") + reach
    x = F.col("value")
    return (
        _with_facts(values, quartiles, *QUARTILES)
        .groupBy("column", *QUARTILES)
        .agg(
            F.min(F.when(x >= low, x)).alias("lowest"), F.max(F.when(x <= high, x)).alias("highest"),
            F.count_if((x < low) | (x > high)).alias("outliers"),
        )
        .select(
            "column", *QUARTILES,
            F.least("lowest", "q25").alias("whisker_low"),
            F.greatest("highest", "q75").alias("whisker_high"), "outliers",
        )
    )


def quartile_groups(df: DataFrame, rank_by: str, value: str) -> DataFrame:
    """(column, value) rows of the top and bottom quarter by ``rank_by``, labelled top and low.

    A row belongs to both groups when the two quartiles are equal.
    """
    labels = F.array_compact(F.array(
        F.when(F.col(rank_by) >= F.col("q75"), "top"), F.when(F.col(rank_by) <= F.col("q25"), "low"),
    ))
    quartiles = {"q25": 0.25, "q75": 0.75}
    return with_quantiles(df.select(rank_by, value), rank_by, quartiles).select(
        F.explode(labels).alias("column"), F.col(value).alias("value")
    ).dropna(subset=["value"])


def group_moments(groups: DataFrame) -> DataFrame:
    """Size, mean and sample deviation of the values of each group."""
    return groups.groupBy("column").agg(
        F.count("value").alias("n"), exact_mean(F.col("value")).alias("mean"),
        F.stddev_samp("value").alias("std"),
    )


def confidence_intervals(groups: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Mean and two-sided t interval per group."""
    reach = t_critical(F.lit(confidence), (F.col("n") - 1).cast("double")) * F.col("std") / F.sqrt("n")
    return group_moments(groups).withColumn("_reach", reach).select(
        "column", "n", "mean",
        (F.col("mean") - F.col("_reach")).alias("lower"), (F.col("mean") + F.col("_reach")).alias("upper"),
    )


def welch_statistic(groups: DataFrame) -> DataFrame:
    """Welch's t of top against low and its degrees of freedom, as one row."""
    x = F.col("value")

    def parts(label: str) -> list[Column]:
        mine = F.when(F.col("column") == label, x)
        return [
            exact_mean(mine).alias(f"mean_{label}"),
            F.var_samp(mine).alias(f"var_{label}"), F.count(mine).alias(f"n_{label}"),
        ]

    a, b = (F.try_divide(F.col(f"var_{g}"), F.col(f"n_{g}")) for g in ("top", "low"))
    t = F.try_divide(F.col("mean_top") - F.col("mean_low"), F.sqrt(a + b))
    freedom = F.try_divide(
        (a + b) * (a + b),
        F.try_divide(a * a, F.col("n_top") - 1) + F.try_divide(b * b, F.col("n_low") - 1),
    )
    return groups.agg(*parts("top"), *parts("low")).select(t.alias("t"), freedom.alias("df"))


def welch_test(groups: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Welch's t, its two-sided p and whether equal means are rejected."""
    p = t_two_sided_p(F.col("t"), F.col("df"))
    return welch_statistic(groups).withColumn("p", p).withColumn("reject", F.col("p") < alpha)
