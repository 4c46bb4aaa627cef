from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendorlens.functions.numbers import exact_mean, exact_sum, finite_or_zero, round_cents, safe_ratio
from vendorlens.functions.student import critical_value, two_sided_p
from vendorlens.functions.text import digit_residue, dollars, strip


def column(spark, values, expression, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def python_label(v: float) -> str:
    if v >= 1_000_000:
        return f"{v / 1_000_000:.2f}M"
    if v >= 1_000:
        return f"{v / 1_000:.2f}K"
    return str(v)


def test_dollars_reads_as_fixed_cases(spark):
    found = column(spark, [1500000.0, 1500.0, 999.5, -2000000.0, 5.0, 0.0], dollars)
    assert found == ["1.50M", "1.50K", "999.5", "-2000000.0", "5.0", "0.0"]


def test_dollars_rounds_as_binary_value(spark):
    rng = random.Random(3)
    values = [1125.0, 1135.0, 1145.0, 1005.0, 1_125_000.0, 2_675_000.0, 999_995.0, 999_994.99]
    values += [k * 5.0 for k in range(200, 3200)]  # every third decimal, ties included
    values += [round(rng.uniform(-5e6, 5e7), 2) for _ in range(2000)]
    assert column(spark, values, dollars) == [python_label(v) for v in values]


def test_round_cents_matches_arrays(spark):
    values = [0.125, 0.135, 1.005, 2.675, -0.125, -1.005] + [k / 1000 for k in range(-3000, 3000)]
    assert column(spark, values, round_cents) == np.round(np.array(values), 2).tolist()


def test_strip_removes_every_kind_of_blank(spark):
    found = column(spark, ["  A \t", "\nA b\r\n", "\u00a0x\u2003", "", None, "\x1cz\x1f"], strip, "string")
    assert found == ["A", "A b", "x", "", None, "z"]


def test_guards(spark):
    inf = float("inf")
    assert column(spark, [inf, -inf, math.nan, None, 2.5], finite_or_zero) == [0.0, 0.0, 0.0, 0.0, 2.5]
    assert column(spark, [0.0, 4.0], lambda x: safe_ratio(F.lit(2.0), x)) == [0.0, 0.5]
    assert column(spark, ["12a", "345"], digit_residue, "string") == ["a", ""]


def test_sums_ignore_order_and_nulls(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (2, None)], "k int, x double")
    rows = df.groupBy("k").agg(exact_sum(F.col("x")).alias("s"), exact_mean(F.col("x")).alias("m"))
    assert sorted(map(tuple, rows.collect())) == [(1, 0.3, 0.15), (2, 0.0, None)]


@pytest.mark.parametrize("df, t", [(10, 2.228138852), (30, 2.042272456), (1, 12.706204736), (1000, 1.962339081)])
def test_critical_value(df, t):
    assert critical_value(0.95, df) == pytest.approx(t, abs=1e-8)
    assert two_sided_p(t, df) == pytest.approx(0.05, abs=1e-9)


@pytest.mark.parametrize("df", [10.0**k for k in range(5, 15)] + [99_999.0, 100_001.0])
def test_many_degrees_of_freedom(df):
    z = 1.959963984540054
    exact = z + (z**3 + z) / (4 * df) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * df**2)  # known expansion of the quantile
    assert critical_value(0.95, df) == pytest.approx(exact, abs=1e-9)
    assert two_sided_p(exact, df) == pytest.approx(0.05, abs=1e-9)


def test_p_value_ends():
    assert two_sided_p(0.0, 5) == 1.0
    assert two_sided_p(80.0, 4000) == 0.0
