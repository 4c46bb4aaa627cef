"""Quantiles, statistics and vendor analyses against hand results and array libraries."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from vendorlens.operators import stats, vendors
from vendorlens.operators.quantiles import exact_quantiles, keys_of, long_form, quantile_row, values_of, wide_quantiles

PROBS = [0.0, 0.15, 0.25, 1 / 3, 0.5, 0.85, 1.0]


def values_frame(spark, values, column="x"):
    return spark.createDataFrame([(column, float(v)) for v in values], "column string, value double")


def quantiles(df):
    return {r.p: r.quantile for r in exact_quantiles(df, "value", PROBS).collect()}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_bracketed_quantiles_match_arrays(spark, values):
    found = quantiles(values_frame(spark, values))
    assert found == pytest.approx({p: float(np.quantile(np.array(values, float), p)) for p in PROBS}, abs=1e-6)


@pytest.mark.parametrize("shape", ["skewed", "far", "infinite"])
def test_quantiles_of_long_columns_match_arrays(spark, shape):
    values = np.random.default_rng(5).random(120_000) ** 6 * 1e5
    values[::3] = 7.0  # a third of the rows are one value
    if shape == "far":
        values[:2] = -1e300, 1e300
    if shape == "infinite":
        values[1::50] = np.inf
    want = {p: float(np.quantile(values, p)) for p in PROBS}
    found = quantiles(values_frame(spark, values))
    assert {p: found[p] for p in PROBS if np.isfinite(want[p])} == pytest.approx({p: w for p, w in want.items() if np.isfinite(w)}, rel=1e-12)


def test_keys_sort_like_their_values():
    tiny = np.finfo(float).tiny
    values = np.array([-np.inf, -1e300, -2.5, -tiny, -5e-324, 0.0, 5e-324, tiny, 1.0, np.nextafter(1.0, 2), 1e300, np.inf])
    keys = keys_of(values)
    assert (np.diff(keys.astype(object)) > 0).all() and (values_of(keys) == values).all()
    assert keys_of(np.array([-0.0])) == keys_of(np.array([0.0]))


def test_no_value_is_shuffled(spark):
    """Every exchange of a quantile plan carries counts of digits or sizes, and there is no sort but of digits."""
    df = spark.range(5_000).select(*[(F.hash("id") * (i + 1) / 7).alias(f"c{i}") for i in range(3)])
    for plan in (wide_quantiles(df, df.columns, [0.5]), exact_quantiles(long_form(df, df.columns), "value", [0.5], by="column")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in text.splitlines() if "Exchange" in line and "Reused" not in line]
        assert exchanges and all("hashpartitioning(label" in x or "SinglePartition" in x or "hashpartitioning(i" in x for x in exchanges)
        assert "RangePartitioning" not in text and "percentile" not in text


def test_quantiles_of_columns_side_by_side(spark):
    random = np.random.default_rng(8)
    frame = pd.DataFrame({
        "a": random.random(5_000), "b": np.round(random.normal(size=5_000)), "c": 10.0 ** random.integers(-300, 300, 5_000), "d": [7.0] * 5_000})
    frame.loc[::9, "b"] = np.nan
    frame["e"] = [None if i else 2.0 for i in range(5_000)]
    df = spark.createDataFrame(frame).withColumn("none", F.lit(None).cast("double")).repartition(7)
    found = {(r.column, r.p): r.quantile for r in wide_quantiles(df, df.columns, PROBS).collect()}
    want = {(c, p): float(np.quantile(frame[c].dropna().astype(float), p)) for c in frame for p in PROBS}
    assert found == pytest.approx(want, rel=1e-12)


def test_building_a_quantile_plan_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan only", "")
    exact_quantiles(values_frame(spark, range(50)), "value", PROBS, by="column")
    assert len(tracker.getJobIdsForGroup("plan only")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_quantiles_by_group_ignore_missing(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0), ("c", math.nan), ("a", math.nan)], "column string, value double"
    )
    found = exact_quantiles(df, "value", [0.5], by="column").collect()
    assert sorted((r.column, r.quantile) for r in found) == [("a", 2.0), ("b", 5.0)]


def test_quantiles_of_nothing(spark):
    empty = values_frame(spark, [1.0]).where("value > 5")
    assert exact_quantiles(empty, "value", [0.5]).collect() == []
    assert quantile_row(empty, "value", {"q": 0.5}).first().q is None


@pytest.mark.parametrize("values", [
    [0.0, 1.0, 2.0, 3.0], [5.0, 5.0, 5.0], [0.1 * k for k in range(301)],
    list(np.random.default_rng(1).normal(size=500)), [-1e-9, 1e9],
])
def test_histogram_matches_arrays(spark, values):
    rows = stats.histogram(values_frame(spark, values)).orderBy("bin").collect()
    counts, edges = np.histogram(np.array(values), bins=30)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r.bin_start for r in rows] == pytest.approx(edges[:-1].tolist())
    assert rows[-1].bin_end == pytest.approx(edges[-1])


def test_density_matches_direct_sum(spark):
    values = np.round(np.random.default_rng(2).normal(10, 3, 400), 1)
    rows = stats.density(values_frame(spark, values)).orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    kernel = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (h * math.sqrt(2 * math.pi))
    expected = kernel * (values.max() - values.min()) / 30
    assert [r.density for r in rows] == pytest.approx(expected.tolist(), rel=1e-9)


def test_boxplot(spark):
    row = stats.boxplot(values_frame(spark, [1, 2, 3, 4, 5, 100])).first()
    assert (row.q25, row.q50, row.q75) == (2.25, 3.5, 4.75)
    assert (row.whisker_low, row.whisker_high, row.outliers) == (1.0, 5.0, 1)


def test_describe_and_modes(spark):
    frame = pd.DataFrame({"a": [1, 1, 2, 2, 3], "b": [0.5, None, 1.5, 2.5, 2.5], "t": ["y", "x", "x", "y", None]})
    df = spark.createDataFrame(frame.astype({"a": "int64"}).replace({np.nan: None}), "a bigint, b double, t string")
    found = {r.column: r for r in stats.describe(df).collect()}
    expected = frame[["a", "b"]].describe()
    for column in ("a", "b"):
        r, e = found[column], expected[column]
        assert [r["count"], r.mean, r["std"], r["min"], r.q25, r.q50, r.q75, r["max"]] == pytest.approx(e.tolist())
    best = {r.column: r.number if r.number is not None else r.text for r in stats.modes(df).collect()}
    assert best == {"a": 1.0, "b": 2.5, "t": "x"}


def test_correlation_by_pairs(spark):
    frame = pd.DataFrame({"a": [1.0, 2, 3, 4, None], "b": [2.0, 1, None, 7, 9], "c": [1.0] * 5, "d": [1e6, 1e6 + 1, 1e6 - 2, 1e6, 1e6]})
    df = spark.createDataFrame(frame.replace({np.nan: None}).astype(object).where(frame.notna(), None), "a double, b double, c double, d double")
    found = {(r.a, r.b): r.r for r in stats.correlation_matrix(df).collect()}
    expected = frame.corr()
    assert len(found) == 16
    for (a, b), r in found.items():
        e = expected.loc[a, b]
        assert r is None if math.isnan(e) else r == pytest.approx(e, abs=1e-9)


def test_confidence_interval_and_welch(spark):
    groups = spark.createDataFrame(
        [("top", v) for v in (10.0, 12.0, 11.0, 13.0)] + [("low", v) for v in (20.0, 25.0, 21.0)], "column string, value double"
    )
    ci = {r.column: r for r in stats.confidence_intervals(groups).collect()}
    s = math.sqrt(5 / 3)
    assert ci["top"].mean == 11.5
    assert ci["top"].upper - 11.5 == pytest.approx(3.182446305 * s / 2, abs=1e-7)
    row = stats.welch_test(groups).first()
    a, b = (5 / 3) / 4, 7.0 / 3
    assert row.t == pytest.approx((11.5 - 22) / math.sqrt(a + b))
    assert row.df == pytest.approx((a + b) ** 2 / (a**2 / 3 + b**2 / 2))
    assert 0.005 < row.p < 0.05 and row.reject


def test_tiny_groups_have_no_interval(spark):
    one = spark.createDataFrame([("top", 1.0)], "column string, value double")
    assert stats.confidence_intervals(one).first().lower is None
    assert stats.welch_test(one).first().p is None


def test_quartile_groups_overlap_on_ties(spark):
    df = spark.createDataFrame([(5.0, float(i)) for i in range(4)], "s double, m double")
    assert stats.quartile_groups(df, "s", "m").groupBy("column").count().orderBy("column").collect() == [("low", 4), ("top", 4)]


def mart_rows(spark, *rows):
    fields = "VendorName string, BrandName string, TotalSalesDollars double, TotalPurchaseDollars double, " \
             "GrossProfit double, ProfitMargin double, TotalPurchaseQuantity bigint, TotalSalesQuantity bigint, " \
             "StockTurnover double, PurchasePrice double"
    return spark.createDataFrame([(*r, *([1.0, 1.0, 1, 1, 0.5, 1.0][len(r) - 4:])) for r in rows], fields)


def test_top_sellers_break_ties_by_key(spark):
    rows = mart_rows(spark, *[(v, "p", 100.0, 50.0) for v in "dbca"], (None, "p", 900.0, 1.0))
    assert [r.VendorName for r in vendors.top_by_sales(rows, "VendorName", 3).collect()] == ["a", "b", "c"]


def test_shares_add_up_to_all(spark):
    rows = mart_rows(spark, *[(f"v{i:02}", "p", 10.0, 7.0 + i) for i in range(15)])
    dependence = vendors.vendor_dependence(rows).collect()
    assert len(dependence) == 11
    assert sum(r.PurchaseContribution for r in dependence) == pytest.approx(100.0)
    pareto = vendors.vendor_pareto(rows).orderBy(F.desc("TotalPurchaseDollars")).collect()
    running = np.cumsum([r.PurchaseContribution for r in pareto])
    assert [r.CumulativeContribution for r in pareto] == pytest.approx(running.tolist())


def test_order_sizes_match_array_cut(spark):
    quantities = [1, 1, 1, 2, 2, 3, 4, 5, 6, 6, 6, 9, 9, 20]
    rows = mart_rows(spark, *[("v", "p", 1.0, 10.0, 1.0, 1.0, q, 1, 0.5, 1.0) for q in quantities])
    sizes = vendors.order_sizes(rows).select("TotalPurchaseQuantity", "OrderSize").collect()
    cut = pd.qcut(pd.Series(quantities), 3, labels=list(vendors.SIZES))
    assert sorted(map(tuple, sizes)) == sorted(zip(quantities, cut))


def test_order_sizes_refuse_equal_edges(spark):
    rows = mart_rows(spark, *[("v", "p", 1.0, 10.0, 1.0, 1.0, 4, 1, 0.5, 1.0)] * 5)
    with pytest.raises(Exception, match="three distinct sizes"):
        vendors.order_sizes(rows).collect()


def test_scatter_marks_targets_apart(spark):
    rows = mart_rows(spark, *[("v", f"p{i}", 1000.0 * i, 1.0, 1.0, 100.0 - i) for i in range(1, 21)])
    points = vendors.brand_scatter_points(vendors.brand_performance(rows), sales_below=5000.0).collect()
    by = {s: sorted(r.BrandName for r in points if r.series == s) for s in ("All Brands", "Target Brands")}
    assert by["All Brands"] == ["p1", "p2", "p3", "p4"]
    assert by["Target Brands"] == ["p1", "p2", "p3"]
    assert points[0].low_sales == pytest.approx(3850.0)


def test_unsold_capital_may_be_negative(spark):
    rows = mart_rows(spark, ("a", "p", 1.0, 1.0, 1.0, 1.0, 2, 10, 5.0, 3.5), ("b", "p", 1.0, 1.0, 1.0, 1.0, 10, 2, 0.2, 300.0))
    found = [(r.VendorName, r.UnsoldInventoryValue, r.UnsoldCapital) for r in vendors.unsold_capital(rows).collect()]
    assert found == [("b", 2400.0, "2.40K"), ("a", -28.0, "-28.0")]
    assert vendors.total_unsold_capital(rows).first().UnsoldCapital == "2.37K"


def test_long_form_drops_missing(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (None, math.nan)], "a int, b double")
    assert sorted(map(tuple, long_form(df, ["a", "b"]).collect())) == [("a", 1.0), ("a", 2.0), ("b", 3.0)]


def test_means_of_unrounded_values(spark):
    values = np.random.default_rng(4).normal(30, 7, 500)
    groups = values_frame(spark, values, "top")
    row = stats.group_moments(groups).first()
    assert row.mean == pytest.approx(values.mean(), abs=1e-11)


def test_correlation_skips_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, math.nan), (4.0, 8.0)], "a double, b double")
    found = {(r.a, r.b): r.r for r in stats.correlation_matrix(df).collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.5, 8])[0, 1])
