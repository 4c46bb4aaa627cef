"""Steps that outgrew their limits on larger tables."""

from __future__ import annotations

import numpy as np
import pytest

from vendorlens.operators import stats, summary
from vendorlens.operators.quantiles import long_form
from vendorlens.plans import incremental, queries
from vendorlens.sources import retail, versions
from vendorlens.sources.shared import exists
from vendorlens.sources.tables import create_database, list_tables, register_views

from .test_mart import invoice, listed, purchase, sale, table
from .test_versions import delivered, first_rows


def star(spark):
    """A few rows of the star schema, by table name."""
    tables = {
        "part": spark.range(1, 41).selectExpr("id AS p_partkey", "concat('name', id) AS p_name", "'ECONOMY' AS p_type", "int(id) AS p_size", "id * 10.5D AS p_retailprice"),
        "supplier": spark.range(1, 4).selectExpr("id AS s_suppkey", "concat('Vendor', id) AS s_name"),
        "region": spark.range(2).selectExpr("int(id) AS r_regionkey", "concat('R', id) AS r_name"),
        "orders": spark.range(50).selectExpr("id AS o_orderkey", "timestamp_ntz'2024-01-01' AS o_orderdate"),
        "lineitem": spark.range(200).selectExpr(
            "id % 50 AS l_orderkey", "id % 40 + 1 AS l_partkey", "id % 3 + 1 AS l_suppkey", "int(id % 7) AS l_linenumber", "double(id % 50) AS l_quantity",
            "100.0D AS l_extendedprice", "0.1D AS l_discount", "0.1D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", "timestamp_ntz'2024-02-01' AS l_shipdate")}
    return tables.get


@pytest.fixture
def no_broadcast(spark):
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for c, v in kept.items():
        spark.conf.set(c, v)


def test_lines_meet_their_orders_before_texts_are_attached(spark, no_broadcast):
    read = star(spark)
    rows = retail.purchases(read)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(l_orderkey" in line)
    assert "concat_ws" not in "".join(lines[at:]) and "concat_ws" in "".join(lines[:at])
    assert rows.count() == 200 and rows.where("PODate = DATE'2024-01-01' AND ReceivingDate = DATE'2024-02-01'").count() == 200


def test_freight_is_not_repeated(spark, no_broadcast):
    rows = summary.vendor_sales_summary(*[table(spark, n, *r) for n, r in (
        ("purchases", [purchase(brand=1), purchase(brand=2)]), ("purchase_prices", [listed(brand=1), listed(brand=2)]),
        ("sales", [sale(brand=1)]), ("vendor_invoice", [invoice(1)]))])
    assert "Generate" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 2


def test_products_of_one_file_are_dealt_out(spark):
    rows = retail.begin_inventory(star(spark))
    assert "REBALANCE" in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 80 and rows.distinct().count() == 80


def test_inferred_csv_writes_parts_as_they_are(spark, monkeypatch, tmp_path):
    written = []
    monkeypatch.setattr(queries, "write_csv", lambda df, path: written.append(df) or df.write.option("header", "true").csv(path))
    purchases = table(spark, "purchases", *[purchase(brand=b) for b in range(8)]).repartition(6)
    space = type("Space", (dict,), {"spark": spark})(purchases=purchases)
    assert queries._inferred(space).first()["row_count"] == 8
    assert written[0].rdd.getNumPartitions() == 6


def test_curves_of_columns_side_by_side(spark, monkeypatch):
    random = np.random.default_rng(3)
    rows = [(float(random.normal()), int(i % 5), 3.0, None if i % 3 else float(i), float("nan") if i % 2 else 1.0 * i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "a double, b int, flat double, gaps double, nan double").repartition(3)
    monkeypatch.setattr(stats, "HELD", 64)  # values are added up many times
    found = {(r.column, r.point): (r.x, r.density) for r in stats.density_columns(df).collect()}
    want = {(r.column, r.point): (r.x, r.density) for r in stats.density(long_form(df, df.columns)).collect()}
    assert found.keys() == want.keys() and {c for c, _ in found} == {"a", "b", "gaps", "nan"}
    for key, (x, y) in want.items():
        assert found[key] == (pytest.approx(x), pytest.approx(y))
    value = np.array([r[0] for r in rows])
    width = value.std(ddof=1) * len(value) ** -0.2
    grid = np.linspace(value.min(), value.max(), stats.GRID)
    plain = np.exp(-0.5 * ((grid[:, None] - value) / width) ** 2).sum(1) / (width * np.sqrt(2 * np.pi)) * (grid[-1] - grid[0]) / stats.BINS
    assert [found["a", p][1] for p in range(stats.GRID)] == pytest.approx(list(plain))


def test_added_rows_drop_what_old_versions_wrote(spark, tmp_path):
    place = str(tmp_path / "db")
    first = incremental.add_rows(spark, place, delivered(spark, **first_rows()))
    second = incremental.add_rows(spark, place, delivered(spark, purchases=[purchase(brand=2, quantity=7)]))
    third = incremental.add_rows(spark, place, delivered(spark, purchases=[purchase(brand=3, quantity=9)]))
    mart = incremental.MART_TABLE
    assert not exists(spark, first.tables[mart][0])
    assert exists(spark, second.tables[mart][0]) and exists(spark, third.tables[mart][0])
    assert all(exists(spark, f) for folders in third.tables.values() for f in folders)
    assert versions.current(spark, place) == third and incremental.mart_of_version(spark, third).count() == 6


def test_views_are_no_tables(spark, tmp_path):
    create_database(spark, "no_views", str(tmp_path / "no_views"))
    register_views({"a_view": spark.range(1)})
    spark.range(1).write.saveAsTable("no_views.a_table")
    assert list_tables(spark, "no_views") == ["a_table"]
    spark.catalog.dropTempView("a_view")
    spark.sql("DROP DATABASE no_views CASCADE")
