"""Summary, clean and feature steps on hand-made rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vendorlens.operators import clean, dedupe, features, summary
from vendorlens.sources.schemas import RAW_SCHEMAS, SUMMARY_SCHEMA, column_types

DAY = date(2024, 1, 1)


def table(spark, name, *rows):
    """Rows given as the columns that matter; the others are NULL."""
    kinds = column_types(RAW_SCHEMAS[name])
    full = [tuple(row.get(c) for c in kinds) for row in rows]
    return spark.createDataFrame(full, RAW_SCHEMAS[name])


def purchase(vendor=1, brand=1, price="2.00", quantity=10, dollars="20.00", name="A"):
    return dict(VendorNumber=vendor, VendorName=name, Brand=brand, Description=f"p{brand}", PODate=DAY,
                PurchasePrice=Decimal(price), Quantity=quantity, Dollars=Decimal(dollars))


def listed(brand=1, price="3.00", volume="750"):
    return dict(Brand=brand, Price=Decimal(price), Volume=volume)


def sale(vendor=1, brand=1, quantity=5, dollars="25.00"):
    return dict(VendorNo=vendor, Brand=brand, SalesQuantity=quantity, SalesDollars=Decimal(dollars),
                SalesPrice=Decimal(dollars), ExciseTax=Decimal("1.00"))


def invoice(vendor=1, freight="0.50"):
    return dict(VendorNumber=vendor, Freight=Decimal(freight))


def mart(spark, purchases, prices, sales=(), invoices=()):
    found = summary.vendor_sales_summary(
        table(spark, "purchases", *purchases), table(spark, "purchase_prices", *prices),
        table(spark, "sales", *sales), table(spark, "vendor_invoice", *invoices),
    )
    cleaned = clean.clean_summary(found)
    return [r.asDict() for r in features.vendor_features(cleaned).orderBy("Brand", "PurchasePrice", "ActualPrice").collect()]


def test_unsold_product_is_a_loss_without_ratios(spark):
    (row,) = mart(spark, [purchase()], [listed()])
    assert row["TotalSalesQuantity"] == 0 and row["TotalSalesDollars"] == 0.0
    assert (row["GrossProfit"], row["ProfitMargin"], row["StockTurnover"]) == (-20.0, 0.0, 0.0)
    assert row["FreightCost"] == 0.0  # vendor without invoice


def test_sold_product(spark):
    (row,) = mart(spark, [purchase(), purchase()], [listed()], [sale()], [invoice(), invoice(freight="1.25")])
    assert (row["TotalPurchaseQuantity"], row["TotalPurchaseDollars"]) == (20, 40.0)
    assert (row["GrossProfit"], row["ProfitMargin"]) == (-15.0, -60.0)
    assert (row["StockTurnover"], row["SalestoPurchaseRatio"], row["FreightCost"]) == (0.25, 0.62, 1.75)


def test_each_list_price_carries_the_full_totals(spark):
    rows = mart(spark, [purchase()], [listed(price="3.00"), listed(price="4.00")])
    assert [(r["ActualPrice"], r["TotalPurchaseQuantity"]) for r in rows] == [(3.0, 10), (4.0, 10)]


def test_equal_price_rows_multiply_the_totals(spark):
    (row,) = mart(spark, [purchase()], [listed(), listed()])
    assert (row["TotalPurchaseQuantity"], row["TotalPurchaseDollars"]) == (20, 40.0)


def test_early_grouping_equals_grouping_after_the_join(spark):
    purchases = table(spark, "purchases", purchase(), purchase(quantity=None), purchase(price="2.50"),
                      purchase(vendor=2, name=None), purchase(brand=2), purchase(brand=None))
    prices = table(spark, "purchase_prices", listed(), listed(), listed(price="5.00", volume=None), listed(brand=2))
    late = summary.purchase_price_join(purchases, prices).groupBy(
        "VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice", "ActualPrice", "Volume"
    ).agg(F.sum("Quantity").alias("q"), F.sum("Dollars").cast("double").alias("d"))
    early = summary.purchase_summary(purchases, prices)
    assert sorted(map(str, early.collect())) == sorted(map(str, late.select(
        "VendorNumber", "VendorName", "Brand", "Description", F.col("PurchasePrice").cast("double").alias("PurchasePrice"),
        F.col("ActualPrice").cast("double").alias("ActualPrice"), "Volume",
        F.col("q").alias("TotalPurchaseQuantity"), F.col("d").alias("TotalPurchaseDollars"),
    ).collect()))


def test_sales_repeat_on_each_purchase_price(spark):
    rows = mart(spark, [purchase(price="2.00"), purchase(price="2.50")], [listed()], [sale()])
    assert [r["TotalSalesDollars"] for r in rows] == [25.0, 25.0]


def test_sales_without_purchase_and_free_purchases_are_left_out(spark):
    assert mart(spark, [purchase(price="0.00")], [listed()], [sale()]) == []
    assert [r["Brand"] for r in mart(spark, [purchase()], [listed()], [sale(), sale(brand=9)])] == [1]


def test_zero_divisors_give_zero(spark):
    (row,) = mart(spark, [purchase(quantity=0, dollars="0.00")], [listed()], [sale(quantity=0, dollars="0.00")])
    assert (row["ProfitMargin"], row["StockTurnover"], row["SalestoPurchaseRatio"]) == (0.0, 0.0, 0.0)


def summary_row(spark, **values):
    kinds = column_types(SUMMARY_SCHEMA)
    return spark.createDataFrame([tuple(values.get(c) for c in kinds)], SUMMARY_SCHEMA)


def test_clean_numbers_and_names(spark):
    dirty = summary_row(spark, VendorName="  A \t", BrandName=None, Volume=" 750 ", FreightCost=float("inf"),
                        PurchasePrice=float("nan"))
    row = clean.clean_summary(dirty).first()
    assert (row.VendorName, row.BrandName, row.Volume, row.FreightCost, row.PurchasePrice) == ("A", None, 750.0, 0.0, 0.0)
    assert row.TotalSalesQuantity == 0


def test_bad_volume(spark):
    bad = summary_row(spark, Volume="abc")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.clean_summary(bad).collect()
    assert clean.clean_summary(bad, strict=False).first().Volume == 0.0
    assert clean.rejected_volumes(bad).first().rejected == 1


def test_notebook_variant_leaves_unsold_products_at_zero(spark):
    unsold = summary_row(spark, Volume="1", TotalPurchaseQuantity=4, TotalPurchaseDollars=8.0)
    row = features.notebook_features(unsold).first()
    assert (row.GrossProfit, row.ProfitMargin, row.StockTurnover, row.SalestoPurchaseRatio) == (0.0, 0.0, 0.0, 0.0)


def test_group_totals_skip_missing_keys(spark):
    rows = table(spark, "purchases", purchase(), purchase(quantity=None, brand=2), purchase(brand=None))
    found = {r.Brand: r.Quantity for r in summary.purchases_by_brand_price(rows).collect()}
    assert found == {1: 10, 2: 0}


def test_duplicates_with_missing_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "k int, t string")
    assert dedupe.drop_duplicate_rows(df).count() == 2
    surplus = dedupe.duplicate_rows(df, copies_per_task=1)
    assert sorted((r.k, r.t, r.rank_) for r in surplus.collect()) == [(1, None, 2), (1, None, 3)]
    assert dedupe.remaining_duplicates(df).first()[0] == 2
    assert dedupe.remaining_duplicates(dedupe.drop_duplicate_rows(df)).first()[0] == 0


def test_a_hot_row_is_written_out_in_full(spark):
    hot = spark.range(10_000).select(F.lit(1).alias("k")).union(spark.range(20).select(F.col("id").cast("int") + 10))
    found = dedupe.duplicate_rows(hot, copies_per_task=700).agg(
        F.count("*"), F.countDistinct("rank_"), F.min("rank_"), F.max("rank_")
    ).first()
    assert tuple(found) == (9_999, 9_999, 2, 10_000)


def test_keep_first_by_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "e")], "k int, o int, t string")
    first = dedupe.keep_first(df, ["k"], ["o"])
    assert sorted(map(tuple, first.collect())) == [(1, 1, "a"), (2, 5, "e")]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_mart_key_check_reports_repeated_sales(spark):
    found = summary.vendor_sales_summary(
        table(spark, "purchases", purchase(price="2.00"), purchase(price="2.50"), purchase(brand=2)),
        table(spark, "purchase_prices", listed(), listed(brand=2)),
        table(spark, "sales", sale()), table(spark, "vendor_invoice", invoice()),
    )
    violations = dedupe.key_violations(found, ["VendorNumber", "Brand"]).collect()
    assert [tuple(r) for r in violations] == [(1, 1, 2)]


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "v int, b int")
    assert [tuple(r) for r in dedupe.key_violations(df, ["v", "b"]).collect()] == [(1, 1, 2)]


def test_one_vendor_with_most_rows_keeps_its_freight(spark):
    purchases = [purchase(vendor=1, brand=b) for b in range(60)] + [purchase(vendor=2, brand=99)]
    rows = mart(spark, purchases, [listed(brand=b) for b in [*range(60), 99]], invoices=[invoice(1), invoice(1)])
    assert [r["FreightCost"] for r in rows] == [1.0] * 60 + [0.0]
