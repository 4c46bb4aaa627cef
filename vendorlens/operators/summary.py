"""Freight, purchase and sales totals, and the vendor x product summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .skew import spread_join

PURCHASE_KEYS = ["VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice"]


def _total(name: str) -> Column:
    """SQL sum: NULL when a group has no value."""
    return F.sum(name)


def freight_summary(vendor_invoice: DataFrame) -> DataFrame:
    """Freight per vendor."""
    return _as_doubles(freight_totals(vendor_invoice), "FreightCost")


def freight_totals(vendor_invoice: DataFrame) -> DataFrame:
    """Freight per vendor, as a decimal."""
    return vendor_invoice.groupBy("VendorNumber").agg(_total("Freight").alias("FreightCost"))


def purchase_price_join(purchases: DataFrame, prices: DataFrame) -> DataFrame:
    """Priced purchases with every list price of their Brand.

    The join is on Brand alone: a Brand with several price rows repeats its purchases. Brands with many
    purchases are spread by measure.
    """
    listed = prices.select("Brand", F.col("Price").alias("ActualPrice"), "Volume")
    return spread_join(purchases.where("PurchasePrice > 0"), listed, "Brand")


def purchase_summary(purchases: DataFrame, prices: DataFrame) -> DataFrame:
    """Quantity and dollars per vendor, product, purchase price and list price.

    Same totals as grouping ``purchase_price_join`` by all seven keys, but both sides
    are grouped before they meet: a popular Brand joins as a few totals, not as all
    of its purchase rows. Equal price rows are counted, and the count multiplies.
    """
    return priced_totals(bought_totals(purchases), listed_prices(prices))


def bought_totals(purchases: DataFrame) -> DataFrame:
    """Quantity and dollars per vendor, product and purchase price."""
    return purchases.where("PurchasePrice > 0").groupBy(*PURCHASE_KEYS).agg(
        _total("Quantity").alias("Quantity"), _total("Dollars").alias("Dollars"))


def listed_prices(prices: DataFrame) -> DataFrame:
    """List prices of a product, with the number of rows that say so."""
    return prices.groupBy("Brand", F.col("Price").alias("ActualPrice"), "Volume").agg(F.count(F.lit(1)).alias("copies"))


def priced_totals(bought: DataFrame, listed: DataFrame) -> DataFrame:
    """Purchase totals with every list price of their product."""
    dollars = F.col("Dollars").cast("decimal(27,2)") * F.col("copies").cast("decimal(10,0)")
    return bought.join(listed, "Brand").select(
        "VendorNumber", "VendorName", "Brand", "Description",
        F.col("PurchasePrice").cast("double").alias("PurchasePrice"),
        F.col("ActualPrice").cast("double").alias("ActualPrice"),
        "Volume",
        (F.col("Quantity") * F.col("copies")).alias("TotalPurchaseQuantity"),
        dollars.cast("double").alias("TotalPurchaseDollars"),
    )


def sold_totals(sales: DataFrame) -> DataFrame:
    """Sales totals per vendor and product, as decimals."""
    return sales.groupBy("VendorNo", "Brand").agg(
        _total("SalesQuantity").alias("TotalSalesQuantity"), _total("SalesDollars").alias("TotalSalesDollars"),
        _total("SalesPrice").alias("TotalSalesPrice"), _total("ExciseTax").alias("TotalExciseTax"),
    )


def _as_doubles(totals: DataFrame, *columns: str) -> DataFrame:
    return totals.withColumns({c: F.col(c).cast("double") for c in columns})


def sales_summary(sales: DataFrame) -> DataFrame:
    """Sales totals per vendor and product."""
    return _as_doubles(sold_totals(sales), "TotalSalesDollars", "TotalSalesPrice", "TotalExciseTax")


def _with_freight(rows: DataFrame, freight: DataFrame) -> DataFrame:
    """Attach the vendor's freight, NULL where there is none.

    One vendor may hold a large part of ``rows``. Freight has one row per vendor, not repeated, and is there before ``rows``
    are: adaptive execution sends it to the rows where it measures small, and else splits the vendors that are too large.
    """
    return rows.join(freight, "VendorNumber", "left")


def vendor_sales_summary(
    purchases: DataFrame, prices: DataFrame, sales: DataFrame, vendor_invoice: DataFrame
) -> DataFrame:
    """Purchase totals with the sales of the same vendor and product and the vendor's freight.

    Sales totals repeat when a product was bought at several prices, and freight
    repeats on each product of a vendor: never add up ``FreightCost`` over this table.
    Unsorted, as it is written to a table; sort with ``by_purchase_dollars``.
    """
    return summary_of_totals(
        bought_totals(purchases), listed_prices(prices), sold_totals(sales), freight_totals(vendor_invoice))


def summary_of_totals(bought: DataFrame, listed: DataFrame, sold: DataFrame, freight: DataFrame) -> DataFrame:
    """`vendor_sales_summary` from the grouped totals of its four tables."""
    sold = _as_doubles(sold, "TotalSalesDollars", "TotalSalesPrice", "TotalExciseTax").withColumnsRenamed(
        {"VendorNo": "_vendor", "Brand": "_brand"})
    same = (F.col("VendorNumber") == F.col("_vendor")) & (F.col("Brand") == F.col("_brand"))
    rows = priced_totals(bought, listed).join(sold, same, "left")
    return _with_freight(rows, _as_doubles(freight, "FreightCost")).select(
        "VendorNumber", "VendorName", "Brand", F.col("Description").alias("BrandName"),
        "PurchasePrice", "ActualPrice", "Volume",
        "TotalPurchaseQuantity", "TotalPurchaseDollars", "TotalSalesQuantity",
        "TotalSalesDollars", "TotalSalesPrice", "TotalExciseTax", "FreightCost",
    )


def by_purchase_dollars(summary: DataFrame) -> DataFrame:
    """Largest purchases first."""
    return summary.orderBy(
        F.desc("TotalPurchaseDollars"), "VendorNumber", "Brand", "PurchasePrice", "ActualPrice"
    )


def _grouped_totals(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Totals by key, leaving out rows without a key; a group without values gives 0."""
    kinds = dict(df.dtypes)

    def total(name: str) -> Column:
        kind = "bigint" if kinds[name] in ("int", "bigint") else "double"
        return F.coalesce(F.sum(name).cast(kind), F.lit(0).cast(kind)).alias(name)

    return df.dropna(subset=keys).groupBy(*keys).agg(*[total(c) for c in columns])


def purchases_by_brand_price(purchases: DataFrame) -> DataFrame:
    return _grouped_totals(purchases, ["Brand", "PurchasePrice"], ["Quantity", "Dollars"])


def purchases_by_po(purchases: DataFrame) -> DataFrame:
    return _grouped_totals(purchases, ["PONumber"], ["Quantity", "Dollars"])


def sales_by_brand(sales: DataFrame) -> DataFrame:
    return _grouped_totals(
        sales, ["Brand"], ["SalesQuantity", "SalesDollars", "SalesPrice", "ExciseTax"]
    )
