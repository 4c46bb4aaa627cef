"""Vendor and product analyses on the profitable rows of the mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import exact_mean, exact_sum, round_cents, safe_ratio
from ..functions.text import dollars
from .quantiles import wide_quantiles, with_quantiles

# The shares that bound low sales and high margins.
LOW_SALES, HIGH_MARGIN = 0.15, 0.85
SIZES = ("Small", "Medium", "Large")
OTHERS = "Other Vendors"


def profitable_rows(mart: DataFrame) -> DataFrame:
    """Rows that sold at a profit: the input of every analysis below."""
    return mart.where("GrossProfit > 0 AND ProfitMargin > 0 AND TotalSalesQuantity > 0")


def loss_rows(mart: DataFrame) -> DataFrame:
    return mart.where("GrossProfit < 0")


def _totals(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    return rows.dropna(subset=[key]).groupBy(key).agg(*[exact_sum(F.col(c)).alias(c) for c in columns])


def brand_performance(rows: DataFrame) -> DataFrame:
    """Sales and plain mean margin per product."""
    return rows.dropna(subset=["BrandName"]).groupBy("BrandName").agg(
        exact_sum(F.col("TotalSalesDollars")).alias("TotalSalesDollars"),
        exact_mean(F.col("ProfitMargin")).alias("ProfitMargin"),
    )


def _with_thresholds(brands: DataFrame) -> DataFrame:
    """Attach the low-sales and high-margin bounds, both from the same scans of ``brands``."""
    found = wide_quantiles(brands, ["TotalSalesDollars", "ProfitMargin"], [LOW_SALES, HIGH_MARGIN])

    def pick(column: str, p: float) -> Column:
        return F.max(F.when((F.col("column") == column) & (F.col("p") == p), F.col("quantile")))

    bounds = found.agg(F.struct(
        pick("TotalSalesDollars", LOW_SALES).alias("low_sales"),
        pick("ProfitMargin", HIGH_MARGIN).alias("high_margin"),
    ).alias("b")).scalar()
    return brands.withColumn("_b", bounds).select(
        *brands.columns, F.col("_b.low_sales").alias("low_sales"), F.col("_b.high_margin").alias("high_margin")
    )


_IS_TARGET = "TotalSalesDollars <= low_sales AND ProfitMargin >= high_margin"


def target_brands(brands: DataFrame) -> DataFrame:
    """Products with low sales and high margins, smallest sales first."""
    return (
        _with_thresholds(brands).where(_IS_TARGET)
        .select("BrandName", "TotalSalesDollars", "ProfitMargin")
        .orderBy("TotalSalesDollars", "BrandName")
    )


def brand_scatter_points(brands: DataFrame, sales_below: float = 10_000.0) -> DataFrame:
    """Points of the promotion chart: all small products, and every target product."""
    bounded = _with_thresholds(brands)
    series = F.array_compact(F.array(
        F.when(F.col("TotalSalesDollars") < sales_below, "All Brands"),
        F.when(F.expr(_IS_TARGET), "Target Brands"),
    ))
    return bounded.select(F.explode(series).alias("series"), *bounded.columns)


def top_by_sales(rows: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The largest sellers, with a dollar label; equal sums in key order."""
    return (
        _totals(rows, key, "TotalSalesDollars")
        .orderBy(F.desc("TotalSalesDollars"), key).limit(n)
        .withColumn("Sales", dollars(F.col("TotalSalesDollars")))
    )


def vendor_contribution(rows: DataFrame) -> DataFrame:
    """Purchases, profit, sales and share of all purchases per vendor, largest first.

    Sorted before rounding; the share is a percentage.
    """
    vendors = _totals(rows, "VendorName", "TotalPurchaseDollars", "GrossProfit", "TotalSalesDollars")
    everything = rows.dropna(subset=["VendorName"]).agg(exact_sum(F.col("TotalPurchaseDollars"))).scalar()
    share = safe_ratio(F.col("TotalPurchaseDollars"), everything) * 100.0
    return vendors.withColumn("PurchaseContribution", share).orderBy(
        F.desc("TotalPurchaseDollars"), "VendorName"
    ).withColumns({c: round_cents(F.col(c)) for c in (
        "TotalPurchaseDollars", "GrossProfit", "TotalSalesDollars", "PurchaseContribution"
    )})


def top_contributors(rows: DataFrame, n: int = 10) -> DataFrame:
    return vendor_contribution(rows).limit(n)


def formatted_contributors(rows: DataFrame, n: int = 10) -> DataFrame:
    """The largest contributors with their amounts as dollar labels."""
    money = ("TotalPurchaseDollars", "GrossProfit", "TotalSalesDollars")
    return top_contributors(rows, n).withColumns({c: dollars(F.col(c)) for c in money})


def vendor_pareto(rows: DataFrame, n: int = 10) -> DataFrame:
    """The largest contributors with the running sum of their rounded shares."""
    # a window over n rows: one task is enough
    running = Window.orderBy(F.desc("TotalPurchaseDollars"), "VendorName").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    share = F.col("PurchaseContribution").cast("decimal(10,2)")
    return top_contributors(rows, n).withColumn(
        "CumulativeContribution", F.sum(share).over(running).cast("double")
    )


def vendor_dependence(rows: DataFrame, n: int = 10) -> DataFrame:
    """Rounded shares of the largest contributors, and what is left for all others."""
    top = top_contributors(rows, n).select("VendorName", "PurchaseContribution")
    rest = F.lit(100.0) - exact_sum(F.col("PurchaseContribution"))
    others = top.agg(rest.cast("decimal(10,2)").cast("double").alias("PurchaseContribution"))
    return top.unionByName(others.select(F.lit(OTHERS).alias("VendorName"), "PurchaseContribution"))


def order_sizes(rows: DataFrame) -> DataFrame:
    """Unit purchase price (NULL for no quantity), and the third of quantities a row falls in.

    Bins are closed on the right. Quantities too alike to give three bins raise.
    """
    quantity = F.col("TotalPurchaseQuantity")
    edges = ["least", "third", "two_thirds", "most"]
    alike = F.lit(False)
    for a, b in zip(edges, edges[1:]):
        alike = alike | (F.col(a) == F.col(b))
    size = (
        F.when(alike, F.raise_error("purchase quantities do not give three distinct sizes"))
        .when(quantity <= F.col("third"), SIZES[0])
        .when(quantity <= F.col("two_thirds"), SIZES[1])
        .when(quantity.isNotNull(), SIZES[2])
    )
    price = F.try_divide(F.col("TotalPurchaseDollars"), quantity)
    number = F.col("TotalPurchaseQuantity").cast("double")
    number = F.when(~F.isnan(number), number)
    ends = rows.agg(F.struct(F.min(number).alias("least"), F.max(number).alias("most"))).scalar()
    thirds = with_quantiles(rows, "TotalPurchaseQuantity", {"third": 1 / 3, "two_thirds": 2 / 3})
    sized = thirds.withColumn("_ends", ends).select("*", "_ends.*").drop("_ends")
    return sized.withColumns({"UnitPurchasePrice": price, "OrderSize": size}).drop(*edges)


def order_size_unit_price(rows: DataFrame) -> DataFrame:
    """Mean unit price per order size."""
    narrow = rows.select("TotalPurchaseQuantity", "TotalPurchaseDollars")
    return order_sizes(narrow).groupBy("OrderSize").agg(
        F.avg("UnitPurchasePrice").alias("UnitPurchasePrice"), F.count(F.lit(1)).alias("row_count")
    )


def low_turnover_vendors(rows: DataFrame, n: int = 10) -> DataFrame:
    """Vendors with the slowest stock, by mean turnover of their rows below 1."""
    return (
        rows.where("StockTurnover < 1").dropna(subset=["VendorName"])
        .groupBy("VendorName").agg(exact_mean(F.col("StockTurnover")).alias("StockTurnover"))
        .orderBy("StockTurnover", "VendorName").limit(n)
    )


def unsold_inventory_value() -> Column:
    """Unsold units at purchase price; negative when more was sold than bought."""
    unsold = F.col("TotalPurchaseQuantity") - F.col("TotalSalesQuantity")
    return unsold.cast("decimal(18,0)") * F.col("PurchasePrice").cast("decimal(18,2)")


def total_unsold_capital(rows: DataFrame) -> DataFrame:
    """Capital in unsold stock over all rows, as one row."""
    total = F.coalesce(F.sum(unsold_inventory_value()).cast("double"), F.lit(0.0))
    return rows.agg(total.alias("UnsoldInventoryValue")).withColumn(
        "UnsoldCapital", dollars(F.col("UnsoldInventoryValue"))
    )


def unsold_capital(rows: DataFrame, n: int = 10) -> DataFrame:
    """The vendors with most capital in unsold stock."""
    total = F.coalesce(F.sum(unsold_inventory_value()).cast("double"), F.lit(0.0))
    return (
        rows.dropna(subset=["VendorName"]).groupBy("VendorName")
        .agg(total.alias("UnsoldInventoryValue"))
        .orderBy(F.desc("UnsoldInventoryValue"), "VendorName").limit(n)
        .withColumn("UnsoldCapital", dollars(F.col("UnsoldInventoryValue")))
    )
