"""Profit, margin, turnover and ratio of each vendor x product row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import finite_or_zero, round_cents, safe_ratio
from .clean import clean_summary, double_columns


def _ratios(df: DataFrame) -> DataFrame:
    sales, bought = F.col("TotalSalesDollars"), F.col("TotalPurchaseDollars")
    return df.withColumn("GrossProfit", sales - bought).withColumns({
        "ProfitMargin": safe_ratio(F.col("GrossProfit"), sales) * 100.0,
        "StockTurnover": safe_ratio(F.col("TotalSalesQuantity"), F.col("TotalPurchaseQuantity")),
        "SalestoPurchaseRatio": safe_ratio(sales, bought),
    })


def vendor_features(cleaned: DataFrame) -> DataFrame:
    """The mart: features on cleaned rows, numbers rounded to two decimals.

    An unsold product counts as a loss of all its purchase dollars.
    """
    df = _ratios(cleaned)
    return df.withColumns({c: round_cents(finite_or_zero(F.col(c))) for c in double_columns(df)})


def notebook_features(summary: DataFrame) -> DataFrame:
    """Variant that computes before filling and does not round.

    An unsold product has no sales to compare with, so its features are 0 here.
    """
    return clean_summary(_ratios(summary))
