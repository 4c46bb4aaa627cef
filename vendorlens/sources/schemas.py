"""Table schemas. Column names are fixed values of the data model; types are ours."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The six raw tables.
RAW_SCHEMAS = {
    "sales": """
        InventoryId string, Store bigint, Brand bigint, Description string, Size string,
        SalesQuantity bigint, SalesDollars decimal(18,2), SalesPrice decimal(18,2),
        SalesDate date, Volume string, Classification int, ExciseTax decimal(18,2),
        VendorNo bigint, VendorName string""",
    "purchases": """
        InventoryId string, Store bigint, Brand bigint, Description string, Size string,
        VendorNumber bigint, VendorName string, PONumber bigint, PODate date,
        ReceivingDate date, InvoiceDate date, PayDate date, PurchasePrice decimal(18,2),
        Quantity bigint, Dollars decimal(18,2), Classification int""",
    "purchase_prices": """
        Brand bigint, Description string, Price decimal(18,2), Size string, Volume string,
        Classification int, PurchasePrice decimal(18,2), VendorNumber bigint,
        VendorName string""",
    "vendor_invoice": """
        VendorNumber bigint, VendorName string, InvoiceDate date, PONumber bigint,
        PODate date, PayDate date, Quantity bigint, Dollars decimal(18,2),
        Freight decimal(18,2), Approval string""",
    "begin_inventory": """
        InventoryId string, Store int, City string, Brand bigint, Description string,
        Size string, onHand bigint, Price decimal(18,2), startDate date""",
    "end_inventory": """
        InventoryId string, Store int, City string, Brand bigint, Description string,
        Size string, onHand bigint, Price decimal(18,2), endDate date""",
}

# The vendor x product summary and the features added to it.
SUMMARY_SCHEMA = """
    VendorNumber bigint, VendorName string, Brand bigint, BrandName string,
    PurchasePrice double, ActualPrice double, Volume string,
    TotalPurchaseQuantity bigint, TotalPurchaseDollars double,
    TotalSalesQuantity bigint, TotalSalesDollars double, TotalSalesPrice double,
    TotalExciseTax double, FreightCost double"""

CLEAN_SCHEMA = SUMMARY_SCHEMA.replace("Volume string", "Volume double")

MART_SCHEMA = (
    CLEAN_SCHEMA
    + """, GrossProfit double, ProfitMargin double, StockTurnover double,
    SalestoPurchaseRatio double"""
)


def column_types(ddl: str) -> dict[str, str]:
    """Ordered column -> type from a DDL string such as ``a int, b decimal(18,2)``."""
    out, depth, start = {}, 0, 0
    text = ddl + ","
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            name, kind = text[start:i].split(None, 1)
            out[name] = kind.strip()
            start = i + 1
    return out


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select and cast the columns of ``ddl``; a value that does not fit raises (ANSI)."""
    return df.select([F.col(c).cast(t).alias(c) for c, t in column_types(ddl).items()])
