"""Every registered query, by name."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import dollars
from ..operators import clean, dedupe, features, ids, profile, stats, summary, vendors
from ..operators.quantiles import exact_quantiles, long_form, wide_quantiles
from ..sources.schemas import RAW_SCHEMAS
from ..sources.shared import application_dir, stage_parts
from ..sources.files import ingest_directory, read_inferred, write_csv
from ..sources.tables import append_conformed, create_database, create_table, list_tables, load_table, register_views
from ..streaming.ingest import ingest_new_files
from .incremental import TOTALS, add_rows, mart_of_version
from .refresh import cleaned_of, mart_of, refresh_tables
from .workspace import REDELIVERED, Workspace, workspace

VENDOR = 7  # the vendor of the drill-downs
SMALL_PRODUCT = 500_000.0  # sales bound of the promotion chart at test scale


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Cut the float noise of order-dependent sums, so results compare by value."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _as_double(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison by value."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


def _refresh(ws: Workspace) -> DataFrame:
    """The job from duplicated raw tables to the saved mart."""
    database = "vendorlens_" + re.sub(r"\W", "_", ws.directory.strip("/"))
    create_database(ws.spark, database, f"{application_dir(ws.spark)}/{database}.db")
    unique = {name: dedupe.drop_duplicate_rows(ws.redelivered(name)) for name in ws}
    return refresh_tables(ws.spark, unique, database)


def _remaining(ws: Workspace) -> DataFrame:
    checks = [
        dedupe.remaining_duplicates(dedupe.drop_duplicate_rows(ws.redelivered(name)))
        .select(F.lit(name).alias("table_name"), "remaining_duplicates")
        for name in ws
    ]
    return reduce(DataFrame.unionByName, checks)


def _surplus(ws: Workspace) -> DataFrame:
    """Rows of each redelivered table that are there once too often."""
    checks = [
        dedupe.remaining_duplicates(ws.redelivered(name)).select(
            F.lit(name).alias("table_name"), F.col("remaining_duplicates").alias("surplus"))
        for name in ws
    ]
    return reduce(DataFrame.unionByName, checks)


def _csv_round_trip(ws: Workspace) -> DataFrame:
    """Invoices written as a folder of CSV parts and loaded from it as a table."""
    folder, database = f"{application_dir(ws.spark)}/csv-{uuid.uuid4().hex}", "vendorlens_csv"
    create_database(ws.spark, database, f"{application_dir(ws.spark)}/{database}.db")
    write_csv(ws["vendor_invoice"], f"{folder}/vendor_invoice.csv")
    ingest_directory(ws.spark, folder, database)
    return _as_double(load_table(ws.spark, f"{database}.vendor_invoice"))


def _stream_ingest(ws: Workspace) -> DataFrame:
    """Prices that a stream picks up from CSV parts, and the count it reports."""
    folder = f"{application_dir(ws.spark)}/stream-{uuid.uuid4().hex}"
    write_csv(ws["purchase_prices"], f"{folder}/inbox")
    added = ingest_new_files(ws.spark, f"{folder}/inbox", "purchase_prices", f"{folder}/rows", f"{folder}/progress", per_batch=1)
    rows = ws.spark.read.schema(RAW_SCHEMAS["purchase_prices"]).parquet(f"{folder}/rows")
    return _as_double(rows).withColumn("added", F.lit(added).cast("bigint"))


def _refresh_added(ws: Workspace) -> DataFrame:
    """The mart after a first delivery, a second one that repeats half of it, and one of prices alone."""
    place, missing = f"{application_dir(ws.spark)}/added-{uuid.uuid4().hex}", ws.not_staged()
    twice = {totals.table: ws.redelivered(totals.table) for totals in TOTALS}
    half = {name: F.pmod(F.hash("PONumber" if name == "vendor_invoice" else "Brand"), F.lit(2)) == 0 for name in twice}
    add_rows(ws.spark, place, {name: rows.where(half[name]) for name, rows in twice.items()})
    prices = twice.pop("purchase_prices")
    add_rows(ws.spark, place, twice)
    ws.release(*missing & twice.keys())
    return mart_of_version(ws.spark, add_rows(ws.spark, place, {"purchase_prices": prices}))


def _database_tables(ws: Workspace) -> DataFrame:
    """The tables that a refresh leaves in its database, with their rows."""
    database = "vendorlens_listed"
    create_database(ws.spark, database, f"{application_dir(ws.spark)}/{database}.db")
    refresh_tables(ws.spark, ws, database)
    return profile.table_counts({name: load_table(ws.spark, f"{database}.{name}") for name in list_tables(ws.spark, database)})


def _appended_mart(ws: Workspace) -> DataFrame:
    """A typed table that takes the mart in two appends."""
    database, table = "vendorlens_appended", f"vendorlens_appended.mart_{uuid.uuid4().hex}"
    create_database(ws.spark, database, f"{application_dir(ws.spark)}/{database}.db")
    create_table(ws.spark, table)
    for part in ("GrossProfit > 0", "NOT GrossProfit > 0"):
        append_conformed(ws.mart().where(part), table)
    return load_table(ws.spark, table)


def _sql_over_tables(ws: Workspace) -> DataFrame:
    """A query text over named tables."""
    register_views({"raw_purchases": ws["purchases"], "raw_prices": ws["purchase_prices"]})
    return ws.spark.sql("""
        SELECT VendorNumber, count(*) AS row_count, sum(Quantity) AS quantity, CAST(sum(Dollars) AS DOUBLE) AS dollars
        FROM raw_purchases WHERE Brand IN (SELECT Brand FROM raw_prices WHERE Classification = 1) GROUP BY VendorNumber""")


def _mart_key(ws: Workspace) -> DataFrame:
    """Repeated keys of a mart whose price list came again with other prices for some products."""
    prices = ws["purchase_prices"]
    again = prices.where(REDELIVERED["purchase_prices"]).withColumn("Price", (F.col("Price") + 1).cast("decimal(18,2)"))
    tables = {**{name: ws[name] for name in ws}, "purchase_prices": prices.unionByName(again)}
    return dedupe.key_violations(mart_of(cleaned_of(tables)), ["VendorNumber", "Brand"])


def _rejected_planted(ws: Workspace) -> DataFrame:
    """Volumes that are no number, in a summary where every tenth product carries its unit."""
    unit = F.when(F.col("Brand") % 10 == 0, F.concat("Volume", F.lit("mL"))).otherwise(F.col("Volume"))
    return clean.rejected_volumes(ws.summary().withColumn("Volume", unit))


def _inferred(ws: Workspace) -> DataFrame:
    """Types that a folder of CSV parts shows, and its totals as such."""
    folder = f"{application_dir(ws.spark)}/inferred-{uuid.uuid4().hex}"
    write_csv(ws["purchases"], folder)
    rows = read_inferred(ws.spark, folder)
    kinds = F.concat_ws(",", *[F.lit(f"{n} {t}") for n, t in sorted(rows.dtypes)])
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("Quantity").alias("quantity"), F.max("PODate").cast("string").alias("last"),
        F.round(F.sum("Dollars"), 2).alias("dollars")).withColumn("kinds", kinds)


def _surrogate(ws: Workspace) -> DataFrame:
    return ids.add_surrogate_id(ws["sales"]).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("spark_id").alias("ids")
    )


def _dense(ws: Workspace) -> DataFrame:
    return ids.add_dense_id(ws["sales"]).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("spark_id").alias("ids"),
        F.min("spark_id").alias("lowest"), F.max("spark_id").alias("highest"),
    )


def _formatted(ws: Workspace) -> DataFrame:
    money = ("TotalPurchaseDollars", "TotalSalesDollars", "GrossProfit")
    return ws.mart().select(
        "VendorNumber", "Brand", "PurchasePrice", *[dollars(F.col(c)).alias(c) for c in money]
    )


def _margins(ws: Workspace) -> DataFrame:
    return long_form(ws.profitable(), ["ProfitMargin"])


def _all_numbers(ws: Workspace) -> DataFrame:
    return long_form(ws.mart(), clean.numeric_columns(ws.mart()))


def _describe(ws: Workspace) -> DataFrame:
    return _rounded(stats.describe(ws.mart()), 6, "mean", "std", "q25", "q50", "q75")


def _boxplot(found: DataFrame) -> DataFrame:
    return _rounded(found, 6, "q25", "q50", "q75", "whisker_low", "whisker_high")


def _histogram(values: DataFrame) -> DataFrame:
    return _rounded(stats.histogram(values), 6, "bin_start", "bin_end")


def _density(values: DataFrame) -> DataFrame:
    return _rounded(stats.density(values), 6, "x", "density")


def _quantiles(ws: Workspace) -> DataFrame:
    found = exact_quantiles(ws.profitable(), "TotalSalesDollars", [0.15, 0.25, 0.5, 0.75, 0.85])
    return _rounded(found, 6, "quantile")


def _quartiles_bracketed(ws: Workspace) -> DataFrame:
    """Quartiles of every mart number."""
    mart = ws.mart()
    return _rounded(wide_quantiles(mart, clean.numeric_columns(mart), [0.25, 0.5, 0.75]), 6, "quantile")


_QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {
    # the job and its steps
    "refresh_mart": _refresh,
    "refresh_added_rows": _refresh_added,
    "vendor_sales_summary": lambda ws: summary.by_purchase_dollars(stage_parts(ws.summary_parts(), "summary")),
    "database_tables": _database_tables,
    "appended_mart": _appended_mart,
    "sql_over_tables": _sql_over_tables,
    "inferred_csv": _inferred,
    "csv_round_trip": _csv_round_trip,
    "stream_ingest": _stream_ingest,
    "clean_summary": lambda ws: clean.clean_summary(ws.summary()),
    "rejected_volumes_planted": _rejected_planted,
    "rejected_volumes": lambda ws: clean.rejected_volumes(ws.summary()),
    "vendor_features": lambda ws: features.vendor_features(ws.cleaned()),
    "notebook_features": lambda ws: features.notebook_features(ws.summary()),
    # totals
    "freight_summary": lambda ws: summary.freight_summary(ws["vendor_invoice"]),
    "purchase_price_join": lambda ws: _as_double(
        summary.purchase_price_join(ws["purchases"], ws["purchase_prices"]).select(
            "VendorNumber", "Brand", "PONumber", "PurchasePrice", "Quantity", "Dollars",
            "ActualPrice", "Volume",
        )
    ),
    "purchase_summary": lambda ws: summary.purchase_summary(
        ws["purchases"], ws["purchase_prices"]
    ).orderBy("TotalPurchaseDollars", "VendorNumber", "Brand"),
    "sales_summary": lambda ws: summary.sales_summary(ws["sales"]),
    "purchases_by_brand_price": lambda ws: _as_double(summary.purchases_by_brand_price(ws["purchases"])),
    "purchases_by_po": lambda ws: summary.purchases_by_po(ws["purchases"]),
    "sales_by_brand": lambda ws: summary.sales_by_brand(ws["sales"]),
    # looking at tables
    "table_counts": lambda ws: profile.table_counts(dict(ws)),
    "table_preview": lambda ws: _as_double(
        profile.preview(ws["vendor_invoice"], order=["VendorNumber", "PONumber", "PODate"])
    ),
    "vendor_drilldown_purchases": lambda ws: _as_double(profile.rows_of(ws["purchases"], "VendorNumber", VENDOR)),
    "vendor_drilldown_sales": lambda ws: _as_double(profile.rows_of(ws["sales"], "VendorNo", VENDOR)),
    "vendor_drilldown_prices": lambda ws: _as_double(profile.rows_of(ws["purchase_prices"], "VendorNumber", VENDOR)),
    "vendor_drilldown_invoices": lambda ws: _as_double(profile.rows_of(ws["vendor_invoice"], "VendorNumber", VENDOR)),
    "po_distinct": lambda ws: profile.distinct_count(ws["vendor_invoice"], "PONumber", "po_numbers"),
    "distinct_volume": lambda ws: profile.distinct_values(ws.summary(), "Volume"),
    "distinct_vendor_names": lambda ws: profile.distinct_values(ws.summary(), "VendorName"),
    "distinct_brand_names": lambda ws: profile.distinct_values(ws.summary(), "BrandName"),
    "volume_residue": lambda ws: profile.residue(ws.summary(), "Volume"),
    "null_profile": lambda ws: profile.null_profile(ws.summary()),
    "null_profile_clean": lambda ws: profile.null_profile(ws.cleaned()),
    "column_profile": lambda ws: profile.column_profile(ws.mart()),
    "top_vendor_counts": lambda ws: profile.top_counts(ws.profitable(), "VendorName"),
    "top_brand_counts": lambda ws: profile.top_counts(ws.profitable(), "BrandName"),
    "surrogate_key": _surrogate,
    "dense_key": _dense,
    # duplicates and keys
    "sales_duplicates": lambda ws: _as_double(dedupe.duplicate_rows(ws.redelivered("sales"))),
    **{
        f"dedupe_{name}": lambda ws, name=name: _as_double(dedupe.drop_duplicate_rows(ws.redelivered(name)))
        for name in RAW_SCHEMAS
    },
    "first_invoice_of_po": lambda ws: _as_double(
        dedupe.keep_first(ws["vendor_invoice"], ["PONumber"], ["VendorNumber", "PODate"])
    ),
    "remaining_duplicates": _remaining,
    "surplus_copies": _surplus,
    "key_violations": lambda ws: dedupe.key_violations(ws["vendor_invoice"], ["PONumber"]),
    "key_violations_prices": lambda ws: dedupe.key_violations(ws.redelivered("purchase_prices"), ["VendorNumber", "Brand"]),
    "key_violations_mart_key": _mart_key,
    "key_violations_mart": lambda ws: dedupe.key_violations(ws.mart(), ["VendorName", "Volume"]),
    # vendors and products
    "profitable_rows": lambda ws: ws.profitable(),
    "loss_rows": lambda ws: vendors.loss_rows(ws.mart()),
    "brand_performance": lambda ws: vendors.brand_performance(ws.profitable()),
    "target_brands": lambda ws: vendors.target_brands(ws.brands()),
    "brand_scatter_points": lambda ws: _rounded(
        vendors.brand_scatter_points(ws.brands(), SMALL_PRODUCT), 6, "low_sales", "high_margin"
    ),
    "top_vendors": lambda ws: vendors.top_by_sales(ws.profitable(), "VendorName"),
    "top_brands": lambda ws: vendors.top_by_sales(ws.profitable(), "BrandName"),
    "vendor_contribution": lambda ws: vendors.vendor_contribution(ws.profitable()),
    "formatted_contributors": lambda ws: vendors.formatted_contributors(ws.profitable()),
    "vendor_pareto": lambda ws: vendors.vendor_pareto(ws.profitable()),
    "vendor_dependence": lambda ws: vendors.vendor_dependence(ws.profitable()),
    "order_size_unit_price": lambda ws: _rounded(
        vendors.order_size_unit_price(ws.profitable()), 6, "UnitPurchasePrice"
    ),
    "low_turnover_vendors": lambda ws: vendors.low_turnover_vendors(ws.profitable()),
    "unsold_capital": lambda ws: vendors.unsold_capital(ws.profitable()),
    "total_unsold_capital": lambda ws: vendors.total_unsold_capital(ws.profitable()),
    "formatted_dollars": _formatted,
    # statistics
    "describe_mart": _describe,
    "mode_mart": lambda ws: stats.modes(ws.mart()),
    "sales_quantiles": _quantiles,
    "quartiles_bracketed": _quartiles_bracketed,
    "correlation_matrix": lambda ws: _rounded(stats.correlation_matrix(ws.profitable()), 6, "r"),
    "histogram_margin": lambda ws: _histogram(_margins(ws)),
    "histogram_margin_groups": lambda ws: _histogram(ws.margin_groups()),
    "histogram_all": lambda ws: _histogram(_all_numbers(ws)),
    "histogram_profitable": lambda ws: _histogram(
        long_form(ws.profitable(), clean.numeric_columns(ws.profitable()))
    ),
    "density_all": lambda ws: _rounded(stats.density_columns(ws.mart()), 6, "x", "density"),
    "density_margin": lambda ws: _density(_margins(ws)),
    "density_margin_groups": lambda ws: _density(ws.margin_groups()),
    "boxplot_stats": lambda ws: _boxplot(stats.boxplot_columns(ws.mart())),
    "boxplot_unit_price": lambda ws: _boxplot(stats.boxplot(ws.unit_prices())),
    "margin_ci_stats": lambda ws: _rounded(stats.group_moments(ws.margin_groups()), 6, "mean", "std"),
    "margin_ci": lambda ws: _rounded(
        stats.confidence_intervals(ws.margin_groups()), 6, "mean", "lower", "upper"
    ),
    "welch_stats": lambda ws: _rounded(stats.welch_statistic(ws.margin_groups()), 6, "t", "df"),
    "welch_ttest": lambda ws: _rounded(stats.welch_test(ws.margin_groups()), 6, "t", "df", "p"),
}


def _registered(build: Callable[[Workspace], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: build(workspace(spark, directory))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _registered(build) for name, build in _QUERIES.items()}
