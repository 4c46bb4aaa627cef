"""The six raw tables, derived from the star-schema test tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schemas import RAW_SCHEMAS, conform


def _dec(name: str, kind: str = "decimal(18,2)") -> Column:
    return F.col(name).cast(kind)


def _store() -> Column:
    return F.col("l_orderkey") % 80


def _parts(read) -> DataFrame:
    """Products: one row per Brand."""
    price = _dec("p_retailprice")
    millilitres = (F.col("p_size") * 50).cast("string")
    return read("part").select(
        F.col("p_partkey").alias("Brand"),
        F.concat("p_name", F.lit(" "), "p_partkey", F.lit(" ")).alias("Description"),
        F.concat(millilitres, F.lit("mL")).alias("Size"),
        millilitres.alias("Volume"),
        F.when(F.col("p_type") == "ECONOMY", 1).otherwise(2).alias("Classification"),
        price.alias("ListPrice"),
        F.when(F.col("p_partkey") % 97 == 0, F.lit(0)).otherwise(price)
        .cast("decimal(18,2)").alias("PurchasePrice"),
    )


def _vendors(read) -> DataFrame:
    """Vendor names carry padding, for the clean step to strip."""
    return read("supplier").select(
        F.col("s_suppkey").alias("Vendor"),
        F.concat("s_name", F.lit("   ")).alias("VendorName"),
    )


def _inventory_id(*parts: Column) -> Column:
    return F.concat_ws("_", *[p.cast("string") for p in parts])


def _line_facts(read, lines: DataFrame) -> DataFrame:
    """Order lines with their product and vendor; texts are attached last, so that no join moves them but their own."""
    return (
        lines.join(_parts(read), F.col("l_partkey") == F.col("Brand"))
        .join(_vendors(read), F.col("l_suppkey") == F.col("Vendor"))
        .withColumn("Store", _store())
        .withColumn("InventoryId", _inventory_id(_store(), F.col("Vendor"), F.col("Brand")))
    )


def purchases(read) -> DataFrame:
    orders = read("orders").select("o_orderkey", F.to_date("o_orderdate").alias("PODate"))
    received = F.col("received")
    quantity = F.col("quantity")
    lines = read("lineitem").where(F.col("l_returnflag") != "R").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("received"), F.col("l_quantity").cast("bigint").alias("quantity"))
    # dates first, while a line is a few numbers
    return _line_facts(read, lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))).select(
        "InventoryId", "Store", "Brand", "Description", "Size",
        F.col("Vendor").alias("VendorNumber"), "VendorName",
        F.col("l_orderkey").alias("PONumber"), "PODate",
        received.alias("ReceivingDate"),
        F.date_add(received, 7).alias("InvoiceDate"),
        F.date_add(received, 37).alias("PayDate"),
        "PurchasePrice", quantity.alias("Quantity"),
        (quantity * F.col("ListPrice")).alias("Dollars"), "Classification",
    )


def sales(read) -> DataFrame:
    price = _dec("l_extendedprice")
    return _line_facts(read, read("lineitem").where(F.col("l_linestatus") == "O")).select(
        "InventoryId", "Store", "Brand", "Description", "Size",
        (F.col("l_linenumber") * 5).alias("SalesQuantity"),
        (price * (F.lit(1) - _dec("l_discount", "decimal(3,2)"))).alias("SalesDollars"),
        price.alias("SalesPrice"),
        F.to_date("l_shipdate").alias("SalesDate"),
        "Volume", "Classification",
        (price * _dec("l_tax", "decimal(3,2)")).alias("ExciseTax"),
        F.col("Vendor").alias("VendorNo"), "VendorName",
    )


def purchase_prices(read) -> DataFrame:
    vendors = _vendors(read)
    vendor_count = vendors.agg(F.count(F.lit(1))).scalar()
    return (
        _parts(read).withColumn("VendorNumber", F.col("Brand") % vendor_count)
        .join(vendors, F.col("VendorNumber") == F.col("Vendor"), "left")
        .withColumn("Price", F.col("ListPrice") * F.lit("1.4").cast("decimal(3,1)"))
    )


def vendor_invoice(read) -> DataFrame:
    """Invoices add up purchases; a stored ``purchases`` is read instead of derived again."""
    stored = read("purchases")
    return (
        (purchases(read) if stored is None else stored).groupBy("VendorNumber", "VendorName", "PONumber", "PODate")
        .agg(
            F.sum("Quantity").alias("Quantity"),
            F.sum("Dollars").cast("decimal(18,2)").alias("Dollars"),
            F.max("InvoiceDate").alias("InvoiceDate"),
            F.max("PayDate").alias("PayDate"),
        )
        .withColumn("Freight", F.col("Dollars") * F.lit("0.005").cast("decimal(4,3)"))
        .withColumn("Approval", F.lit(None).cast("string"))
    )


def _inventory(read, on_hand: Column, date_name: str, date: str) -> DataFrame:
    """One row per product and region; the regions, one for each store, come as one value.

    Products are few bytes in few files: they are dealt out by size first, or one task would make, and later read, all rows.
    """
    regions = read("region").agg(F.collect_list(F.struct(F.col("r_regionkey").alias("Store"), "r_name"))).scalar()
    return (
        _parts(read).hint("rebalance").withColumn("_regions", regions).select("*", F.inline("_regions")).drop("_regions")
        .select(
            _inventory_id(F.col("Store"), F.col("r_name"), F.col("Brand")).alias("InventoryId"),
            "Store", F.col("r_name").alias("City"), "Brand", "Description", "Size",
            on_hand.alias("onHand"), F.col("ListPrice").alias("Price"),
            F.lit(date).cast("date").alias(date_name),
        )
    )


def begin_inventory(read) -> DataFrame:
    return _inventory(read, (F.col("Brand") * 7 + F.col("Store") * 13) % 100, "startDate", "2024-01-01")


def end_inventory(read) -> DataFrame:
    return _inventory(read, (F.col("Brand") * 11 + F.col("Store") * 17) % 100, "endDate", "2024-12-31")


_BUILDERS = {
    "sales": sales,
    "purchases": purchases,
    "purchase_prices": purchase_prices,
    "vendor_invoice": vendor_invoice,
    "begin_inventory": begin_inventory,
    "end_inventory": end_inventory,
}


def raw_table(spark: SparkSession, directory: str, name: str, stored: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One raw table over the Parquet files of ``directory``, in its declared schema.

    ``stored`` holds raw tables that are derived already.
    """
    def read(table: str) -> DataFrame | None:
        if table in RAW_SCHEMAS:
            return (stored or {}).get(table)
        return spark.read.parquet(f"{directory}/{table}.parquet")

    return conform(_BUILDERS[name](read), RAW_SCHEMAS[name])
