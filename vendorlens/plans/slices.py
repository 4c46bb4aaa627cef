"""The summary of large tables in slices of products, one after the other.

All rows that meet in the summary have one Brand, but for the freight, which has one row per vendor. So rows are dealt to slices by a hash
of Brand, and the summary of all is the summaries of the slices, each by the same operators. A slice is written, and
its shuffle files are removed, before the next one begins: of the shuffles a fixed share is on disk at a time. The tables are
scanned once for each slice, at most `SLICES` times however large they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, functions as F

from ..operators.summary import bought_totals, freight_totals, listed_prices, sold_totals, summary_of_totals, vendor_sales_summary
from ..sources.shared import stage_parts, unstage

#: Slices of large tables, and the bytes of files that make one.
SLICES = 8
SLICE_BYTES = 32 << 20


def _file_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a frame, by its plan; a source that does not know its size counts as nothing."""
    plan = df._jdf.queryExecution().optimizedPlan()
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = plan.collectLeaves()
    found = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in found if size < unknown)


def slice_count(*tables: DataFrame) -> int:
    """Into how many slices tables are dealt, by the bytes of their files."""
    return max(1, min(SLICES, -(-sum(map(_file_bytes, tables)) // SLICE_BYTES)))


def sliced(df: DataFrame, key: str, k: int, slices: int) -> DataFrame:
    """The rows of slice ``k``: equal keys, and rows without one, are in the same slice."""
    return df.where(F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(slices)) == k) if slices > 1 else df


def summary_slices(tables: Mapping[str, DataFrame]) -> Iterator[DataFrame]:
    """`vendor_sales_summary` of raw tables; a slice is to be written before the next one is asked for."""
    purchases, prices, sales = (tables[name] for name in ("purchases", "purchase_prices", "sales"))
    slices = slice_count(purchases, sales)
    if slices == 1:
        yield vendor_sales_summary(purchases, prices, sales, tables["vendor_invoice"])
        return
    invoices = tables["vendor_invoice"]
    freight = stage_parts((freight_totals(sliced(invoices, "VendorNumber", k, slices)) for k in range(slices)), "freight")
    try:
        for k in range(slices):
            yield summary_of_totals(
                bought_totals(sliced(purchases, "Brand", k, slices)), listed_prices(sliced(prices, "Brand", k, slices)),
                sold_totals(sliced(sales, "Brand", k, slices)), freight)
    finally:
        unstage(freight)
