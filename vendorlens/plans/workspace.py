"""Raw tables and mart over a folder of test tables, each staged once per application.

Raw tables and the mart are stored tables in this system: loading writes them, and
queries read them. Staging them keeps that split, so a query scans the columns it
needs instead of repeating the load.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.stats import quartile_groups
from ..operators.vendors import brand_performance, order_sizes, profitable_rows
from ..sources.retail import raw_table
from ..sources.schemas import RAW_SCHEMAS
from ..sources.shared import entries, stage_parts, unstage
from .refresh import cleaned_rows, mart_of
from .slices import slice_count, summary_slices

_open: dict[tuple, "Workspace"] = {}

# Which rows of each raw table the duplicate checks deliver a second time.
REDELIVERED = {
    "sales": "Classification = 1",
    "purchases": "Classification = 1",
    "purchase_prices": "Classification = 1",
    "vendor_invoice": "Quantity >= 40",
    "begin_inventory": "City = 'ASIA'",
    "end_inventory": "City = 'ASIA'",
}


class Workspace(Mapping):
    """``ws[name]`` is a raw table; the derived tables are methods."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory
        self._staged: dict[str, DataFrame] = {}

    def _once(self, name: str, build: Callable[[], DataFrame | Iterator[DataFrame]]) -> DataFrame:
        """What ``build`` returns, staged; it may come in parts."""
        if name not in self._staged:
            rows = build()
            self._staged[name] = stage_parts([rows] if isinstance(rows, DataFrame) else rows, name)
        return self._staged[name]

    def derived(self, name: str) -> DataFrame:
        """A raw table as a plan, if it is not staged."""
        stored = {"purchases": self["purchases"]} if name == "vendor_invoice" else None
        return self._staged[name] if name in self._staged else raw_table(self.spark, self.directory, name, stored)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RAW_SCHEMAS:
            raise KeyError(name)
        return self._once(name, lambda: self.derived(name))

    def __iter__(self):
        return iter(RAW_SCHEMAS)

    def __len__(self) -> int:
        return len(RAW_SCHEMAS)

    def not_staged(self) -> set[str]:
        return set(RAW_SCHEMAS) - set(self._staged)

    def release(self, *names: str) -> None:
        """Remove the staged copies of raw tables that nothing reads any more, if the tables are large; they can be staged again."""
        names = [name for name in names if name in self._staged]
        if slice_count(*[self._staged[name] for name in names]) > 1:
            unstage(*[self._staged.pop(name) for name in names])

    def redelivered(self, name: str) -> DataFrame:
        """A raw table with part of its rows in it twice."""
        return self[name].unionAll(self[name].where(F.expr(REDELIVERED[name])))

    def summary_parts(self) -> Iterator[DataFrame]:
        """The summary from raw tables, in slices to be written one after the other.

        Large raw tables that only this needed are not left behind: invoices are summed up as they are derived, and
        what was staged here goes with the last slice.
        """
        missing = self.not_staged()
        tables = {name: self[name] for name in ("purchases", "purchase_prices", "sales")}
        large = slice_count(tables["purchases"], tables["sales"]) > 1
        yield from summary_slices({**tables, "vendor_invoice": self.derived("vendor_invoice") if large else self["vendor_invoice"]})
        self.release(*missing)

    def summary(self) -> DataFrame:
        return self._once("summary", self.summary_parts)

    def cleaned(self) -> DataFrame:
        return self._once("clean", self._clean_parts)

    def mart(self) -> DataFrame:
        return self._once("mart", lambda: (mart_of(part) for part in self._clean_parts()))

    def _clean_parts(self) -> Iterator[DataFrame]:
        """Clean rows from what is stored already; the mart alone needs no stored copy of them."""
        if "clean" in self._staged:
            return iter([self._staged["clean"]])
        return (cleaned_rows(part) for part in ([self._staged["summary"]] if "summary" in self._staged else self.summary_parts()))

    def profitable(self) -> DataFrame:
        return profitable_rows(self.mart())

    def brands(self) -> DataFrame:
        return self._once("brands", lambda: brand_performance(self.profitable()))

    def margin_groups(self) -> DataFrame:
        """Margins of the best and the least selling quarter."""
        return self._once(
            "margin_groups", lambda: quartile_groups(self.profitable(), "TotalSalesDollars", "ProfitMargin")
        )

    def unit_prices(self) -> DataFrame:
        """Unit purchase prices by order size."""
        def build() -> DataFrame:
            sized = order_sizes(self.profitable().select("TotalPurchaseQuantity", "TotalPurchaseDollars"))
            pair = (F.col("OrderSize").alias("column"), F.col("UnitPurchasePrice").alias("value"))
            return sized.select(*pair).dropna()

        return self._once("unit_prices", build)


def workspace(spark: SparkSession, directory: str) -> Workspace:
    """The workspace of a folder as it is now: changed files open a new one."""
    directory = directory.rstrip("/")
    key = (spark.sparkContext.applicationId, directory, tuple(sorted(entries(spark, directory))))
    if key not in _open:
        _open[key] = Workspace(spark, directory)
    return _open[key]
