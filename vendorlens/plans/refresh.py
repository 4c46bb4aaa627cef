"""The refresh job: raw files to the mart table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_summary
from ..operators.dedupe import drop_duplicate_rows
from ..operators.features import vendor_features
from ..operators.summary import vendor_sales_summary
from ..sources.files import ingest_directory
from ..sources.shared import remove_folder
from ..sources.schemas import CLEAN_SCHEMA, MART_SCHEMA, conform
from ..sources.tables import create_database, database_folder, load_table, switch_tables, write_version
from ..sources.versions import commit, current, vacuum
from .slices import summary_slices

# The tables the job writes.
CLEAN_TABLE = "clean_data"
MART_TABLE = "vendor_sales_summary"


def summary_of(tables: Mapping[str, DataFrame]) -> DataFrame:
    return vendor_sales_summary(
        tables["purchases"], tables["purchase_prices"], tables["sales"], tables["vendor_invoice"]
    )


def cleaned_rows(summary: DataFrame) -> DataFrame:
    return conform(clean_summary(summary), CLEAN_SCHEMA)


def cleaned_of(tables: Mapping[str, DataFrame]) -> DataFrame:
    return cleaned_rows(summary_of(tables))


def mart_of(cleaned: DataFrame) -> DataFrame:
    return conform(vendor_features(cleaned), MART_SCHEMA)


def refresh_tables(spark: SparkSession, tables: Mapping[str, DataFrame], database: str) -> DataFrame:
    """Write ``clean_data`` and the mart from raw tables; both are replaced together.

    The clean rows are written once, in slices of products, as the next version of their table, and the mart is built
    from that. One manifest makes both visible: a run that stops at any step leaves a pair that belongs together
    (`load_pair`). The catalog follows; the version before stays for readers that have begun.
    """
    create_database(spark, database)
    place = database_folder(spark, database)
    before, written = current(spark, place), {}
    try:
        cleaned = (cleaned_rows(part) for part in summary_slices(tables))
        written[CLEAN_TABLE] = (write_version(cleaned, f"{database}.{CLEAN_TABLE}", guard=tables["purchases"])[0],)
        rows = spark.read.schema(CLEAN_SCHEMA).parquet(*written[CLEAN_TABLE])
        written[MART_TABLE] = (write_version(mart_of(rows), f"{database}.{MART_TABLE}", guard=rows)[0],)
        commit(spark, place, before, written)
    except BaseException:
        for folder, in written.values():
            remove_folder(spark, folder)
        raise
    publish(spark, database)
    vacuum(spark, place)
    return load_pair(spark, database)[1]


def publish(spark: SparkSession, database: str) -> None:
    """Let the catalog show what the manifest names; to be called again if a run stopped before."""
    tables = current(spark, database_folder(spark, database)).tables
    switch_tables(spark, {f"{database}.{name}": tables[name][0] for name in (CLEAN_TABLE, MART_TABLE) if name in tables}, tidy=False)


def load_pair(spark: SparkSession, database: str) -> tuple[DataFrame, DataFrame]:
    """Clean rows and mart of one version."""
    version = current(spark, database_folder(spark, database))
    return version.read(spark, CLEAN_TABLE, CLEAN_SCHEMA), version.read(spark, MART_TABLE, MART_SCHEMA)


def refresh(spark: SparkSession, directory: str, database: str) -> DataFrame:
    """Load a folder of CSV files, drop duplicate rows, and rebuild the mart.

    A second run over the same files gives the same tables.
    """
    create_database(spark, database)
    names = ingest_directory(spark, directory, database, prepare=drop_duplicate_rows)
    tables = {name: load_table(spark, f"{database}.{name}") for name in names}
    return refresh_tables(spark, tables, database)
