"""Catalog tables: create, save, load, list."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .schemas import MART_SCHEMA, conform
from .shared import entries, remove_folder, store
from .versions import new_folder

#: Earlier versions of a table that stay for readers that are still running.
EARLIER = 1


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if absent; ``location`` is a folder all executors share."""
    if not name:
        raise ValueError("database name is empty")
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def create_table(spark: SparkSession, name: str, ddl: str = MART_SCHEMA) -> None:
    """An empty typed Parquet table, unless it is there already."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")


def create_landing_table(df: DataFrame, name: str) -> None:
    """An empty all-text table with the columns of ``df``."""
    create_table(df.sparkSession, name, ", ".join(f"`{c}` string" for c in df.columns))


def require_rows(df: DataFrame) -> DataFrame:
    """Fail on an empty input (reads as little as one row)."""
    if df.isEmpty():
        raise ValueError("the input has no rows")
    return df


def database_folder(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip("/")


def _location(spark: SparkSession, name: str) -> str:
    """A new folder for the next version of a table, beside those of its database."""
    database, _, table = name.rpartition(".")
    return new_folder(database_folder(spark, database), table)


def write_version(df: DataFrame | Iterable[DataFrame], name: str, guard: DataFrame | None = None) -> tuple[str, int]:
    """Write the next version of a table to a folder of its own; the table does not change yet.

    Returns the folder and the number of rows, counted during the write. An empty input is refused first;
    pass the scan behind an expensive ``df`` as ``guard`` so that this check does not run the plan twice. Rows may come as
    several frames, with a ``guard``; each is written before the next is asked for.
    """
    guard = require_rows(df if guard is None else guard)
    path, rows = _location(guard.sparkSession, name), 0
    try:
        for part in [df] if isinstance(df, DataFrame) else df:
            written = Observation()
            store(part.observe(written, F.count(F.lit(1)).alias("rows")), path, add=True)
            rows += written.get["rows"]
    except BaseException:
        remove_folder(guard.sparkSession, path)
        raise
    return path, rows


def switch_tables(spark: SparkSession, versions: Mapping[str, str], tidy: bool = True) -> None:
    """Let tables show written versions. Only the catalog changes, after all data is there.

    A reader that has begun goes on with the folder it began with: what a table showed before stays until
    `EARLIER` further versions are there (``tidy``; else someone else removes it). Tables switch one after the other; readers that need several of
    one version ask the manifest (`sources.versions`).
    """
    for name, path in versions.items():
        schema = spark.read.parquet(path).schema
        if spark.catalog.tableExists(name):
            same = [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]
            if same:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
                spark.catalog.refreshTable(name)
            else:
                spark.sql(f"DROP TABLE {name}")
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
        if tidy:
            _remove_earlier(spark, path)


def _remove_earlier(spark: SparkSession, path: str) -> None:
    """Remove the versions beside ``path`` but for it and the `EARLIER` last written ones."""
    folder, _, shown = path.rstrip("/").rpartition("/")
    beside = [(changed, found) for found, is_folder, _, changed in entries(spark, folder)
              if is_folder and re.search(r"/v-[0-9a-f]{32}$", found) and not found.endswith(f"/{shown}")]
    for _, old in sorted(beside)[: -EARLIER or None]:
        remove_folder(spark, old)


def save_table(
    df: DataFrame, name: str, mode: str = "overwrite", guard: DataFrame | None = None
) -> int:
    """Write a table and return the number of rows written.

    ``overwrite`` writes the rows beside the table and switches to them at the end, so a failed write
    leaves the table as it was; ``df`` may read the table. ``append`` relies on the Parquet commit.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "overwrite" or not df.sparkSession.catalog.tableExists(name):
        path, rows = write_version(df, name, guard)
        switch_tables(df.sparkSession, {name: path})
        return rows
    require_rows(df if guard is None else guard)
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append").saveAsTable(name)
    return written.get["rows"]


def append_conformed(df: DataFrame, name: str, ddl: str = MART_SCHEMA) -> None:
    """Append to a typed table; columns are matched by name and cast first."""
    create_table(df.sparkSession, name, ddl)
    conform(require_rows(df), ddl).write.mode("append").saveAsTable(name)


def load_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Name frames for SQL, so that a query text runs with ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """The tables of a database; the catalog lists the session's views with them."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
