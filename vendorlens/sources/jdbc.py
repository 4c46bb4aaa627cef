"""Rows to and from a database over JDBC. Addresses and credentials come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession

# Rows per write partition, and the least number of partitions.
ROWS_PER_PARTITION = 200_000
MIN_PARTITIONS = 4
# Connections that a write opens at most, unless the caller says otherwise.
MAX_CONNECTIONS = 64


def write_partitions(rows: int, ceiling: int | None = None) -> int:
    """Partitions for a parallel write; ``ceiling`` bounds the open connections."""
    wanted = max(MIN_PARTITIONS, rows // ROWS_PER_PARTITION)
    return wanted if ceiling is None else min(wanted, ceiling)


def jdbc_options(url: str, table: str, user: str, password: str, driver: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def jdbc_writer(df: DataFrame, options: dict[str, str], partitions: int | None = None) -> DataFrameWriter:
    """An appending writer; with ``partitions`` that many connections write at once.

    The repartition is round-robin, so no key can make one connection carry the load.
    """
    if partitions is not None:
        df = df.repartition(partitions)
        options = {**options, "numPartitions": str(partitions)}
    return df.write.format("jdbc").options(**options).mode("append")


def append_jdbc(df: DataFrame, options: dict[str, str], connections: int = MAX_CONNECTIONS) -> int:
    """Count the rows, write them over as many connections as the count asks for, and return the count.

    Never more than ``connections`` are open at once. Pass a stored table: it is read twice.
    """
    rows = df.count()
    jdbc_writer(df, options, write_partitions(rows, connections)).save()
    return rows


def read_options(column: str, low: str, high: str, partitions: int) -> dict[str, str]:
    """Options of a read in ranges of ``column``; the bounds place the cuts and drop no row."""
    if partitions < 1:
        raise ValueError("a read needs a partition")
    return {"partitionColumn": column, "lowerBound": low, "upperBound": high, "numPartitions": str(partitions)}


def jdbc_reader(
    spark: SparkSession, options: dict[str, str], column: str | None = None, low: str = "", high: str = "",
    partitions: int = MIN_PARTITIONS,
) -> DataFrameReader:
    """A reader of a database table; with ``column`` that many connections read a range each."""
    ranges = read_options(column, low, high, partitions) if column else {}
    return spark.read.format("jdbc").options(**options, **ranges)


def read_jdbc(spark: SparkSession, options: dict[str, str], **ranges) -> DataFrame:
    return jdbc_reader(spark, options, **ranges).load()
