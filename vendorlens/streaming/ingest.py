"""Incremental CSV ingest: each run loads the files that are new since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import CSV_OPTIONS, typed
from ..sources.schemas import RAW_SCHEMAS, column_types
from ..sources.shared import exists


def read_new_files(
    spark: SparkSession, directory: str, ddl: str, files: str = "*.csv", per_batch: int | None = None
) -> DataFrame:
    """A stream of typed rows from the CSV files of a folder.

    Header names are checked against ``ddl``. ``per_batch`` bounds the files of one
    micro-batch, and with them the work that is repeated after a failure.
    """
    text = ", ".join(f"`{name}` string" for name in column_types(ddl))
    reader = spark.readStream.schema(text).options(
        **CSV_OPTIONS, enforceSchema="false", pathGlobFilter=files
    )
    if per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return typed(reader.csv(directory), ddl)


def append_stream(rows: DataFrame, target: str, progress: str) -> StreamingQuery:
    """Write what is available now to a Parquet folder, each input file exactly once.

    ``progress`` is the stream's checkpoint folder; both belong on shared storage.
    """
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )


def ingest_new_files(
    spark: SparkSession,
    directory: str,
    table: str,
    target: str,
    progress: str,
    files: str = "*.csv",
    per_batch: int | None = None,
) -> int:
    """Load the new files of a raw table and return how many rows were added.

    The count comes from the written files (their footers), not from the stream's progress reports, of
    which only the last ones are kept.
    """
    def stored() -> int:
        return spark.read.schema(RAW_SCHEMAS[table]).parquet(target).count() if exists(spark, target) else 0

    before = stored()
    rows = read_new_files(spark, directory, RAW_SCHEMAS[table], files, per_batch)
    append_stream(rows, target, progress).awaitTermination()
    return stored() - before
