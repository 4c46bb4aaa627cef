"""Row ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from ..sources.shared import ship, stage


def add_surrogate_id(df: DataFrame, name: str = "spark_id") -> DataFrame:
    """Unique, increasing ids with gaps, without moving a row."""
    return df.withColumn(name, F.monotonically_increasing_id())


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files with the number of rows before each."""
    for batch in batches:
        for files in batch.column(0).to_pylist():
            sizes = np.array([f["n"] for f in files], dtype=np.int64)
            before = np.cumsum(sizes) - sizes
            found = [{"file": f["file"], "before": int(n)} for f, n in zip(files, before)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([found], pa.list_(pa.struct([("file", pa.string()), ("before", pa.int64())])))], ["offsets"])


def _scan(df: DataFrame) -> DataFrame:
    """``df`` if it is a plain Parquet scan, which knows its rows' places; else a staged copy."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"]).schema
        return df
    except AnalysisException:
        return stage(df, "ids")


def add_dense_id(df: DataFrame, name: str = "spark_id") -> DataFrame:
    """Ids 1..n without gaps, by file and row.

    A row's place in its file comes from the scan, and the rows of a file are counted without reading a
    column, from the files' footers; the rows before a file (a number for each file) are a scalar. No row moves.
    A frame that is no plain Parquet scan is written first, as its rows have no fixed places.
    """
    ship(df.sparkSession)
    rows = _scan(df)
    meta = rows.metadataColumn("_metadata")
    placed = rows.select(*[rows[f"`{c}`"] for c in df.columns], meta["file_path"].alias("_file"), meta["row_index"].alias("_row"))
    sizes = rows.select(meta["file_path"].alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    listed = sizes.agg(F.array_sort(F.collect_list(F.struct("file", "n"))).alias("files"))
    offsets = listed.mapInArrow(_offsets, "offsets array<struct<file:string,before:bigint>>")
    before = offsets.select(F.map_from_entries("offsets")).scalar()
    return placed.withColumn("_before", before).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.element_at("_before", F.col("_file")) + F.col("_row") + 1).alias(name))
