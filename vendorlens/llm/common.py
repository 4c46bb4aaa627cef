"""What the operators share: work folders, row locators, row removal, word rules.

A *locator* is the file and the row number of a row of a Parquet table. It names a row even
where ids repeat or are NULL, and it does not change between two scans of the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.shared import application_dir, remove_folder, ship

#: The six characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
LOCATOR = ("_file", "_row")
#: Bits of the filter that `rows_in` sends to every task, for each key, and in all: at least 128 KB and at most 128 MB.
BITS_PER_KEY, FEWEST_BITS, MOST_BITS = 16, 1 << 20, 1 << 30


#: Rows of text that a task turns into Python objects at once.
SLICE = 1_000


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches in slices of few rows, so that a task's memory does not follow the size of Arrow batches."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder's name under the shared folder."""
    return f"{application_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["_staged"] = path
    return out


def freed(*frames: DataFrame) -> None:
    """Remove the folders of frames that `staged` returned and whose successors are written; they cannot be read again."""
    for frame in frames:
        remove_folder(frame.sparkSession, frame.__dict__["_staged"])


def hex_id(column: str = "doc_id") -> Column:
    """The remainder rules of the folds read ids as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def without_spaces(text: Column) -> Column:
    """``text`` (NULL: empty) with every separating character deleted."""
    out = F.coalesce(text, F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def plain_scan(df: DataFrame) -> DataFrame:
    """``df`` if it is a plain Parquet scan, which knows its rows' places; else a staged copy."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"]).schema
        return df
    except AnalysisException:
        return staged(df, "scan")


def located(df: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns) with its locator; a frame that is no plain scan is staged first."""
    ship(df.sparkSession)
    df = plain_scan(df)
    meta = df.metadataColumn("_metadata")
    return df.select(
        F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"),
        meta["file_path"].alias("_file"), meta["row_index"].alias("_row"),
    )


def filter_bits(keys: int) -> int:
    """Bits of the filter for so many keys: a power of two."""
    return min(MOST_BITS, max(FEWEST_BITS, 1 << (keys * BITS_PER_KEY - 1).bit_length())) if keys else FEWEST_BITS


def rows_in(
    rows: DataFrame, keys: DataFrame, columns: tuple[str, ...] = LOCATOR, bits: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split ``rows`` into those certainly not among ``keys`` (by ``columns``) and those perhaps among them.

    ``keys`` are hashed into a bitmap, sized by their number up to `MOST_BITS`; only that goes to every task.
    Rows whose bit is unset need no shuffle. The others are few, below a fifth of the clear rows up to 2 * 10^8 keys;
    a crowded bitmap costs time and no row.
    """
    bits = filter_bits(keys.count()) if bits is None else bits
    place = F.pmod(F.xxhash64(*columns), F.lit(bits))
    bitmap = (
        keys.select(place.alias("_p"))
        .groupBy(F.bitmap_bucket_number("_p").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_bitmap"))
    )
    bitmap = staged(bitmap, "bitmap")
    at = F.bitmap_bit_position(F.col("_p"))
    byte = F.conv(F.hex(F.substring("_bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = rows.withColumn("_p", place).withColumn("_bucket", F.bitmap_bucket_number("_p")).join(
        F.broadcast(bitmap), "_bucket", "left"
    ).withColumn("_set", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))
    marked = marked.drop("_p", "_bucket", "_bitmap")
    return marked.where(~F.col("_set")).drop("_set"), marked.where("_set").drop("_set")


def without_rows(df: DataFrame, dropped: DataFrame) -> DataFrame:
    """``df`` without the rows whose locators are in ``dropped``; all columns stay as they are.

    Only rows that the bitmap of `rows_in` marks are shuffled.
    """
    rows, dropped = located(df), dropped.select(*LOCATOR)
    clear, marked = rows_in(rows, dropped)
    kept = clear.unionByName(marked.join(dropped, list(LOCATOR), "left_anti").select(clear.columns))
    return kept.select("row.*")
