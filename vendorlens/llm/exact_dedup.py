"""Exact deduplication as a stateful stream.

One pass writes a record per document: locator, id, SHA-256 of the text without white space,
length. The records are then streamed; the state, in RocksDB on disk and without expiry, keeps
per digest the best row (its id and locator) and a count, never a text. Every further
call with the same folder takes only new records. Rows that hit a stored digest are checked
on their full bytes: their texts are grouped by digest and text, which combines copies before
the shuffle, so a group of any size stays spread out. A digest with two texts is resolved
by the texts.

NULL text is empty text, and empty texts are copies of each other. Of equal texts, the one with the most
code points stays, then the smallest id (NULL last), then the first locator. An
empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import LOCATOR, located, plain_scan, rows_in, staged, table, without_rows, without_spaces, work_dir

#: Records that one micro-batch takes at most, in bytes of their files.
BATCH_BYTES = 8 << 30

RESULT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def records(docs: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Locator, id, digest and rank (best row first) of every document."""
    body = F.col(f"row.`{text}`")
    bare = without_spaces(body)
    return located(docs).select(
        *LOCATOR, F.col(f"row.`{key}`").alias("id"), digest(bare).alias("digest"),
        F.sha2(bare, 256).alias("sha256"), (-F.coalesce(F.length(body), F.lit(0))).alias("order"),
    )


def best() -> Column:
    """The row that stays: longest text, smallest id, first locator."""
    return F.min(F.struct("order", F.col("id").isNull().alias("no_id"), "id", *LOCATOR))


def stream_into_state(spark: SparkSession, source: str, folder: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Feed new record files of ``source`` to the state under ``folder``; returns the state's rows.

    The checkpoint makes a rerun after a failure go on at the last finished batch.
    """
    settings = {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # a store takes 4 MB of disk however small it is: keep open only those of running tasks
        "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        schema = spark.read.parquet(source).schema
        grouped = (
            spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(source)
            .groupBy("digest").agg(best().alias("best"), F.count(F.lit(1)).alias("group_size"))
        )
        query = (
            grouped.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", folder).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(folder)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return state.select(
        F.col("key.digest").alias("digest"), F.col("value.min").alias("best"), F.col("value.count").alias("group_size")
    )


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Per row: locator, id, SHA-256, and locator, id and size of the group's row that stays."""
    docs = plain_scan(docs)  # both scans below see the same places
    spark = docs.sparkSession
    source = work_dir(spark, "dedup-records")
    records(docs, key, text, digest).write.parquet(source)
    rows = spark.read.parquet(source)
    if rows.isEmpty():
        return rows.select(*LOCATOR, "id", "sha256", F.struct(F.lit(0).alias("order"), F.lit(True).alias("no_id"), "id",
                                                              *LOCATOR).alias("best"), F.lit(0).cast("bigint").alias("group_size"))
    state = staged(stream_into_state(spark, source, work_dir(spark, "dedup-state"), batch_bytes), "dedup-index")
    found = rows.join(state, "digest")
    # full bytes of the rows that hit a stored digest
    hits = staged(found.where("group_size > 1").select(*LOCATOR, "digest"), "dedup-hits")
    _, marked = rows_in(located(docs), hits)
    texts = marked.select(*LOCATOR, without_spaces(F.col(f"row.`{text}`")).alias("bare"))
    mixed = staged(
        texts.select(digest(F.col("bare")).alias("digest"), "bare").groupBy("digest", "bare").agg(F.lit(1).alias("one"))
        .groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"),
        "dedup-mixed",
    )
    plain = ("_file", "_row", "id", "sha256", "best", "group_size")
    if mixed.isEmpty():
        return found.select(*plain)
    loose = rows.join(mixed, "digest", "left_semi").join(texts, list(LOCATOR))
    exact = loose.groupBy("digest", "bare").agg(best().alias("best"), F.count(F.lit(1)).alias("group_size"))
    resolved = loose.join(exact, ["digest", "bare"])
    return found.join(mixed, "digest", "left_anti").select(*plain).unionByName(resolved.select(*plain))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: id, id and size of the group it stays with, whether it stays, SHA-256."""
    same = (F.col("_file") == F.col("best._file")) & (F.col("_row") == F.col("best._row"))
    return exact_groups(docs, key, text, **options).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
        same.alias("kept"), F.col("sha256").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns."""
    source = plain_scan(docs)
    groups = exact_groups(source, key, text, **options)
    gone = groups.where((F.col("_file") != F.col("best._file")) | (F.col("_row") != F.col("best._row")))
    return without_rows(source, staged(gone.select(*LOCATOR), "dedup-dropped"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY n DESC, doc_id) = 1 AS kept,
       sha256(t) AS text_sha256
FROM bare
"""
