"""Joins whose keys are measured first, so that a heavy key is spread over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key is heavy from this share of the rows on; so there are at most 1 / `HEAVY` of them.
HEAVY = 1 / 2000
#: Parts of a heavy key for each partition's worth of its rows: parts are dealt by a hash, which evens out over many.
PARTS = 32


def spread_join(left: DataFrame, right: DataFrame, key: str, heavy: float = HEAVY) -> DataFrame:
    """Inner join on ``key`` (not NULL), as ``left.join(right, key)`` gives.

    The rows of ``left`` are counted by key, map side first. Those of a heavy key are dealt to parts, as
    many as keep a part far below what a partition holds, and the rows of ``right`` of that key, few by intent, are
    repeated for every part. Other keys join as they are. The heavy keys, a bounded number, reach the rows as a scalar.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    parts = F.ceil(F.col("n") * (partitions * PARTS) / F.greatest(total, F.lit(1))).cast("int")
    known = counts.where(F.col("n") > total * heavy).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(key), parts)))).scalar()
    into = F.coalesce(F.try_element_at(F.col("_heavy"), F.col(key)), F.lit(1))
    dealt = left.withColumn("_heavy", known).withColumn("_part", F.pmod(F.monotonically_increasing_id(), into)).drop("_heavy")
    repeated = right.withColumn("_heavy", known).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), into.cast("bigint") - 1))).drop("_heavy")
    return dealt.join(repeated, [key, "_part"]).drop("_part")
