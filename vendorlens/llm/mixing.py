"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order (NULL last) weigh 5, 2, 1, repeating, and share 1.5 times all
words; a target stops at twice its source's words and the excess is shared again by
weight. Rates: among all document rates between 0 and 2 that give each source its target of
words, those closest to 1 in relative entropy are ``min(2, exp(a * size / mean size))``, with one
number ``a`` per source. The dual is convex; Newton steps on it, one grouped sum over
(source, size) counts each, run for all sources at once and fall back on bisection where a
step leaves its bracket. Rates become 0, 1 or 2 copies: documents of a source are dealt by a hash into
buckets, and in a bucket, longest first, the part of a rate that rounding takes or adds is
passed on to the next document. A bucket needs one number of memory, so a source may be of any length. Rows of equal id, source
and size are one entry with a count there, and are written out from the count by many tasks.

Sums are taken over decimals, so results do not depend on the order of rows. NULL and empty
texts have size 0 and one copy of nothing. A source without words has target 0. A NULL source is a
source of its own, equal rows are separate documents, NULL ids are kept, and an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import ship, staged, table

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2
#: Documents in a rounding bucket, on average; rounds and relative error of the dual's solution; rows a task writes out of a count.
BUCKET, ROUNDS, CLOSE, WRITTEN = 4096, 60, 1e-7, 1 << 16
WORDS = r"[^\x20\x09-\x0D]+"


def ranked(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``rank`` from 0 by ``column`` (distinct values, NULL last), range by range, not in one task."""
    order = F.col(column).asc_nulls_last()
    ranges = staged(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range: as many as the job has partitions
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return ranges.withColumn("_within", within).join(before, "_range").withColumn(
        "rank", F.col("_before") + F.col("_within")).drop("_range", "_within", "_before")


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (rank, source_size) with ``target``: water filling by weight under the cap."""
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS)).cast("int") + 1)
    weighed = staged(sources.withColumn("weight", weight), "weighed")
    cap = F.col("source_size") * CAP
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * SHARE
    level = 0.0
    while True:  # each round caps more sources, so it ends; words per weight only grow
        capped = F.col("weight") * F.lit(level) >= cap
        fixed, open_ = weighed.agg(
            F.sum(F.when(capped, cap).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))).first()
        new = (total - fixed) / open_ if open_ else level
        if new <= level:
            return weighed.withColumn("target", F.least(F.col("weight") * F.lit(level), cap).cast("double"))
        level = new


def solve(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with the tilt ``a`` of each; ``sizes`` counts documents by (rank, size)."""
    least = sizes.where("size > 0").groupBy("rank").agg(
        F.min("size").alias("least"), F.sum("n").alias("filled"))
    x = F.col("least") / (F.col("source_size") / F.col("filled"))
    state = staged(
        sources.join(least, "rank").where(F.col("target") < CAP * F.col("source_size")).select(
            "rank", "target", (F.col("source_size") / F.col("filled")).alias("mean"), F.lit(0.0).alias("a"),
            (-F.log(F.greatest(F.col("source_size") / F.col("target"), F.lit(1.0))) / x).alias("low"),
            (F.lit(math.log(CAP)) / x).alias("high"), F.lit(1.0).alias("error")), "dual")
    exact = lambda c: F.sum(c.cast("decimal(34,10)")).cast("double")
    for _ in range(ROUNDS):
        tilt = F.exp(F.col("a") * F.col("size") / F.col("mean"))
        words = F.col("n") * F.col("size")
        sums = sizes.where("size > 0").join(state, "rank").groupBy("rank").agg(
            exact(words * F.least(tilt, F.lit(float(CAP)))).alias("got"),
            exact(F.when(tilt < CAP, words * tilt * F.col("size") / F.col("mean")).otherwise(F.lit(0.0))).alias("slope"))
        off = F.col("target") - F.col("got")
        low = F.when(off > 0, F.col("a")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("high")).otherwise(F.col("a"))
        newton = F.col("a") + F.when(F.col("slope") > 0, off / F.col("slope"))
        moved = state.join(sums, "rank").select(
            "rank", "target", "mean", "a", low.alias("low"), high.alias("high"), newton.alias("newton"),
            F.abs(off / F.col("target")).alias("error"))
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        step = F.when(F.col("error") <= CLOSE, F.col("a")).otherwise(
            F.when(inside, F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2))
        state = staged(moved.select("rank", "target", "mean", F.round(step, 12).alias("a"), "low", "high", "error"), "dual")
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst <= CLOSE:
            break
    return sources.join(state.select("rank", "mean", "a"), "rank", "left")


def _round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies of documents, sorted by bucket and falling size; of ``n`` equal ones some get a copy more than the others."""
    bucket, carried = None, 0.0
    for batch in batches:
        names = batch.schema.names
        codes = list(zip(batch.column(names.index("rank")).to_pylist(), batch.column(names.index("bucket")).to_pylist()))
        sizes, rates = batch.column(names.index("size")).to_pylist(), batch.column(names.index("rate")).to_pylist()
        many = batch.column(names.index("n")).to_pylist()
        at, copies, times = [], [], []
        for i, (code, size, rate, n) in enumerate(zip(codes, sizes, rates, many)):
            if code != bucket:
                bucket, carried = code, 0.0
            base, more = 1, 0
            if size:
                want = rate * size * n + carried
                taken = min(CAP * n, max(0, math.floor(want / size + 0.5)))
                carried = want - taken * size
                base, more = divmod(taken, n)
            for c, t in ((base, n - more), (base + 1, more)):
                if t:
                    at.append(i), copies.append(c), times.append(t)
        at = pa.array(at, pa.int64())
        keep = [batch.column(names.index(c)).take(at) for c in ("doc_id", "size", "source_size", "target", "rate")]
        yield pa.RecordBatch.from_arrays(
            [*keep, pa.array(copies, pa.int64()), pa.array(times, pa.int64())],
            ["doc_id", "size", "source_size", "target", "rate", "copies", "times"])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document: id, size, its source's size and target, copies, and words taken."""
    ship(docs.sparkSession)
    sized = staged(docs.select(
        docs[f"`{key}`"].cast("bigint").alias("doc_id"), docs[f"`{source}`"].cast("string").alias("source"),
        word_count(docs[f"`{text}`"]).alias("size")), "sized")
    counts = staged(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    per_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    aimed = staged(targets(ranked(per_source, "source")), "targets")
    same = lambda d: d["source"].eqNullSafe(aimed["source"])
    by_rank = counts.join(aimed, same(counts)).select("rank", "size", "n")
    solved = staged(solve(staged(by_rank, "by-rank"), aimed), "solved")
    rate = F.when(F.col("a").isNull(), F.lit(float(CAP))).otherwise(
        F.least(F.lit(float(CAP)), F.round(F.exp(F.col("a") * F.col("size") / F.col("mean")), 9)))
    bucket = F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("docs") / BUCKET)).alias("bucket")
    entries = sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    rows = entries.join(solved, entries["source"].eqNullSafe(solved["source"])).select(
        "rank", bucket, entries["doc_id"], entries["size"], entries["n"], "source_size", "target", rate.alias("rate"))
    schema = "doc_id bigint, size bigint, source_size bigint, target double, rate double, copies bigint, times bigint"
    rounded = staged(rows.repartition("rank", "bucket").sortWithinPartitions(
        "rank", "bucket", F.desc("size"), "doc_id").mapInArrow(_round, schema), "rounded")
    parts = F.sequence(F.lit(0), F.floor((F.col("times") - 1) / WRITTEN))
    long = rounded.where(F.col("times") > WRITTEN).withColumn("part", F.explode(parts)).withColumn(
        "times", F.least(F.lit(WRITTEN), F.col("times") - F.col("part") * WRITTEN)).repartition("doc_id", "size", "part").drop("part")
    each = F.explode(F.sequence(F.lit(1), F.col("times")))
    written = rounded.where(F.col("times") <= WRITTEN).unionByName(long).withColumn("each", each)
    return written.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
