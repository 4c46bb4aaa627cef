"""Hard negatives: rows of another label that score just below an anchor's positives.

Codes. A vector of integers ``v`` is turned by a fixed random rotation; the signs of the turned
numbers are its one-bit code ``c`` (a unit vector of equal parts). Stored with the code are its
*alignment* ``along = <c, v>`` and the length ``rest`` of what the code leaves, ``v - along * c``,
which stands at right angles to ``c``. So for an anchor ``a``

    <a, v> = along * <a, c> + <a - <a, c> c, v - along * c>,

and by Cauchy and Schwarz the second term is at most ``rest * sqrt(|a|^2 - <a, c>^2)`` either way. The anchor
is turned as well and written as `PLANES` bit planes, so ``<a, c>`` is a weighted sum of popcounts; what the planes round
off is bounded and widens the interval, as does `SLACK` for floating point. An
interval therefore always holds the score. Only rows whose interval reaches what is asked for are
scored, in integers; the result is exact.

Work. The anchors are a stated set; they go to all tasks in blocks of a bounded number of bytes (`BLOCK_BYTES`), and
every task holds its rows against a block: for each anchor the best rows of its label, then, once those are
known, for each positive the best rows of other labels in its window. A task sends at most as many rows for an anchor
as the result may hold, so a label or a vector that a third of all rows share changes nothing, and no pairs are written.

A vector that is NULL, or has a NULL or non-finite number, takes no part, nor does a row with a NULL label. A vector whose
integers have a squared length of 2^62 or more takes no part, as its scores may leave 64 bits. Vectors of
different lengths are filled up with zeros; an empty vector scores 0. Equal ids are rows of their own: each is
an anchor of its own and no row is its own positive. Ties go to the smaller id, a NULL id last; a NULL id
keeps its label and is no anchor. An anchor without positives, or a positive without rows in its window, gives no row
(a window is empty below a score of 0). Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import ship, sliced, staged, table, work_dir

#: Every `ANCHORS`-th id is an anchor; rows wanted of each kind; window in hundredths of the positive's score.
ANCHORS, POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 100, 5, 5, 80, 100, 256
#: Bit planes of an anchor; relative slack for floating point; bytes of a block of anchors; rows and anchors held together.
PLANES, SLACK, BLOCK_BYTES, ROWS, TOGETHER = 8, 1e-9, 8 << 20, 4_096, 64
#: Squared length from which 64 bits do not hold every score; sums up to which doubles are exact; a share of 1 / `DENSE` is dense.
TOO_LONG, EXACT, DENSE = 2.0**62, 2.0**52, 8

_CODED = "id bigint, label int, place bigint, vector binary, code binary, along double, rest double, size double"
_FOUND = "anchor bigint, label int, id bigint, place bigint, score bigint"
_MINED_OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
_MINED = "anchor bigint, positive bigint, id bigint, place bigint, score bigint"


def rotation(size: int, seed: int = 12) -> np.ndarray:
    """A fixed random rotation of ``size`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed + size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def integers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each number; NULL where a vector takes no part."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < 2.0**40))
    length = F.aggregate(whole, F.lit(0.0), lambda a, x: a + x * x)
    return F.when(vector.isNotNull() & F.coalesce(fine, F.lit(False)) & (length < TOO_LONG), F.transform(whole, lambda x: x.cast("bigint")))


def _coder(size: int, turn: np.ndarray) -> Callable:
    """A task's step from integer vectors to codes."""
    width = -(-size // 64) * 8  # bytes of a code, in whole machine words

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, ROWS):
            vectors = np.zeros((batch.num_rows, size), dtype=np.int64)
            lists = batch.column(3)
            lengths = np.asarray(lists.value_lengths())
            vectors[np.arange(size)[None, :] < lengths[:, None]] = np.asarray(lists.flatten())
            turned = vectors.astype(np.float64) @ turn
            along = np.abs(turned).sum(axis=1) / np.sqrt(size)
            squared = np.square(turned).sum(axis=1)
            rest = np.sqrt(np.maximum(squared - along * along, 0.0))
            bits = np.zeros((batch.num_rows, width), dtype=np.uint8)
            packed = np.packbits(turned > 0, axis=1)
            bits[:, : packed.shape[1]] = packed
            # 1e-6 of the length covers what rounding may take from the square root of a difference
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([b.tobytes() for b in bits], pa.binary()),
                 pa.array(along), pa.array(rest + 1e-6 * np.sqrt(squared)), pa.array(np.sqrt(squared))],
                [f.split()[0] for f in _CODED.split(", ")])

    return work


def coded(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", turned_label: Callable | None = None) -> DataFrame:
    """Integer vectors with codes and alignments, written to the shared folder; ``place`` numbers the rows."""
    ship(rows.sparkSession)
    wanted = F.col("label") if turned_label is None else turned_label(F.col("id"), F.col("label"))
    whole = rows.select(
        rows[f"`{key}`"].cast("bigint").alias("id"), rows[f"`{label}`"].cast("int").alias("label"), integers(rows[f"`{vector}`"]).alias("vector"))
    whole = staged(whole.where("label IS NOT NULL AND vector IS NOT NULL").select(
        "id", wanted.alias("label"), F.monotonically_increasing_id().alias("place"), "vector"), "integers")
    size = max(whole.agg(F.max(F.size("vector"))).first()[0] or 0, 1)
    return staged(whole.mapInArrow(_coder(size, rotation(size)), _CODED), "codes")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Equal-length byte strings as the rows of a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), -1) if values else np.zeros((0, 0), dtype=kind)


class Block:
    """Anchors with their bit planes."""

    def __init__(self, rows: list):
        self.id = np.array([r["id"] for r in rows], dtype=np.int64)
        self.place = np.array([r["place"] for r in rows], dtype=np.int64)
        self.label = np.array([r["label"] for r in rows], dtype=np.int64)
        self.vector = np.stack([np.frombuffer(bytes(r["vector"]), dtype=np.int64) for r in rows])
        self.size = np.array([r["size"] for r in rows])
        dims, width = self.vector.shape[1], len(bytes(rows[0]["code"]))
        turned = self.vector.astype(np.float64) @ rotation(dims)
        self.least = turned.min(axis=1, initial=0.0)
        self.step = np.maximum(turned.max(axis=1, initial=0.0) - self.least, 1e-30) / ((1 << PLANES) - 1)
        level = np.rint((turned - self.least[:, None]) / self.step[:, None]).astype(np.int64)
        back = self.least[:, None] + level * self.step[:, None]
        #: what the planes may err in <a, c>: length of the rounding, as the code is a unit vector
        self.error = np.sqrt(np.square(turned - back).sum(axis=1)) + SLACK * self.size
        self.planes = np.zeros((PLANES, len(rows), width), dtype=np.uint8)
        for p in range(PLANES):
            packed = np.packbits((level >> p) & 1 == 1, axis=1)
            self.planes[p, :, : packed.shape[1]] = packed
        self.planes = self.planes.view(np.uint64)
        self.levels = level.sum(axis=1)
        self.dims, self.root = dims, np.sqrt(dims)

    def intervals(self, at: slice, codes: np.ndarray, along: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of all rows (by codes) with the anchors ``at``."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        weighed = np.zeros((self.levels[at].shape[0], len(codes)), dtype=np.float64)
        for p in range(PLANES):
            common = np.zeros(weighed.shape, dtype=np.int32)
            for w in range(codes.shape[1]):
                common += np.bitwise_count(self.planes[p, at, w][:, None] & codes[None, :, w])
            weighed += common * float(1 << p)
        # sum of a_i c_i: parts with their bit set count as they are, the others turned round
        level = self.step[at, None] * (2 * weighed - self.levels[at, None])
        product = (level + self.least[at, None] * (2 * ones - self.dims)[None, :]) / self.root
        error = self.error[at, None]
        inner = np.maximum(np.abs(product) - error, 0.0)
        reach = rest[None, :] * np.sqrt(np.maximum(np.square(self.size[at, None]) * (1 + SLACK) - inner * inner, 0.0))
        reach += error * along[None, :] + SLACK * self.size[at, None] * (along + rest)[None, :]
        middle = product * along[None, :]
        return middle - reach, middle + reach

    def scores(self, anchors: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Integer scores of (anchor, row) pairs.

        Where most pairs of some anchors and rows are wanted, one product of matrices has them all, in doubles as long as
        these add the integers up exactly.
        """
        some, a = np.unique(anchors, return_inverse=True)
        if len(anchors) * DENSE > len(some) * len(vectors):
            left, right = self.vector[some].astype(np.float64), vectors.astype(np.float64)
            if np.sqrt(np.square(left).sum(axis=1).max() * np.square(right).sum(axis=1).max()) < EXACT:
                return (left @ right.T)[a, rows].astype(np.int64)
        out = np.empty(len(anchors), dtype=np.int64)
        for low in range(0, len(anchors), 1 << 16):
            a, r = anchors[low : low + (1 << 16)], rows[low : low + (1 << 16)]
            out[low : low + (1 << 16)] = np.einsum("ij,ij->i", self.vector[a], vectors[r])
        return out


class _Rows:
    """Rows of a slice of a task."""

    def __init__(self, batch: pa.RecordBatch):
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        self.null, self.id = np.asarray(column["id"].is_null()).astype(np.int64), np.asarray(column["id"].fill_null(0))
        self.label, self.place = np.asarray(column["label"]).astype(np.int64), np.asarray(column["place"])
        self.vector, self.code = _matrix(column["vector"], np.int64), _matrix(column["code"], np.uint64)
        self.along, self.rest = np.asarray(column["along"]), np.asarray(column["rest"])


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th largest of each row; minus infinity where there are fewer."""
    return np.partition(values, -k, axis=1)[:, -k] if values.shape[1] >= k else np.full(len(values), -np.inf)


class _Best:
    """The best rows so far of each of some lists, ``k`` of each at most, and the score that a row must reach."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.floor = np.full(lists, -np.inf)
        self.rows = np.zeros((0, 5), dtype=np.int64)  # list, score, whether the id is NULL, id, place

    def add(self, lists: np.ndarray, score: np.ndarray, rows: _Rows, which: np.ndarray) -> None:
        new = np.stack([lists, score, rows.null[which], rows.id[which], rows.place[which]], axis=1)
        rows = np.concatenate([self.rows, new])
        rows = rows[np.lexsort((rows[:, 4], rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        rank = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0])
        self.rows, rank = rows[rank < self.k], rank[rank < self.k]
        last = self.rows[rank == self.k - 1]
        self.floor[last[:, 0]] = last[:, 1]


def _positives(block: Block) -> Callable:
    """A task's best rows of each anchor's label."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(block.id), POSITIVES)
        for batch in sliced(batches, ROWS):
            rows = _Rows(batch)
            for low in range(0, len(block.id), TOGETHER):
                at = slice(low, low + TOGETHER)
                mine = (block.label[at, None] == rows.label[None, :]) & (block.place[at, None] != rows.place[None, :])
                least, most = block.intervals(at, rows.code, rows.along, rows.rest)
                floor = np.maximum(best.floor[at], _kth(np.where(mine, least, -np.inf), POSITIVES))
                a, r = np.nonzero(mine & (most >= floor[:, None]))
                a += low
                best.add(a, block.scores(a, r, rows.vector), rows, r)
        yield _batch(block, best.rows[:, 0], [block.label[best.rows[:, 0]].astype(np.int32)], best.rows, _FOUND)

    return work


def _batch(block: Block, anchors: np.ndarray, more: list, rows: np.ndarray, schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(block.place[anchors]), *map(pa.array, more), pa.array(rows[:, 3], mask=rows[:, 2] > 0), pa.array(rows[:, 4]), pa.array(rows[:, 1])],
        [f.split()[0] for f in schema.split(", ")])


def _negatives(block: Block, anchor: np.ndarray, score: list[int]) -> Callable:
    """A task's best rows of other labels in the window of each positive (its anchor's number and score)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(anchor), NEGATIVES)
        # whole numbers s with LOW * score <= 100 * s <= HIGH * score
        bottom = np.array([-(-LOW * s // 100) for s in score], dtype=np.int64)
        top = np.array([HIGH * s // 100 for s in score], dtype=np.int64)
        for batch in sliced(batches, ROWS):
            rows = _Rows(batch)
            for low in range(0, len(anchor), TOGETHER):
                lists = slice(low, low + TOGETHER)
                used, mine = np.unique(anchor[lists], return_inverse=True)
                other = block.label[used, None] != rows.label[None, :]
                least, most = block.intervals(used, rows.code, rows.along, rows.rest)
                least, most = np.where(other, least, np.inf)[mine], np.where(other, most, -np.inf)[mine]
                sure = other[mine] & (least >= bottom[lists, None]) & (most <= top[lists, None])
                floor = np.maximum(np.maximum(best.floor[lists], bottom[lists]), _kth(np.where(sure, least, -np.inf), NEGATIVES))
                p, r = np.nonzero((most >= floor[:, None]) & (least <= top[lists, None]))
                p += low
                # a row may be open for several positives of one anchor: it is scored once
                pairs, which = np.unique(anchor[p] * len(rows.id) + r, return_inverse=True)
                found = block.scores(pairs // len(rows.id), pairs % len(rows.id), rows.vector)[which] if len(pairs) else np.zeros(0, np.int64)
                inside = (found >= bottom[p]) & (found <= top[p])
                p, r, found = p[inside], r[inside], found[inside]
                best.add(p, found, rows, r)
        yield _batch(block, anchor[best.rows[:, 0]], [best.rows[:, 0]], best.rows, _MINED)

    return work


def _best_of(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each list, over all tasks."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "place")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def blocks_of(anchors: DataFrame) -> Iterator[list]:
    """The anchors in blocks of at most `BLOCK_BYTES`; only one block is on the driver at a time."""
    facts = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("vector") + F.octet_length("code") * PLANES + 64).alias("bytes")).first()
    if not facts["n"]:
        return
    number = -(-facts["n"] * facts["bytes"] // BLOCK_BYTES)
    # dealt by a hash, unevenly: what comes out longer than a block is cut again
    path = work_dir(anchors.sparkSession, "anchors")
    anchors.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(number))).repartition("block").write.partitionBy("block").parquet(path)
    dealt = anchors.sparkSession.read.parquet(path)
    most = max(1, BLOCK_BYTES // facts["bytes"])
    for b in range(number):
        last = None
        while True:
            rows = dealt.where(F.col("block") == b)
            rows = rows if last is None else rows.where(F.col("place") > last)
            part = rows.orderBy("place").limit(most).collect()
            if part:
                yield part
            if len(part) < most:
                break
            last = part[-1]["place"]


def mine(codes: DataFrame, anchors: DataFrame) -> DataFrame:
    """For each anchor and positive the best rows of other labels in the positive's window.

    ``codes`` is what `coded` returns, ``anchors`` some of its rows.
    """
    spark = codes.sparkSession
    path = work_dir(spark, "negatives")
    spark.createDataFrame([], _MINED_OUT).write.parquet(path)
    for rows in blocks_of(anchors):
        block = Block(rows)
        number = {int(p): i for i, p in enumerate(block.place)}
        found = _best_of(codes.mapInArrow(_positives(block), _FOUND), ["anchor"], POSITIVES)
        # at most POSITIVES rows for each anchor of the block
        positives = sorted(found.collect(), key=lambda r: (number[r["anchor"]], r["rank"]))
        if not positives:
            continue
        anchor = np.array([number[r["anchor"]] for r in positives])
        score = [r["score"] for r in positives]
        known = spark.createDataFrame(
            [(i, int(block.id[a]), r["id"], s) for i, (a, r, s) in enumerate(zip(anchor, positives, score))],
            "positive bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        mined = _best_of(codes.mapInArrow(_negatives(block, anchor, score), _MINED), ["positive"], NEGATIVES)
        mined.join(known, "positive").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
    return spark.read.schema(_MINED_OUT).parquet(path)


def _next_label(id_: Column, label: Column) -> Column:
    """The label of a row whose id 7 divides is the next one of ten."""
    return F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = coded(table(spark, sf_dir, "embeddings"), turned_label=_next_label)
    return mine(codes, codes.where(F.col("id") % ANCHORS == 0))


ORACLE = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS id, b.label,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND s.label <> p.anchor_label
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
