"""Near-duplicate join: Jaccard similarity of word 5-grams, by banded MinHash and exact checks.

Rows and bands are chosen for a target recall at the threshold. Texts of equal n-gram
sets are one node. Nodes meet on band hashes. A pair is looked at in the first band that
it shares only: in a small bucket as a pair of ids, whose n-gram sets are then joined and
intersected; in a large bucket block against block, where a task counts intersections of
two blocks at once and returns one row per node, not per pair. So no pair of a large group is
lost or written, and no bucket is gathered in one task. Links weigh the copies of a node.

Result: per document the class (least id of all that are linked directly or through others), the
class's size, and how many other documents it is linked to. Words are lower-cased and separated by white
space; a text of one to four words is one shingle; NULL and empty texts have none and are
linked to nothing, not even to each other. NULL ids are kept: a class of only such rows has a NULL id.
Repeated rows are copies. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import LOCATOR, freed, located, plain_scan, rows_in, sliced, staged, table, without_rows
from .components import components
from .shingles import Words, shingles

THRESHOLD, RECALL, HASHES = 0.8, 0.999, 320
#: Buckets up to this many nodes give pairs of ids; larger ones are compared in blocks of this many nodes.
SMALL, BLOCK = 64, 256
#: Shingles that go through the hash functions at once, and columns of a block's matrix.
STRIP, COLUMNS = 1 << 17, 4096


def bands_for(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows: the most rows (fewest false candidates) whose bands reach ``recall`` within ``hashes``."""
    fit = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log1p(-recall) / math.log1p(-(threshold**rows)))
        if bands * rows > hashes:
            break
        fit = bands, rows
    if fit is None:
        raise ValueError("too few hash functions for this recall")
    return fit


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_011)
    draw = random.integers(0, 1 << 32, size=(2, count), dtype=np.uint64).astype(np.uint32)
    return draw[0], draw[1] | np.uint32(1)


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes of non-empty shingle sets."""
    mask, factor = _functions(bands * rows)
    out = np.empty((len(sets), bands * rows), dtype=np.uint32)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= STRIP):
            size += len(sets[last])
            last += 1
        strip = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[first : last - 1]])]).astype(np.int64)
        hashed = np.empty_like(strip)
        for k in range(bands * rows):
            np.bitwise_xor(strip, mask[k], out=hashed)
            np.multiply(hashed, factor[k], out=hashed)
            out[first:last, k] = np.minimum.reduceat(hashed, starts)
        first = last
    wide = out.reshape(len(sets), bands, rows).astype(np.uint64)
    banded = np.zeros((len(sets), bands), dtype=np.uint64)
    for k in range(rows):
        banded = (banded ^ (banded >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, k]
    return banded


def _text_sets(column: pa.Array, words: Words) -> list[np.ndarray]:
    return [shingles(words((t.as_py() or "").encode("utf-8", "surrogatepass"))) for t in column]


def _sketch(bands: int, rows: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in sliced(batches):
            sets = _text_sets(batch.column(0), words)
            filled = [i for i, s in enumerate(sets) if len(s)]
            hashes = signatures([sets[i] for i in filled], bands, rows).view(np.int64) if filled else []
            nodes, signed = [None] * len(sets), [None] * len(sets)
            for i, h in zip(filled, hashes):
                nodes[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                signed[i] = h
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(nodes, pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(signed, pa.list_(pa.int64()))],
                [*batch.schema.names[1:], "node", "n", "bands"])

    return task


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in sliced(batches):
        sets = _text_sets(batch.column(0), words)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
            [*batch.schema.names[1:], "grams"])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal first ``keys`` columns, over sorted batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        heads = [batch.column(i) for i in range(keys)]
        codes = list(zip(*[h.to_pylist() for h in heads]))
        start = 0
        for i, code in enumerate(codes):
            if code != key:
                if key is not None:
                    held.append(batch.slice(start, i - start))
                    yield key, pa.Table.from_batches(held)
                key, held, start = code, [], i
        held.append(batch.slice(start))
    if key is not None:
        yield key, pa.Table.from_batches(held)


def _first_shared(signed: np.ndarray, band: int) -> np.ndarray:
    """For nodes of one bucket of ``band``: pairs that share no earlier band."""
    fresh = np.ones((len(signed), len(signed)), dtype=bool)
    for k in range(band):
        fresh &= signed[:, k][:, None] != signed[:, k][None, :]
    return fresh


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _small_pairs(threshold: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (band, _), rows in _groups(batches, 2):
            nodes, n = rows.column("node").to_pylist(), rows.column("n").to_numpy()
            take = np.triu(_first_shared(_matrix(rows, "bands"), band), 1)
            take &= np.minimum.outer(n, n) >= threshold * np.maximum.outer(n, n) - 1e-9
            left, right = np.nonzero(take)
            if len(left):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[i] for i in left], pa.binary()), pa.array([nodes[i] for i in right], pa.binary())],
                    ["a", "b"])

    return task


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of strips of the incidence matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1
    order = np.cumsum(held > 1) - 1
    owner, column = owner[shared], order[column[shared]]
    out = np.zeros((len(sets), len(sets)))
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    width = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        strip = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        strip[owner[a:b], column[a:b] - low] = 1
        out += strip @ strip.T
    return out


def _block_links(threshold: float):
    """Links between (or within) blocks: a row per node with its linked documents and its root."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (band, _, one, other), rows in _groups(batches, 4):
            nodes, copies = rows.column("node").to_pylist(), rows.column("copies").to_numpy()
            block = rows.column("block").to_numpy()
            sets = [np.asarray(s.as_py(), dtype=np.int64) for s in rows.column("grams")]
            sizes = np.array([len(s) for s in sets])
            overlap = _overlaps(sets)
            linked = _first_shared(_matrix(rows, "bands"), band)
            linked &= overlap * (1 + threshold) >= threshold * np.add.outer(sizes, sizes) - 1e-6
            np.fill_diagonal(linked, False)
            if one != other:
                linked &= block[:, None] != block[None, :]
            found = linked @ copies
            root = np.arange(len(nodes))
            order = np.array(sorted(range(len(nodes)), key=nodes.__getitem__))
            place = np.empty(len(nodes), dtype=np.int64)
            place[order] = np.arange(len(nodes))
            root = place.copy()
            while True:  # least place among linked nodes
                reach = np.where(linked, root[None, :], len(nodes)).min(axis=1, initial=len(nodes))
                new = np.minimum(root, reach)
                if (new == root).all():
                    break
                root = new
            keep = np.flatnonzero(found)
            if len(keep):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[i] for i in keep], pa.binary()), pa.array(found[keep], pa.int64()),
                     pa.array([nodes[order[root[i]]] for i in keep], pa.binary())], ["node", "links", "root"])

    return task


def sketch(docs: DataFrame, key: str, text: str, threshold: float, recall: float) -> DataFrame:
    """Locator, id, node (digest of the n-gram set), its size and band hashes of every row; staged."""
    bands, rows = bands_for(threshold, recall, HASHES)
    kept = located(docs).select(
        F.col(f"row.`{text}`").alias("text"), *LOCATOR, F.col(f"row.`{key}`").cast("bigint").alias("id"))
    return staged(kept.mapInArrow(
        _sketch(bands, rows),
        "_file string, _row bigint, id bigint, node binary, n bigint, bands array<bigint>"), "sketch")


def node_links(docs: DataFrame, rows: DataFrame, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links of nodes to other nodes: (node, links) with repeats to be added up, and edges (u, v).

    ``rows`` is what `sketch` staged; it is removed once its nodes are written.
    """
    nodes = staged(
        rows.where("node is not null").groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"),
            F.min(F.struct(*LOCATOR)).alias("at")), "nodes")
    freed(rows)
    members = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    buckets = staged(members.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    met = staged(members.join(buckets, ["band", "hash"]), "met")
    freed(buckets)
    wide = nodes.select("node", "n", "bands", "copies")

    small = met.where(F.col("size") <= SMALL).join(wide, "node").select("band", "hash", "node", "n", "bands")
    pairs = staged(
        small.repartition("band", "hash").sortWithinPartitions("band", "hash")
        .mapInArrow(_small_pairs(threshold), "a binary, b binary"), "pairs")

    # n-gram sets of the nodes that have something to compare
    large = met.where(F.col("size") > SMALL)
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(
        large.select("node")).distinct()
    places = staged(nodes.join(asked, "node", "left_semi").select("node", "at._file", "at._row"), "asked")
    _, marked = rows_in(located(docs), places)
    sets = staged(
        marked.join(places, list(LOCATOR)).select(F.col(f"row.`{text}`").alias("text"), "node")
        .mapInArrow(_sets, "node binary, grams array<bigint>"), "sets")
    freed(places)

    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    linked = pairs.join(left, "a").join(right, "b").where(
        shared * (1 + threshold) >= threshold * (F.size("left") + F.size("right")) - 1e-6).select("a", "b")
    linked = staged(linked, "linked")
    freed(pairs)

    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    tiled = (
        large.withColumn("blocks", blocks).withColumn("block", own)
        .select("band", "hash", "node", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
        .select("band", "hash", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"), "block", "node")
    )
    tasks = tiled.join(wide.drop("n"), "node").join(sets, "node").select(
        "band", "hash", "one", "other", "block", "node", "copies", "bands", "grams")
    keys = ["band", "hash", "one", "other"]
    met_in_blocks = staged(
        tasks.repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_block_links(threshold), "node binary, links bigint, root binary"), "blocks")
    freed(met, sets)

    copies = staged(nodes.select("node", "copies"), "copies")
    freed(nodes)
    one = linked.join(copies.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), F.col("copies").alias("links"))
    two = linked.join(copies.withColumnRenamed("node", "a"), "a").select(F.col("b").alias("node"), F.col("copies").alias("links"))
    links = one.unionByName(two).unionByName(met_in_blocks.select("node", "links"))
    edges = linked.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        met_in_blocks.select(F.col("node").alias("u"), F.col("root").alias("v")))
    return links, edges


def near_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """Per row: locator, id, number of links, node and root node of its class (NULL without shingles)."""
    docs = plain_scan(docs)
    sketched = sketch(docs, key, text, threshold, recall)
    rows = staged(sketched.select(*LOCATOR, "id", "node"), "rows")  # the band hashes stay with the nodes
    links, edges = node_links(docs, sketched, text, threshold)
    counted = rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    summed = links.groupBy("node").agg(F.sum("links").alias("links"))
    per_node = counted.join(summed, "node", "left").join(components(edges), "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    return rows.select(*LOCATOR, "id", "node").join(staged(per_node, "per-node"), "node", "left")


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: id, class id, class size, number of linked documents."""
    rows = near_groups(docs, key, text, **options)
    # staged, so that the join below is a plain one that may split a large class
    classes = staged(rows.where("root is not null").groupBy("root").agg(
        F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "classes")
    return rows.join(classes, "root", "left").select(
        F.col("id").alias("doc_id"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, that with the least id (NULL last); all columns."""
    docs = plain_scan(docs)
    rows = near_groups(docs, key, text, **options).where("root is not null")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", *LOCATOR)
    stays = staged(rows.groupBy("root").agg(F.min(rank).alias("best")), "stays")
    same = (F.col("_file") == F.col("best._file")) & (F.col("_row") == F.col("best._row"))
    gone = rows.join(stays, "root").where(~same)
    return without_rows(docs, staged(gone.select(*LOCATOR), "near-dropped"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))
