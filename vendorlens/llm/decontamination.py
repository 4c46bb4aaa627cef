"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, edit distance.

Texts are sequences of words (lower case, punctuation at their edges ignored). The CGK random walk reads a window
word by word: at each step it outputs the current word and moves on if a random bit of
(step, word) says so. Windows at a small edit distance then give outputs at a small Hamming
distance, so samples of few output positions often agree; each repeat has a walk and a
sample of its own. The number of repeats is the least one that reaches the target recall on many random edit patterns
of the items with as many edits as a match may have; where it would be too large, windows are halved. Items are cut into windows at every word, documents at every few
words; the window size follows the item's size (half to a quarter of its words, or less for the recall), so a leaked passage
covers several document windows. A collision is verified: the edit distance of the whole item to
the best-fitting passage around the window must be at most `EDITS` of the item's words.

The benchmark is taken in blocks of bounded size, each sent to the tasks; documents are not
shuffled, and no group of documents meets in one place.

NULL and empty documents and items match nothing. Items of less than five words match only unedited.
Equal items are each reported. Repeated documents give repeated rows; NULL ids are kept. Empty tables
give empty results; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import ship, sliced, table

#: Most edits of a match, as a share of the item's words; the recall of items with that many edits.
EDITS, RECALL = 0.2, 0.95
#: Output positions in a sample; most repeats before windows are halved; words in a block of items; words handled at once.
SAMPLE, REPEATS, BLOCK_WORDS, STRIP = 5, 24, 200_000, 1 << 18
#: Random edit patterns that the recall of a window size is measured on: least for each item, and least in all.
PATTERNS = (4, 200)
#: Words whose hashes a task remembers before it forgets them all.
REMEMBERED = 200_000

_EDGES = re.compile(r"^\W+|\W+$")
_MIX = np.uint64(0xFF51AFD7ED558CCD)


class Normal:
    """Hashes of words; 0 for those without a letter or digit."""

    def __init__(self):
        self._known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words, known = text.lower().split(), self._known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            bare = _EDGES.sub("", w)
            known[w] = (xxhash.xxh64_intdigest(bare) | 1) if bare else 0
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def window_size(words: int) -> int:
    """Words of a window for an item: the power of two in (words/4, words/2], at least 1."""
    return 1 << max(0, words.bit_length() - 2)


def keys(words: np.ndarray, starts: np.ndarray, size: int, repeat: int) -> np.ndarray:
    """Sampled CGK outputs of the windows at ``starts``; ``words`` has ``2 * size`` zeros at its end."""
    steps = max(1, size * 3 // 2)
    random = np.random.default_rng((size, repeat))
    sample = set(random.choice(steps, size=min(SAMPLE, steps), replace=False).tolist())
    at, out = starts.copy(), np.zeros(len(starts), dtype=np.uint64)
    for step in range(max(sample) + 1):
        if step % 64 == 0:
            seed = random.integers(1, 1 << 63, dtype=np.uint64)
            mixed = (words ^ seed) * _MIX
            mixed ^= mixed >> np.uint64(32)
            mixed *= _MIX
            mixed ^= mixed >> np.uint64(29)
        here = mixed[at]
        if step in sample:
            out ^= here
            out *= _MIX
            out ^= out >> np.uint64(31)
        here >>= np.uint64(step % 64)
        at += (here & np.uint64(1)).astype(np.int64)
    return out


def edit_distance(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a passage of ``text`` and the passage's (first) end."""
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    plus, minus, score = full, 0, len(pattern)
    best, end = score, 0
    for j, w in enumerate(text):
        same = masks.get(w, 0)
        up = same | minus
        across = ((((same & plus) + plus) ^ plus) | same) & full
        gain, loss = minus | (full & ~(across | plus)), plus & across
        score += 1 if gain & top else -1 if loss & top else 0
        gain, loss = (gain << 1) & full, (loss << 1) & full
        plus, minus = loss | (full & ~(up | gain)), gain & up
        if score < best:
            best, end = score, j + 1
    return best, end


class Index:
    """Window keys of a block of items."""

    def __init__(self, items: list[tuple], edits: float = EDITS, recall: float = RECALL):
        normal = Normal()
        self.edits = edits
        self.items = []
        for item_id, text in items:
            words = normal(text or "")
            words = words[words != 0]
            if len(words):
                self.items.append((item_id, words))
        self.classes: dict[int, list[int]] = {}
        for i, (_, words) in enumerate(self.items):
            self.classes.setdefault(window_size(len(words)), []).append(i)
        # windows of a class may end up as short as those of another
        plans: dict[int, list[tuple[int, list[int]]]] = {}
        for members in self.classes.values():
            size, repeats = self._plan(members, recall)
            plans.setdefault(size, []).append((repeats, members))
        self.tables = {
            size: [self._entry(size, [i for n, members in parts if repeat < n for i in members], repeat) for repeat in range(max(parts)[0])]
            for size, parts in plans.items()}

    def _windows(self, sequences: list[np.ndarray], size: int, stride: int = 1) -> tuple[np.ndarray, ...]:
        """Sequences with gaps of zeros, starts of windows, and the sequence and offset of each."""
        gap = np.zeros(2 * size, dtype=np.uint64)
        words = np.concatenate([x for s in sequences for x in (s, gap)]) if sequences else gap
        starts, owner, offset, at = [], [], [], 0
        for i, s in enumerate(sequences):
            o = np.arange(0, max(1, len(s) - size + 1), stride) if len(s) else np.zeros(0, np.int64)
            starts.append(at + o), owner.append(np.full(len(o), i)), offset.append(o)
            at += len(s) + len(gap)
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        return words, join(starts), join(owner), join(offset)

    def _entry(self, size: int, members: list[int], repeat: int) -> tuple:
        """Sorted keys, their items, their offsets and a bitmap of their low bits."""
        words, starts, owner, offset = self._windows([self.items[i][1] for i in members], size)
        own = keys(words, starts, size, repeat)
        order = np.argsort(own, kind="stable")
        bitmap = np.zeros(1 << 16, dtype=bool)
        bitmap[own & np.uint64(0xFFFF)] = True
        return own[order], np.array(members)[owner[order]], offset[order], bitmap

    def _plan(self, members: list[int], recall: float) -> tuple[int, int]:
        """Window size and repeats that find ``recall`` of the items with as many random edits as a match may have.

        Measured on many edit patterns of each item, all of them in every repeat; the lower bound of the measured share counts.
        Where `REPEATS` do not reach it, windows are halved; windows of one word find whatever shares a word.
        """
        size, random = window_size(len(self.items[members[0]][1])), np.random.default_rng(members[0])
        owners = [i for i in members for _ in range(max(PATTERNS[0], -(-PATTERNS[1] // len(members))))]
        slack = np.array([int(self.edits * len(self.items[i][1])) for i in owners])
        patterns = [_edited(self.items[i][1], n, random) for i, n in zip(owners, slack.tolist())]
        while True:
            words, starts, owner, offset = self._windows(patterns, size, stride(size))
            found = np.zeros(len(owners), dtype=bool)
            for repeat in range(REPEATS):
                for w, at, item, _ in _collisions(self._entry(size, members, repeat), keys(words, starts, size, repeat)):
                    n = owner[w]
                    found[n] |= item == owners[n] and abs(int(offset[w]) - at) <= slack[n]
                share = found.mean()
                if share - 1.64 * (share * (1 - share) / len(found)) ** 0.5 >= recall:
                    return size, repeat + 1
            if size == 1:
                return size, REPEATS
            size //= 2

    def search(self, documents: list[np.ndarray]) -> list[dict[int, tuple[int, int, int]]]:
        """Per document: item number -> (distance, first word, end) of its best passage."""
        out: list[dict] = [{} for _ in documents]
        tried: set[tuple[int, int, int]] = set()
        for size, tables in self.tables.items():
            words, starts, owner, offset = self._windows(documents, size, stride(size))
            for low in range(0, len(starts), STRIP):
                part = starts[low : low + STRIP]
                shift = int(part[0])
                near = words[shift : int(part[-1]) + 2 * size]
                for repeat, entry in enumerate(tables):
                    for w, at, item, _ in _collisions(entry, keys(near, part - shift, size, repeat)):
                        doc = int(owner[low + w])
                        self._verify(documents[doc], int(offset[low + w]) - at, item, out[doc], tried, doc)
        return out

    def _verify(self, words: np.ndarray, start: int, item: int, found: dict, tried: set, doc: int) -> None:
        pattern = self.items[item][1].tolist()
        slack = int(self.edits * len(pattern))
        place = (doc, item, start // max(1, slack))
        if place in tried:
            return
        tried.add(place)
        low = max(0, start - 2 * slack - 1)
        region = words[low : max(0, start) + len(pattern) + 2 * slack + 1].tolist()
        distance, end = edit_distance(pattern, region)
        if distance > slack:
            return
        _, length = edit_distance(pattern[::-1], region[:end][::-1])
        match = (distance, low + end - length, low + end)
        if item not in found or match < found[item]:
            found[item] = match


def stride(size: int) -> int:
    """Words between windows of a document: an item's windows start at more than ``size`` words in a row."""
    return max(1, size // 2)


def _edited(words: np.ndarray, count: int, random: np.random.Generator) -> np.ndarray:
    out = words.tolist()
    for _ in range(count):
        at, kind, new = int(random.integers(len(out))), int(random.integers(3)), int(random.integers(1 << 62)) | 1
        out[at : at + (kind != 1)] = [] if kind == 2 and len(out) > 1 else [new]
    return np.array(out, dtype=np.uint64)


def _collisions(entry: tuple, found: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(window, offset in the item, item, place in the table) of equal keys."""
    known, item, offset, bitmap = entry
    near = np.flatnonzero(bitmap[found & np.uint64(0xFFFF)])
    low, high = np.searchsorted(known, found[near]), np.searchsorted(known, found[near], side="right")
    for w, a, b in zip(near[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
        for k in range(a, b):
            yield w, int(offset[k]), int(item[k]), k


def blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size; one block at a time is in the driver."""
    held, words = [], 0
    for row in benchmark.select(F.col(f"`{item}`"), F.col(f"`{text}`")).toLocalIterator():
        size = len((row[1] or "").split())
        if held and words + size > BLOCK_WORDS:
            yield held
            held, words = [], 0
        held.append((row[0], row[1]))
        words += size
    if held:
        yield held


def _documents(texts: list[str], normal: Normal) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Words of each text without empty ones, and the numbers of those kept among all its tokens."""
    words, places = [], []
    for t in texts:
        all_words = normal(t)
        kept = np.flatnonzero(all_words)
        words.append(all_words[kept]), places.append(kept)
    return words, places


def _strips(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > 8 * STRIP:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
         item_text: str = "text", edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """A row per contaminated document and item: ids, word edits, item's words, code-point range of the passage."""
    spark = docs.sparkSession
    ship(spark)
    kept = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{key}`").alias("doc_id"))
    kind = benchmark.select(F.col(f"`{item}`")).schema[0].dataType.simpleString()
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, item_id {kind}, distance int, item_words int, start int, end int"
    out = spark.createDataFrame([], schema)
    items = to_arrow_type(benchmark.select(F.col(f"`{item}`")).schema[0].dataType)
    for block in blocks(benchmark, item, item_text):
        out = out.unionByName(kept.mapInArrow(_find_task(spark.sparkContext.broadcast(Index(block, edits, recall)), items), schema))
    return out


def _find_task(shared, items: pa.DataType):
    def task(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, normal = shared.value, Normal()
        for batch in sliced(batches_in):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            rows = []
            for low, high in _strips(texts):
                words, places = _documents(texts[low:high], normal)
                for i, found in enumerate(index.search(words)):
                    if found:
                        ends = [m.span() for m in re.finditer(r"\S+", texts[low + i])]
                        for n, (distance, first, end) in sorted(found.items()):
                            a, b = places[i][first], places[i][max(first, end - 1)]
                            rows.append((low + i, index.items[n][0], distance, len(index.items[n][1]), ends[a][0], ends[b][1]))
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], items),
                 *[pa.array(c, pa.int32()) for c in columns[2:]]],
                ["doc_id", "item_id", "distance", "item_words", "start", "end"])

    return task


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                      item_text: str = "text", edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """``docs`` without those that hold an item of the benchmark; all columns."""
    spark, at = docs.sparkSession, docs.columns.index(text)
    ship(spark)
    out = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    for block in blocks(benchmark, item, item_text):
        shared = spark.sparkContext.broadcast(Index(block, edits, recall))

        def task(batches_in: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, normal = shared.value, Normal()
            for batch in sliced(batches_in):
                texts = [t or "" for t in batch.column(at).to_pylist()]
                clean = []
                for low, high in _strips(texts):
                    clean += [not found for found in index.search(_documents(texts[low:high], normal)[0])]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(task, out.schema)
    return out.toDF(*docs.columns)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
