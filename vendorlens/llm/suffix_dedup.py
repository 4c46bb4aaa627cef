"""Passages of `LENGTH` words or more that repeat across documents, by sparse suffix arrays.

Suffixes are retained only at minimisers: of every `LENGTH` words, the start of the `GRAM` words in a row
with the least hash. Equal passages have equal minimisers at equal places, so each repeated
passage holds a retained suffix in both copies. Suffixes whose first words only one document has are
dropped (through a bitmap of fixed size, which lets a few too many pass and none too few). The others are sorted
with their words to the right, neighbours of different documents are compared, and the match is
extended word by word right and left; `LENGTH` words in all are a repeat. A second sort, by the words to
the left, finds the neighbours that share most on that side. Where the two sides together would allow a repeat that no single
neighbour has, the windows in question are compared by digest, so none is missed. Sorting is by ranges over words, document and place, so
suffixes of a passage that a third of all documents share lie in many tasks, each of which holds
one document's run of suffixes. A run at the end of a task meets the nearest suffix of another document, however
many tasks away: a few rows for each task say which one. Overlapping
repeats of a document are joined to spans.

A match reaches `LENGTH` words to the right of a minimiser and to the last possible start on its left;
longer repeats are covered by their further minimisers. Words are what white space separates, compared exactly. NULL, empty and
short texts have no spans. Repeats within one document alone are not reported; repeated rows are
documents that repeat each other. NULL ids are kept. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import freed, located, plain_scan, rows_in, sliced, staged, table, work_dir
from .shingles import Words

#: Words of a repeat, and of the sequences whose hashes choose the suffixes.
LENGTH, GRAM = 50, 20
#: Words whose minimisers are found at once; rows that a task gathers before it passes them on.
STRIP, ROWS = 1 << 20, 10_000
ROW = ("k1", "k2")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def minimisers(words: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the sequences of ``gram`` words that are least in some ``length`` words in a row."""
    if len(words) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    count = len(words) - gram + 1
    hashes = np.zeros(count, dtype=np.uint64)
    for k in range(gram):
        hashes = (hashes ^ (hashes >> np.uint64(29))) * _MIX + words[k : k + count]
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIX
    # low bits hold the place, so that the first of equal sequences is the least
    bits = np.uint64(max(1, int(count).bit_length()))
    ranked = (hashes >> bits << bits) | np.arange(count, dtype=np.uint64)
    width, have, least = length - gram + 1, 1, ranked
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    places = np.unique(least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return places, hashes[places]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _anchors(length: int, gram: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in sliced(batches):
            owner, places, hashes = [], [], []
            for i, text in enumerate(batch.column(0)):
                p, h = minimisers(words((text.as_py() or "").encode("utf-8", "surrogatepass")), length, gram)
                owner.append(np.full(len(p), i)), places.append(p), hashes.append(h)
            owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(owner, pa.int64())), batch.column(2).take(pa.array(owner, pa.int64())),
                 pa.array(np.concatenate(places) if places else [], pa.int64()),
                 pa.array((np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)).view(np.int64), pa.int64())],
                ["k1", "k2", "place", "h"])

    return task


def _contexts(length: int, gram: int):
    """A row per retained suffix: the words from it on, and the words before it, nearest first."""
    names = ["h", "right", "left", "k1", "k2", "place", "doc_id"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, owner = [], []

            def out() -> pa.RecordBatch:
                columns = list(zip(*rows)) if rows else [[]] * 6
                found = pa.RecordBatch.from_arrays(
                    [*[pa.array(c, k) for c, k in zip(columns, kinds)], batch.column(5).take(pa.array(owner, pa.int64()))], names)
                rows.clear(), owner.clear()
                return found

            text, k1, k2, places, hashes = (batch.column(i) for i in range(5))
            for i in range(batch.num_rows):
                words = _words(text[i].as_py())
                for place, h in zip(places[i].as_py(), hashes[i].as_py()):
                    before = words[max(0, place - (length - gram)) : place]
                    rows.append((h, b" ".join(words[place : place + length]), b" ".join(before[::-1]), k1[i].as_py(), k2[i].as_py(), place))
                    owner.append(i)
                    if len(rows) >= ROWS:
                        yield out()
            yield out()

    return task


def _shared(a: bytes, b: bytes) -> int:
    """Leading words that two texts of words with one space between them share."""
    if a == b:
        return a.count(b" ") + 1 if a else 0
    low, high = 0, min(len(a), len(b))
    while low < high:  # bytes that agree
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    whole = low > 0 and a[low : low + 1] in (b"", b" ") and b[low : low + 1] in (b"", b" ")
    return a.count(b" ", 0, low) + whole


_FIELDS = ("h", "right", "left", "k1", "k2", "place", "doc_id")


def _match(a: tuple, b: tuple) -> tuple[int, int]:
    """Words that two suffixes (left, right) share to the left and to the right."""
    return _shared(a[0], b[0]), _shared(a[1], b[1])


#: What a row at the end of a task is: in its first run, in its last run, its first row, its last row, next to one of these runs.
FIRST, LAST, LEAD, TAIL, BESIDE = 1, 2, 4, 8, 16


def _neighbours(kind: pa.DataType):
    """Words before and after its place that a suffix shares with neighbours of other documents, in sorted rows.

    The runs at both ends of the task are returned too, to meet the tasks beside it, and so are the suffixes
    of other documents next to these runs, which the runs of the tasks beside it may have to meet.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        run: list[tuple] = []  # suffixes of the last document, in a row
        first: list[tuple] = []
        after: tuple | None = None  # the next document's first suffix after the first run
        before: tuple | None = None  # the last suffix of the document before the run
        number = TaskContext.get().partitionId()

        def take(a: tuple, b: tuple) -> None:
            found.append((a[3], a[4], a[5], *_match((a[2], a[1]), (b[2], b[1])), a[6], a[0]))

        def out(kept: list[tuple]) -> pa.RecordBatch:
            pairs = list(zip(*found)) if found else [[]] * 7
            ends, marks = list(zip(*[row for row, _ in kept])) if kept else [[]] * 7, [mark for _, mark in kept]
            n, m = len(found), len(kept)
            columns = [
                pa.array([*pairs[0], *ends[3]], pa.int64()), pa.array([*pairs[1], *ends[4]], pa.int64()),
                pa.array([*pairs[2], *ends[5]], pa.int64()), pa.array([*pairs[3], *[None] * m], pa.int32()),
                pa.array([*pairs[4], *[None] * m], pa.int32()), pa.array([*pairs[5], *ends[6]], kind),
                pa.array([*pairs[6], *ends[0]], pa.int64()), pa.array([*[None] * n, *ends[1]], pa.binary()),
                pa.array([*[None] * n, *ends[2]], pa.binary()), pa.array([None] * n + [number] * m, pa.int32()),
                pa.array([None] * n + marks, pa.int32())]
            found.clear()
            return pa.RecordBatch.from_arrays(
                columns, ["k1", "k2", "place", "before", "after", "doc_id", "h", "right", "left", "task", "mark"])

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(7)]):
                other = run and (run[-1][3], run[-1][4]) != (row[3], row[4])
                if run and run[-1][0] != row[0]:  # other first words: what came before is done with
                    first, run, before = first or run, [], None
                elif other:
                    for earlier in run:  # each suffix of the run meets the next document's first
                        take(earlier, row)
                    if not first:
                        first, after = run, row
                    run, before = [], run[-1]
                if before:  # and the previous document's last
                    take(row, before)
                run.append(row)
                if len(found) >= ROWS:
                    yield out([])
        yield out([])
        if run:
            marked = [[row, FIRST] for row in first] + [[row, LAST if first else FIRST | LAST] for row in run]
            marked[0][1] |= LEAD
            marked[-1][1] |= TAIL
            marked += [[row, BESIDE] for row in (after, before) if row]
            for low in range(0, len(marked), ROWS):
                yield out(marked[low : low + ROWS])

    return task


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest suffix of another document outside the task, for the first run of a task and for the last, in sorted rows."""
    waiting: list[int] = []  # tasks whose last run is the present one
    last = before = None
    for batch in batches:
        out = []
        for row in zip(*[batch.column(i).to_pylist() for i in range(7)]):
            h, right, left, document, task, mark = *row[:3], row[3:5], row[5], row[6]
            if last and last[0] != h:
                waiting, before = [], None
            elif last and last[3] != document:
                out += [(t, LAST, left, right) for t in waiting]
                waiting, before = [], last
            if mark & LEAD and before:
                out.append((task, FIRST, before[2], before[1]))
            if mark & TAIL:
                waiting.append(task)
            last = (h, right, left, document)
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
            ["task", "side", "other_left", "other_right"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes with what they share with their partners."""
    for batch in batches:
        left, right, other_left, other_right = (batch.column(i).to_pylist() for i in range(4))
        pairs = [_match((a, b), (c, d)) for a, b, c, d in zip(left, right, other_left, other_right)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[4:], pa.array([p[0] for p in pairs], pa.int32()), pa.array([p[1] for p in pairs], pa.int32())],
            [*batch.schema.names[4:], "before", "after"])


def compared(contexts: DataFrame, order: list[str], kind: str, arrow: pa.DataType) -> tuple[DataFrame, list[DataFrame]]:
    """What each suffix shares with its neighbours in ``order``, a row for each comparison; and the staged frames behind it."""
    columns = f"k1 bigint, k2 bigint, place bigint, doc_id {kind}, h bigint, before int, after int"
    found = staged(
        contexts.select(*_FIELDS).repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_neighbours(arrow), f"k1 bigint, k2 bigint, place bigint, before int, after int, doc_id {kind}, h bigint, "
                    "right binary, left binary, task int, mark int"), "compared")
    ends = found.where("mark is not null")
    # at most four rows for each task decide whom its first and its last run meet; the runs themselves stay spread
    partners = staged(
        ends.where(F.col("mark") >= LEAD).select(*order[:3], *_FIELDS[3:6], "task", "mark").coalesce(1).sortWithinPartitions(*order)
        .select("h", "right", "left", *ROW, "task", "mark").mapInArrow(
            _partners, "task int, side int, other_left binary, other_right binary"), "partners")
    sides = F.filter(F.array(F.lit(FIRST), F.lit(LAST)), lambda side: F.col("mark").bitwiseAND(side) != 0)
    met = ends.withColumn("side", F.explode(sides)).join(partners, ["task", "side"]).select(
        "left", "right", "other_left", "other_right", *ROW, "place", "doc_id", "h").mapInArrow(_met, columns)
    names = (*ROW, "place", "doc_id", "h", "before", "after")
    return found.where("mark is null").select(*names).unionByName(met.select(*names)), [found, partners]


def undecided(by_right: DataFrame, by_left: DataFrame, length: int) -> DataFrame:
    """Suffixes with the window offsets that neighbours leave open.

    A neighbour by the right side shares the most words there, one by the left side the most there.
    A window of ``length`` words that begins ``o`` words before the suffix can only repeat if both suffice; if no single
    neighbour has both, another suffix may.
    """
    pairs = by_right.withColumns({"most_after": F.col("after"), "most_before": F.lit(0)}).unionByName(
        by_left.withColumns({"most_after": F.lit(0), "most_before": F.col("before")}))
    sums = pairs.groupBy(*ROW, "place", "doc_id", "h").agg(
        F.max("most_after").alias("after"), F.max("most_before").alias("before"),
        F.collect_set(F.when(F.col("before") + F.col("after") >= length, F.struct("before", "after"))).alias("sure"))
    low = F.greatest(F.lit(length) - F.col("after"), F.lit(0))
    offsets = F.when(low <= F.col("before"), F.sequence(low, F.col("before"))).otherwise(F.array().cast("array<int>"))
    open_ = F.filter("offsets", lambda o: ~F.exists("sure", lambda s: (o <= s["before"]) & (o + s["after"] >= length)))
    return sums.withColumn("offsets", offsets).withColumn("open", open_)


def _of_two_documents(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that two different documents have (``low1`` to ``high2``: least and greatest of both parts of the locator)."""
    ends = [f(c).alias(n) for f, c, n in ((F.min, "low1", "a1"), (F.max, "high1", "b1"), (F.min, "low2", "a2"), (F.max, "high2", "b2"))]
    return rows.groupBy(*keys).agg(*ends).where("a1 != b1 OR a2 != b2").select(*keys)


def window_repeats(contexts: DataFrame, suffixes: DataFrame, length: int) -> DataFrame:
    """Repeats among the open windows, by digests of their words; exact for every group.

    All windows that could be like an open one are evidence, those of equal contexts once for all
    documents that have them; only the open ones are looked up in it.
    """
    asked = staged(
        suffixes.where("size(open) > 0").select("h", F.explode("open").alias("o")).distinct()
        .groupBy("h").agg(F.collect_set("o").alias("wanted")), "open-windows")
    at = [*ROW, "place"]
    feasible = suffixes.join(asked, "h").withColumn("try", F.array_intersect("offsets", "wanted")).where("size(try) > 0").select(*at, "try", "open")
    _, near = rows_in(contexts, asked, ("h",))
    context = F.sha2(F.concat(F.col("left"), F.lit(b"|"), F.col("right")), 256)
    held = staged(near.join(feasible, at).select(*at, "doc_id", "h", "left", "right", "try", "open", context.alias("context")), "held")
    freed(asked)
    words = lambda c, n: F.slice(F.split(F.col(c).cast("string"), " "), F.lit(1), n)
    digest = F.sha2(F.concat_ws(" ", words("left", F.col("o")), F.lit("|"), words("right", F.lit(length) - F.col("o"))), 256)
    kinds = held.groupBy("h", "context").agg(
        F.min("k1").alias("low1"), F.max("k1").alias("high1"), F.min("k2").alias("low2"), F.max("k2").alias("high2"),
        F.array_distinct(F.flatten(F.collect_set("try"))).alias("try"), F.first("left").alias("left"), F.first("right").alias("right"))
    evidence = kinds.select("h", "low1", "high1", "low2", "high2", "left", "right", F.explode("try").alias("o")).select(
        "h", "o", digest.alias("digest"), "low1", "high1", "low2", "high2")
    again = _of_two_documents(evidence, "h", "o", "digest")
    mine = held.select(*at, "doc_id", "h", "left", "right", F.explode("open").alias("o")).select(*at, "doc_id", "h", "o", digest.alias("digest"))
    return mine.join(again, ["h", "o", "digest"], "left_semi").select(
        *ROW, (F.col("place") - F.col("o")).alias("start"), (F.col("place") - F.col("o") + length).alias("end"), "doc_id")


def _joined(kind: pa.DataType):
    """Overlapping or touching spans of a document as one, over sorted rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            out = []
            for k1, k2, start, end, doc_id in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if held and held[:2] == (k1, k2) and start <= held[3]:
                    held = (*held[:3], max(held[3], end), doc_id)
                else:
                    if held:
                        out.append(held)
                    held = (k1, k2, start, end, doc_id)
            yield _spans_batch(out, kind)
        yield _spans_batch([held] if held else [], kind)

    return task


def _spans_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[4], kind), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], ["doc_id", "start_word", "end_word"])


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """A row per span of a document that other documents repeat: id, first word and end, words."""
    docs = plain_scan(docs)
    rows = located(docs).select(
        F.col(f"row.`{text}`").alias("text"), F.xxhash64("_file").alias("k1"), F.col("_row").alias("k2"), F.col(f"row.`{key}`").alias("doc_id"))
    kind, arrow = rows.schema["doc_id"].dataType.simpleString(), pa.int64()
    if kind != "bigint":
        rows, kind = rows.withColumn("doc_id", F.col("doc_id").cast("string")), "string"
        arrow = pa.string()
    anchors = staged(
        rows.select("text", *ROW).mapInArrow(_anchors(length, gram), "k1 bigint, k2 bigint, place bigint, h bigint"), "anchors")
    both = anchors.select("h", F.col("k1").alias("low1"), F.col("k1").alias("high1"), F.col("k2").alias("low2"), F.col("k2").alias("high2"))
    again = staged(_of_two_documents(both, "h"), "anchors-again")
    _, retained = rows_in(anchors, again, ("h",))
    places = staged(
        retained.groupBy(*ROW).agg(F.sort_array(F.collect_list(F.struct("place", "h"))).alias("at"))
        .select(*ROW, F.col("at.place").alias("places"), F.col("at.h").alias("hashes")), "places")
    freed(anchors, again)
    _, marked = rows_in(rows, places, ROW)
    wanted = marked.join(places, list(ROW)).select("text", *ROW, "places", "hashes", "doc_id")
    path = work_dir(docs.sparkSession, "suffixes")
    wanted.mapInArrow(
        _contexts(length, gram), f"h bigint, right binary, left binary, k1 bigint, k2 bigint, place bigint, doc_id {kind}"
    ).write.option("compression", "zstd").parquet(path)
    contexts = docs.sparkSession.read.parquet(path)
    freed(places)
    by_right, one = compared(contexts, ["h", "right", "left", "k1", "k2", "place"], kind, arrow)
    by_left, other = compared(contexts, ["h", "left", "right", "k1", "k2", "place"], kind, arrow)
    suffixes = staged(undecided(by_right, by_left, length), "compared-suffixes")
    freed(*one, *other)
    sure = suffixes.select(*ROW, "place", "doc_id", F.explode("sure").alias("s")).select(
        *ROW, (F.col("place") - F.col("s.before")).alias("start"), (F.col("place") + F.col("s.after")).alias("end"), "doc_id")
    spans = sure.unionByName(window_repeats(contexts, suffixes, length))
    return spans.repartition(*ROW).sortWithinPartitions(*ROW, "start").mapInArrow(
        _joined(arrow), f"doc_id {kind}, start_word bigint, end_word bigint"
    ).withColumn("words", F.col("end_word") - F.col("start_word"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))
