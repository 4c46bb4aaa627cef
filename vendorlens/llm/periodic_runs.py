"""Periodic runs of words, found in a grammar of the texts.

A task takes whole texts in lots and numbers their words. Re-Pair replaces pairs that occur
at least twice by new symbols, round after round: in a round every occurrence that no more frequent
pair overlaps. What is left of a text is halved into a balanced tree, so that each text is one
nonterminal. A run lies inside some least nonterminal and crosses the border of its two parts;
so the runs that cross a border are computed once per nonterminal, at one place where it
stands, and are moved to all places where the grammar derives it. A symbol that is swallowed by later ones
still stands where it was made, so the places noted at its making are all of them. Runs that were cut by
the end of a nonterminal lie in the whole ones; only the maximal ones are kept.

At a border, a run of four periods or more holds two of them on one side, so its period q shows
as a square next to the border. Squares and extensions are read from two prefix hashes; the
runs of a lot are then compared word by word, and the lot is done again with other
hashes should one differ.

A *run* is a stretch with smallest period q and at least ``max(6, 4 q)`` words which no neighbour extends.
Words are what the six separating characters leave. NULL and empty texts have no words and no run. Repeated rows and
ids give a row each; a NULL id is kept and its text is not folded. A text is never cut: one longer than a lot is
a lot of its own, so a task's memory follows its longest text. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ship, sliced, table

#: Least words and least number of periods of a run.
LEAST, PERIODS = 6, 4
#: Words of a lot; (border, period) pairs that are looked at at once; prime of the hashes.
LOT, PAIRS, PRIME = 150_000, 1 << 21, (1 << 31) - 1

SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string, n_words bigint, n_dropped bigint"
)


class Grammar:
    """Re-Pair over texts (arrays of word numbers laid end to end; ``bounds`` are their ends and starts)."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        #: per nonterminal: a place where it stands, words of its left part, words in all
        self.place, self.left, self.size = [], [], []
        #: symbols made, and where: numbers of nonterminals and their places, for each round
        self.made: list[tuple[np.ndarray, np.ndarray]] = []
        self.count = 0
        self._pair(words, bounds)

    def _add(self, place: np.ndarray, left: np.ndarray, size: np.ndarray) -> np.ndarray:
        numbers = np.arange(self.count, self.count + len(place))
        self.count += len(place)
        for kept, new in ((self.place, place), (self.left, left), (self.size, size)):
            kept.append(new)
        return numbers

    def _pair(self, words: np.ndarray, bounds: np.ndarray) -> None:
        n = len(words)
        symbols, at = words.astype(np.int64), np.arange(n)
        used = int(words.max()) + 1 if n else 0
        ends = np.zeros(n, dtype=bool)  # the last symbol of each text
        ends[bounds[1:][np.diff(bounds) > 0] - 1] = True
        open_ = np.ones(n, dtype=bool)  # pairs that may occur twice: once a pair is single, it stays so
        while True:
            i = np.flatnonzero(open_[:-1] & ~ends[:-1])
            apart = self._apart(symbols, ends, i)
            spare, i = i[~apart], i[apart]
            a, b = symbols[i], symbols[i + 1]
            keys, inverse, counts = np.unique(a * used + b, return_inverse=True, return_counts=True)
            rank = np.empty(len(keys), dtype=np.int64)
            rank[np.argsort(counts, kind="stable")] = np.arange(1, len(keys) + 1)
            rank[counts < 2] = 0
            weight = np.zeros(len(symbols) + 1, dtype=np.int64)
            weight[i] = rank[inverse]
            here = weight[i]
            best = (here > 0) & (here > weight[i - 1]) & (here > weight[i + 1])  # weight[-1] is a spare 0
            often = np.bincount(inverse[best], minlength=len(keys)) > 1
            best &= often[inverse]
            if not best.any():
                break
            i, pairs = i[best], inverse[best]
            kinds, first, which = np.unique(pairs, return_index=True, return_inverse=True)
            stop = np.append(at[1:], n)  # where a symbol's words end; texts lie end to end
            place, middle, end = at[i[first]], at[i[first] + 1], stop[i[first] + 1]
            numbers = self._add(place, middle - place, end - place)
            self.made.append((numbers[which], at[i]))
            symbols[i] = used + which
            used += len(kinds)
            open_ = weight[:-1] > 0
            open_[spare] = open_[i] = open_[i - 1] = True
            ends[i] = ends[i + 1]
            stay = np.ones(len(symbols), dtype=bool)
            stay[i + 1] = False
            symbols, at, ends, open_ = symbols[stay], at[stay], ends[stay], open_[stay]
        self._halve(at, ends, n)

    @staticmethod
    def _apart(symbols: np.ndarray, ends: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Marks of pairs; of one symbol twice, only every second one in a row, so that none overlaps its like."""
        same = symbols[i] == symbols[i + 1]
        if not same.any():
            return ~same
        new = np.ones(len(symbols), dtype=bool)
        new[1:] = (symbols[1:] != symbols[:-1]) | ends[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(symbols)), 0))
        return ~same | ((i - first[i]) % 2 == 0)

    def _halve(self, at: np.ndarray, ends: np.ndarray, n: int) -> None:
        """Join what is left of each text two by two, until a text is one symbol."""
        stop = np.append(at[1:], n)
        while len(at):
            new = np.append(True, ends[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            i = np.flatnonzero(((np.arange(len(at)) - first) % 2 == 0) & ~ends)
            if not len(i):
                return
            numbers = self._add(at[i], at[i + 1] - at[i], stop[i + 1] - at[i])
            self.made.append((numbers, at[i]))
            stop[i], ends[i] = stop[i + 1], ends[i + 1]
            stay = np.ones(len(at), dtype=bool)
            stay[i + 1] = False
            at, stop, ends = at[stay], stop[stay], ends[stay]


class Hashes:
    """Two prefix hashes of a sequence: equal stretches by two numbers, whatever their length."""

    def __init__(self, words: np.ndarray, seed: int):
        random = np.random.default_rng(seed)
        kinds, n = int(words.max()) + 1 if len(words) else 0, len(words)
        self.parts = []
        for _ in range(2):
            base, power = int(random.integers(1 << 20, PRIME)), np.ones(n + 1, dtype=np.int64)
            done = 1
            while done <= n:
                more = min(done, n + 1 - done)
                power[done : done + more] = power[:more] * pow(base, done, PRIME) % PRIME
                done += more
            values = random.integers(1, PRIME, kinds)[words]
            prefix = np.concatenate([[0], np.cumsum(values * power[:-1] % PRIME)]) % PRIME
            self.parts.append((power, prefix))

    def same(self, low: np.ndarray, high: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words from ``low`` and from ``high`` (not less) are equal."""
        out = np.ones(len(low), dtype=bool)
        for power, prefix in self.parts:
            lower = (prefix[low + length] - prefix[low]) % PRIME
            higher = (prefix[high + length] - prefix[high]) % PRIME
            out &= lower * power[high - low] % PRIME == higher
        return out

    def reach(self, low: np.ndarray, high: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """Words that agree from ``low`` and ``high`` on (or before them), ``most`` at most."""
        least, most = np.zeros(len(low), dtype=np.int64), most.copy()
        while (going := least < most).any():
            try_ = (least + most + 1) // 2
            same = self.same(low, high, try_) if forward else self.same(low - try_, high - try_, try_)
            least, most = np.where(going & same, try_, least), np.where(going & ~same, try_ - 1, most)
        return least


def _least_factors(n: int) -> np.ndarray:
    """The least prime factor of each number up to ``n``."""
    out = np.arange(n + 1)
    for p in range(2, int(n**0.5) + 1):
        if out[p] == p:
            multiples = out[p * p :: p]
            multiples[multiples == np.arange(p * p, n + 1, p)] = p
    return out


def border_runs(words: np.ndarray, hashes: Hashes, place: np.ndarray, left: np.ndarray, size: np.ndarray):
    """Runs that cross the border of each nonterminal: its number, start (from its place), length and period."""
    number = np.flatnonzero(size >= LEAST)
    found = []
    reach = np.maximum(size[number] // PERIODS, 1)
    steps = [np.minimum(reach, (size - left)[number] // 2), np.minimum(reach, left[number] // 2)]
    for side, most in enumerate(steps):
        total = np.cumsum(most)
        low = 0
        while low < len(number):
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIRS, side="right")))
            n = most[low:high]
            which = np.repeat(number[low:high], n)
            q = np.arange(1, len(which) + 1) - np.repeat(np.cumsum(n) - n, n)
            low = high
            border = place[which] + left[which]
            a = border if side == 0 else border - 2 * q  # a square would be a, a + q, a + 2 q
            alike = (words[a] == words[a + q]) & (words[a + q - 1] == words[a + 2 * q - 1])
            which, q, a, border = which[alike], q[alike], a[alike], border[alike]
            square = hashes.same(a, a + q, q)
            which, q, border = which[square], q[square], border[square]
            begin, end = place[which], place[which] + size[which]
            right = hashes.reach(border - (q if side else 0), border + (0 if side else q), end - border - (0 if side else q), True)
            back = hashes.reach(border - (q if side else 0), border + (0 if side else q), border - begin - (q if side else 0), False)
            # words that agree q apart reach from border - back (- q) on; the run has q words more
            start = border - (q if side else 0) - back
            length = back + right + q
            long = (length >= np.maximum(LEAST, PERIODS * q)) & (start < border) & (start + length > border)
            found.append(np.stack([which, start, length, q])[:, long])
    which, start, length, q = np.concatenate(found, axis=1) if found else np.zeros((4, 0), dtype=np.int64)
    keep = np.ones(len(q), dtype=bool)
    factors, rest = _least_factors(int(q.max()) if len(q) else 1), q.copy()
    while (rest > 1).any():  # a shorter period would divide q, as the stretch is long
        p = factors[rest]
        shorter = np.where(rest > 1, q // p, 0)
        tried = np.flatnonzero(rest > 1)
        d = shorter[tried]
        keep[tried[hashes.same(start[tried], start[tried] + d, length[tried] - d)]] = False
        rest = np.where(rest > 1, rest // p, rest)
    return which[keep], start[keep] - place[which[keep]], length[keep], q[keep]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts``."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


def runs(words: np.ndarray, bounds: np.ndarray, seed: int = 1) -> np.ndarray:
    """Rows (text, start in the text, length, period) of all runs, by text, start and period."""
    grammar = Grammar(words, bounds)
    if not grammar.count:
        return np.zeros((0, 4), dtype=np.int64)
    place, left, size = (np.concatenate(x) for x in (grammar.place, grammar.left, grammar.size))
    which, offset, length, q = border_runs(words, Hashes(words, seed), place, left, size)
    # to all places where the nonterminals are derived
    numbers, places = (np.concatenate(x) for x in zip(*grammar.made))
    carries = np.zeros(grammar.count, dtype=bool)
    carries[which] = True
    numbers, places = numbers[carries[numbers]], places[carries[numbers]]
    order = np.argsort(numbers, kind="stable")
    numbers, places = numbers[order], places[order]
    low, high = np.searchsorted(numbers, which), np.searchsorted(numbers, which, side="right")
    times = high - low
    at = places[_spread(low, times)] + np.repeat(offset, times)
    length, q = np.repeat(length, times), np.repeat(q, times)
    text = np.searchsorted(bounds, at, side="right") - 1
    # of equal periods in a text, what no earlier stretch holds is maximal
    order = np.lexsort((-length, at, q, text))
    text, at, length, q = text[order], at[order], length[order], q[order]
    end, keep, last, reached = at + length, np.zeros(len(at), dtype=bool), None, -1
    for i, group in enumerate(zip(text.tolist(), q.tolist())):
        if group != last or end[i] > reached:
            last, reached, keep[i] = group, end[i], True
    text, at, length, q = text[keep], at[keep], length[keep], q[keep]
    if not _right(words, bounds, text, at, length, q):
        return runs(words, bounds, seed + 1)
    found = np.stack([text, at - bounds[text], length, q], axis=1)
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _right(words, bounds, text, at, length, q) -> bool:
    """Whether the runs are periodic and maximal, word by word."""
    inside = _spread(at, length - q)
    if (words[inside] != words[inside + np.repeat(q, length - q)]).any():
        return False
    padded = np.append(words, -1)
    before, after = at > bounds[text], at + length < bounds[text + 1]
    longer = (before & (padded[at - 1] == padded[at - 1 + q])) | (after & (padded[at + length] == padded[at + length - q]))
    return not longer.any()


def dropped_words(size: int, found: np.ndarray) -> np.ndarray:
    """Marks of the words of a text that a run (start, length, period) repeats."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, found[:, 0] + found[:, 2], 1)
    np.add.at(steps, found[:, 0] + found[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0


def folded_places(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places that the words of a text come from, where the rule of the ids folds it."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def _rows(ids: list, texts: list[list[bytes]], found: np.ndarray) -> Iterator[tuple]:
    low = 0
    for t, (doc_id, words) in enumerate(zip(ids, texts)):
        high = low
        while high < len(found) and found[high, 0] == t:
            high += 1
        mine, low = found[low:high, 1:], high
        best, dropped = (None,) * 4, 0
        if len(mine):
            start, length, period = min(mine.tolist(), key=lambda r: (-r[1], r[0], r[2]))
            best = (start, length, period, 1000 * length // period)
            gone = dropped_words(len(words), mine)
            dropped = int(gone.sum())
            words = [w for w, d in zip(words, gone.tolist()) if not d]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in mine.tolist())
        yield (
            doc_id, len(mine), *best, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(words)).hexdigest(), len(words) + dropped, dropped,
        )


def _task(fold: Callable | None) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, total = [], [], 0

        def lot() -> pa.RecordBatch:
            numbers: dict[bytes, int] = defaultdict()
            numbers.default_factory = numbers.__len__
            words = np.array([numbers[w] for text in texts for w in text], dtype=np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
            rows = list(zip(*_rows(ids, texts, runs(words, bounds))))
            types = [pa.string() if "sha256" in c else pa.int64() for c in SCHEMA.split(", ")]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)

        for batch in sliced(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().encode().split() if text.is_valid else []
                places = fold(doc_id, len(words)) if fold else None
                if places is not None:
                    words = [words[i] for i in places.tolist()]
                if ids and total + len(words) > LOT:
                    yield lot()
                    ids, texts, total = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                total += len(words)
        if ids:
            yield lot()

    return work


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", fold: Callable | None = None) -> DataFrame:
    """Per document: number of runs, the longest one, digests of all runs and of the text without repeats.

    ``fold`` may name, by id and number of words, the places that a text's words are taken from.
    """
    ship(docs.sparkSession)
    rows = docs.select(docs[f"`{key}`"].cast("bigint").alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    return rows.mapInArrow(_task(fold), SCHEMA)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), fold=folded_places)
