"""Language identification: unigram pieces per language, summed over all segmentations.

The pieces are those of a public tokenizer (its path is a parameter). A word, lower-cased and
without anything but letters, can be cut into pieces in many ways; its probability in a language is
the sum over all cuts of the product of the pieces' probabilities, by a forward recursion over
its letters. Letters that no piece covers are one piece more. Piece probabilities are learned from word counts by
language: expected piece counts over all segmentations (forward-backward), added across
tasks, for a few rounds. A text's score is the posterior of its best language, all languages equally likely before.

Recursions stay within the range of doubles whatever the probabilities and the length of a word: each letter
carries a fixed factor that is taken out again, and words too long for that are summed in logarithms.

Only text and language of training rows are learned from; language, source and id never
enter a prediction. Words are never cut. NULL, empty and letterless texts
are `und` with score 0; so is every text if nothing could be learned. Ties go to the first language by code point. Repeated rows count
as often as they occur. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .chains import added_pieces
from .common import hex_id, ship, staged, table

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Rounds of learning; smoothing count of a piece.
ROUNDS, SMOOTH = 2, 0.05
#: Greatest natural logarithm that plain sums may reach; numbers in a table of a lattice, about.
RANGE, TABLE = 600.0, 1 << 22
#: Words a task holds before it passes counts on, and remembers before it forgets them all; texts it takes at once.
HELD, REMEMBERED, TEXTS = 200_000, 400_000, 500

START = "▁"


def pieces_of(path: str = PIECES) -> list[str]:
    """Letter pieces of the vocabulary, with and without the mark of a word's start; a fixed set."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return sorted({n.lower() for n in names if n.removeprefix(START).isalpha()} | {START})


class _Letters(dict):
    """For `str.translate`: letters and white space stay, other characters go."""

    def __missing__(self, code: int) -> int | None:
        char = chr(code)
        self[code] = kept = code if char.isalpha() or char.isspace() else None
        return kept


_LETTERS = _Letters()


def words_of(text: str | None) -> list[str]:
    """The letters of each lower-case token as one word, if it has any."""
    return (text or "").lower().translate(_LETTERS).split()


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words that follow each other, and sums and powers for hashes of their parts."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    back = np.full(len(codes), _BACK)
    power = np.full(len(codes), _BASE)
    if len(codes):
        back[0] = power[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * np.cumprod(back, dtype=np.uint64), dtype=np.uint64)])
    return codes, sums, np.cumprod(power, dtype=np.uint64)


def _hashes(sums: np.ndarray, power: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the ``size`` letters from each place on; the same letters have the same hash."""
    out = (sums[at + size] - sums[at]) * power[at]
    out ^= out >> np.uint64(31)
    return out * np.uint64(0xFF51AFD7ED558CCD)


class Pieces:
    """Pieces by length: sorted hashes, their numbers, and a bitmap of the hashes' first bits."""

    def __init__(self, names: list[str]):
        self.other = len(names)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({len(n) for n in names}):
            numbers = np.array([i for i, n in enumerate(names) if len(n) == size])
            _, sums, power = _letters([names[i] for i in numbers])
            found = _hashes(sums, power, np.arange(len(numbers)) * size, size)
            order, bitmap = np.argsort(found), np.zeros(1 << 16, dtype=bool)
            bitmap[found >> np.uint64(48)] = True
            self.by_size[size] = found[order], numbers[order], bitmap


class Lattice:
    """All pieces at all places of some words."""

    def __init__(self, words: list[str], pieces: Pieces):
        marked = [START + w for w in words]
        lengths = np.array([len(w) for w in marked], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
        codes, sums, power = _letters(marked)
        owner = np.repeat(np.arange(len(words)), lengths)
        inside = np.arange(len(codes)) - first[owner] if len(words) else np.zeros(0, np.int64)
        room = lengths[owner] - inside if len(words) else inside
        places, sizes, numbers = [], [], []
        covered = np.zeros(len(codes), dtype=bool)
        for size, (known, number, bitmap) in pieces.by_size.items():
            at = np.flatnonzero(room >= size)
            found = _hashes(sums, power, at, size)
            near = np.flatnonzero(bitmap[found >> np.uint64(48)])
            at, found = at[near], found[near]
            slot = np.minimum(np.searchsorted(known, found), len(known) - 1)
            hit = known[slot] == found
            places.append(at[hit]), sizes.append(np.full(int(hit.sum()), size)), numbers.append(number[slot[hit]])
            if size == 1:
                covered[at[hit]] = True
        bare = np.flatnonzero(~covered)  # letters that are no piece
        places.append(bare), sizes.append(np.ones(len(bare), np.int64)), numbers.append(np.full(len(bare), pieces.other))
        place, size = np.concatenate(places), np.concatenate(sizes)
        piece, word = np.concatenate(numbers), owner[place]
        start = inside[place]
        end = start + size
        self.words, self.lengths = len(words), np.array([len(w) + 1 for w in words], dtype=np.int64)
        self.width = int(self.lengths.max(initial=0)) + 1
        order = self._sorted(end)
        self.word, self.start, self.end, self.piece = (np.array(x, dtype=np.int64)[order] for x in (word, start, end, piece))
        self.size = self.end - self.start
        self.cuts = np.searchsorted(self.end, np.arange(self.width + 1))

    def _sorted(self, places: np.ndarray) -> np.ndarray:
        """Stable order of places; sorted by digits where they fit 16 bits."""
        return np.argsort(np.array(places, dtype=np.uint16 if self.width <= 1 << 16 else np.int64), kind="stable")

    @cached_property
    def by_start(self) -> np.ndarray:
        return self._sorted(self.start)

    @cached_property
    def start_cuts(self) -> np.ndarray:
        return np.searchsorted(self.start[self.by_start], np.arange(self.width + 1))

    def forward(self, chances: np.ndarray) -> np.ndarray:
        """[position, word]: probability of the letters before a position; ``chances`` is per piece place."""
        alpha = np.zeros((self.width, self.words))
        alpha[0] = 1
        for j in range(1, self.width):
            a, b = self.cuts[j], self.cuts[j + 1]
            alpha[j] = np.bincount(self.word[a:b], weights=alpha[self.start[a:b], self.word[a:b]] * chances[a:b], minlength=self.words)
        return alpha

    def totals(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[self.lengths, np.arange(self.words)]

    def expected(self, chances: np.ndarray) -> np.ndarray:
        """Per piece place: the share of its word's probability that uses it."""
        alpha = self.forward(chances)
        beta = np.zeros_like(alpha)
        beta[self.lengths, np.arange(self.words)] = 1
        for i in range(self.width - 2, -1, -1):
            at = self.by_start[self.start_cuts[i] : self.start_cuts[i + 1]]
            word = self.word[at]
            beta[i] += np.bincount(word, weights=chances[at] * beta[self.end[at], word], minlength=self.words)
        through = alpha[self.start, self.word] * chances * beta[self.end, self.word]
        return through / self.totals(alpha)[self.word]

    def _added(self, word: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Logarithms of the sums of each word's terms, given as logarithms."""
        most = np.full(self.words, -np.inf)
        np.maximum.at(most, word, terms)
        base = np.where(np.isfinite(most), most, 0.0)
        with np.errstate(divide="ignore"):
            return base + np.log(np.bincount(word, weights=np.exp(terms - base[word]), minlength=self.words))

    def forward_logs(self, logs: np.ndarray) -> np.ndarray:
        """`forward` in logarithms."""
        alpha = np.full((self.width, self.words), -np.inf)
        alpha[0] = 0
        for j in range(1, self.width):
            a, b = self.cuts[j], self.cuts[j + 1]
            alpha[j] = self._added(self.word[a:b], alpha[self.start[a:b], self.word[a:b]] + logs[a:b])
        return alpha

    def expected_from_logs(self, logs: np.ndarray) -> np.ndarray:
        """`expected` in logarithms."""
        alpha = self.forward_logs(logs)
        beta = np.full_like(alpha, -np.inf)
        for i in range(self.width - 1, -1, -1):
            if i < self.width - 1:
                at = self.by_start[self.start_cuts[i] : self.start_cuts[i + 1]]
                beta[i] = self._added(self.word[at], logs[at] + beta[self.end[at], self.word[at]])
            beta[i, self.lengths == i] = 0
        return np.exp(alpha[self.start, self.word] + logs + beta[self.end, self.word] - self.totals(alpha)[self.word])


def _count_words(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: defaultdict[str, Counter] = defaultdict(Counter)
    held = 0

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array([lang for lang, own in counts.items() for _ in own], pa.string()),
             pa.array([word for own in counts.values() for word in own], pa.string()),
             pa.array([c for own in counts.values() for c in own.values()], pa.int64())], ["lang", "word", "c"])
        counts.clear()
        return out

    for batch in batches_in:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = counts[lang]
            before = len(own)
            own.update(words_of(text.as_py()))
            held += len(own) - before
            if held > HELD:
                held = 0
                yield flush()
    yield flush()


class Model:
    """Piece probabilities [piece, language]; the last piece is any other letter."""

    def __init__(self, pieces: list[str], languages: list[str], chances: np.ndarray):
        self.pieces, self.languages, self.chances = Pieces(pieces), languages, chances
        #: logarithm of the factor that each letter carries in plain sums: half of what the least likely piece would need
        self.lift = -np.log(chances.min(axis=0)) / 2

    def lattices(self, words: list[str]) -> Iterator[tuple[np.ndarray, Lattice, bool]]:
        """Lattices of words of like length: the words' places, and whether plain sums hold all their probabilities."""
        sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        sizes = sizes[order]
        plain, low = int(np.searchsorted(sizes * self.lift.max(initial=0.0), RANGE, side="right")), 0
        while low < len(words):
            end = plain if low < plain else len(words)
            table = np.arange(1, end - low + 1) * sizes[low:end]
            high = low + max(1, int(np.searchsorted(table, TABLE, side="right")))
            yield order[low:high], Lattice([words[i] for i in order[low:high]], self.pieces), low < plain
            low = high

    def logs(self, words: list[str]) -> np.ndarray:
        """[word, language]: log probabilities, summed over segmentations."""
        out = np.zeros((len(words), len(self.languages)))
        for places, lattice, plain in self.lattices(words):
            for k in range(len(self.languages)):
                chances = self.chances[lattice.piece, k]
                if plain:
                    alpha = lattice.forward(chances * np.exp(self.lift[k] * lattice.size))
                    out[places, k] = np.log(lattice.totals(alpha)) - self.lift[k] * lattice.lengths
                else:
                    out[places, k] = lattice.totals(lattice.forward_logs(np.log(chances)))
        return out

    def expected(self, words: list[str], language: np.ndarray, times: np.ndarray) -> np.ndarray:
        """[language, piece]: expected pieces of words, each in its language and so many times."""
        sums = np.zeros((len(self.languages), len(self.chances)))
        for places, lattice, plain in self.lattices(words):
            of, n = language[places][lattice.word], times[places][lattice.word]
            chances = self.chances[lattice.piece, of]
            if plain:
                share = lattice.expected(chances * np.exp(self.lift[of] * lattice.size))
            else:
                share = lattice.expected_from_logs(np.log(chances))
            sums += np.bincount(of * len(self.chances) + lattice.piece, weights=share * n, minlength=sums.size).reshape(sums.shape)
        return sums


def learn(docs: DataFrame, train: Column, lang: str, text: str, path: str = PIECES, rounds: int = ROUNDS) -> Model:
    spark, names = docs.sparkSession, pieces_of(path)
    ship(spark)
    rows = docs.where(train & F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    counts = staged(
        rows.mapInArrow(_count_words, "lang string, word string, c bigint").groupBy("lang", "word").agg(F.sum("c").alias("c")),
        "words-by-language")
    languages = sorted((r[0] for r in counts.select("lang").distinct().collect()), key=lambda x: x.encode())
    size = len(names) + 1
    model = Model(names, languages, np.full((size, len(languages)), 1 / size))
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast(model)

        def task(batches_in: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            m = shared.value
            number = {x: i for i, x in enumerate(m.languages)}
            sums = np.zeros((len(m.languages), len(m.chances)))
            for batch in batches_in:
                if batch.num_rows:
                    of = np.array([number[x] for x in batch.column(0).to_pylist()])
                    sums += m.expected(batch.column(1).to_pylist(), of, batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int64()), pa.array([s.tobytes() for s in sums], pa.binary())], ["piece", "counts"])

        sums = added_pieces(counts.mapInArrow(task, "piece bigint, counts binary"))
        chances = np.column_stack([sums[k] for k in range(len(languages))]) + SMOOTH
        model = Model(names, languages, chances / chances.sum(0))
    return model


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` as doc_id, the predicted language and its posterior."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        many = len(model.languages)
        place: dict[str, int] = {}
        logs = np.zeros((0, many))
        for batch in batches_in:
            found, scores = [], []
            for low in range(0, batch.num_rows, TEXTS):
                texts = [words_of(t) for t in batch.column(0).slice(low, TEXTS).to_pylist()]
                if len(place) > REMEMBERED:
                    place, logs = {}, np.zeros((0, many))
                new = list(set().union(*texts).difference(place)) if many else []
                if new:
                    place.update(zip(new, range(len(logs), len(logs) + len(new))))
                    logs = np.concatenate([logs, model.logs(new)])
                for words in texts:
                    if not many or not words:
                        found.append("und"), scores.append(0.0)
                        continue
                    total = logs[np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=len(words))].sum(0)
                    best = int(total.argmax())
                    found.append(model.languages[best])
                    scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    kept = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{key}`").alias("doc_id"))
    return kept.mapInArrow(task, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(hex_id() % 3 == 1, F.lit(False))
    found = identify(docs, learn(docs, ~held_out, "lang", "text"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
