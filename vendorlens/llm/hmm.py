"""Hidden Markov language model over words, and the unigram base it is held against.

Vocabulary: word counts of all training documents, a table of any length. The `HEAD` most frequent words
are symbols of the model; every other word is emitted as one of some ending classes (their number follows the
vocabulary, up to `CLASSES`) and then drawn within its class by add-one counts, so known and unknown words have probabilities
that sum to one. Baum-Welch: each round every task runs forward-backward over its whole training texts and returns expected
counts in pieces; pieces are added across tasks, and only the model (states x symbols, of fixed size)
comes to the driver. Scores come from the scaled forward recursion over whole texts.
Counts of words outside the broadcast head reach the texts by a shuffled join on the word.

Words are lower-cased (A-Z) and separated by white space; an end token closes each text. NULL and empty
texts are the end token alone. Documents with NULL id are trained on; repeated rows count as
often as they occur; an empty table gives an empty result; with no training documents every token is unknown.
Columns other than id and text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .chains import Layout, added_pieces, batches
from .common import hex_id, ship, sliced, staged, table, work_dir

STATES, ROUNDS = 8, 6
#: Words that are symbols; words whose counts are broadcast.
HEAD, COUNTED = 1 << 16, 1 << 18
#: Ending classes of the other words at most (a power of two); distinct words of a class, on average, below that.
CLASSES, IN_CLASS = 2048, 64
#: Symbols in a piece of expected counts; distinct words a task holds before it passes counts on; texts it encodes at once.
PIECE, HELD, TEXTS = 4096, 250_000, 500
#: Tokens laid out at once; positions after which the forward and backward numbers are brought back to a sum of 1.
TOKENS, RESCALED = 1 << 18, 12
#: Words' worth of unigram counts added to each state's emissions.
PRIOR = 500.0


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def ending_class(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-3:]) % classes


class _Classes(dict):
    """Ending classes of words, remembered."""

    def __init__(self, classes: int):
        super().__init__()
        self.classes = classes

    def __missing__(self, word: bytes) -> int:
        self[word] = found = ending_class(word, self.classes)
        return found


def classes_for(types: int) -> int:
    """How many ending classes ``types`` distinct words are dealt to: a power of two."""
    return min(CLASSES, 1 << max(0, (types // IN_CLASS).bit_length() - 1))


def _count_words(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])
        counts.clear()
        return out

    for batch in batches_in:
        for text in batch.column(0):
            counts.update(words_of(text.as_py()))
            if len(counts) > HELD:
                yield flush()
    yield flush()


@dataclass
class Vocabulary:
    """Counts of the most frequent words (by falling count), totals, and totals of ending classes."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int  # training tokens, ends included
    types: int  # distinct training tokens, the end included
    texts: int
    class_tokens: np.ndarray
    class_types: np.ndarray
    head: int  # words that are symbols

    @property
    def symbols(self) -> int:
        """Head words, then classes, then the end."""
        return self.head + len(self.class_tokens) + 1

    def unigram(self) -> np.ndarray:
        """Smoothed probabilities of symbols."""
        counts = np.concatenate([self.counts[: self.head], self.class_tokens, [self.texts]]) + 1.0
        return counts / counts.sum()


def _most_frequent(counts: DataFrame) -> list[tuple[int, bytes]]:
    """(-count, word) of at most `COUNTED` words, all above some count, most frequent first."""
    # a histogram of counts on a logarithmic scale tells from which count on there are few enough
    steps = counts.groupBy(F.floor(F.log2("c") * 16).alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least"))
    from_, words = None, 0
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):  # some hundred rows
        words += row["n"]
        if words > COUNTED:
            break
        from_ = row["least"]
    if from_ is None:
        return []
    found = counts.where(F.col("c") >= from_).select("c", "word").toArrow()
    return sorted(zip((-c for c in found.column(0).to_pylist()), found.column(1).to_pylist()))


def vocabulary(docs: DataFrame, train: Column, key: str, text: str) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary and the table of all word counts (word, c)."""
    learned = docs.where(train).select(F.col(f"`{text}`").cast("binary").alias("text"))
    counts = staged(
        learned.mapInArrow(_count_words, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c")), "words")
    texts = docs.where(train).count()
    tokens, types = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    top = _most_frequent(counts)
    outside = F.lit(False)
    if len(top) > HEAD:
        least, word = top[HEAD - 1]
        outside = (F.col("c") < -least) | ((F.col("c") == -least) & (F.col("word") > F.lit(bytearray(word))))
    elif len(top) < types:
        outside = F.col("c") < -top[-1][0] if top else F.lit(True)
    kind = F.crc32(F.expr("substring(word, greatest(length(word) - 2, 1), 3)")) % CLASSES
    classes = counts.where(outside).groupBy(kind.alias("kind")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    number = classes_for(sum(row["v"] for row in classes))
    class_tokens, class_types = np.zeros(number, np.int64), np.zeros(number, np.int64)
    for row in classes:
        class_tokens[row["kind"] % number] += row["n"]
        class_types[row["kind"] % number] += row["v"]
    return Vocabulary(
        [w for _, w in top], np.array([-c for c, _ in top], dtype=np.int64),
        (tokens or 0) + texts, types + (texts > 0), texts, class_tokens, class_types, min(HEAD, len(top))), counts


def encode(docs: DataFrame, train: Column, key: str, text: str, known: Vocabulary) -> DataFrame:
    """Per document: symbols, token and known counts, logs of base and class parts, and words whose counts are not here."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def task(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        head, classes = v.head, len(v.class_tokens)
        place = {w: i for i, w in enumerate(v.words)}
        base_log = np.log10(v.counts + 1.0)
        class_log = np.log10(v.class_tokens + v.class_types + 1.0)
        # symbol and log of the word's share of its class, by place
        symbol, share = np.arange(len(v.words)), np.zeros(len(v.words))
        for i in range(head, len(v.words)):
            symbol[i] = head + ending_class(v.words[i], classes)
            share[i] = base_log[i] - class_log[symbol[i] - head]
        base_log, end = base_log - math.log10(v.tokens + v.types + 1), v.symbols - 1
        base_end = math.log10((v.texts + 1) / (v.tokens + v.types + 1))
        unknown = -math.log10(v.tokens + v.types + 1)
        kind_of = _Classes(classes)
        for batch in sliced(batches_in, TEXTS):
            words, sizes = [], []
            for text in batch.column(0):
                found = words_of(text.as_py())
                words += found
                sizes.append(len(found))
            n, owner = batch.num_rows, np.repeat(np.arange(batch.num_rows), sizes)
            at = np.fromiter(map(place.get, words, repeat(-1)), dtype=np.int64, count=len(words))
            lost = np.flatnonzero(at < 0)
            far = [words[i] for i in lost.tolist()]
            kinds = np.fromiter(map(kind_of.__getitem__, far), dtype=np.int64, count=len(far))
            code, inside, base = (x[at] if len(v.words) else np.zeros(len(at)) for x in (symbol, share, base_log))
            code[lost], inside[lost], base[lost] = head + kinds, -class_log[kinds], unknown
            symbols = np.full(len(words) + n, end, dtype=np.int32)  # an end after each text
            symbols[np.arange(len(words)) + owner] = code
            ends = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64) + 1)])
            cuts, names, times, lists = np.searchsorted(owner[lost], np.arange(n + 1)).tolist(), [], [], [0]
            for low, high in zip(cuts, cuts[1:]):
                counts = Counter(far[low:high])
                names += counts.keys()
                times += counts.values()
                lists.append(len(names))
            # without a word in the slice the counts come as whole numbers
            added = lambda w: np.bincount(owner, weights=w, minlength=n).astype(np.float64)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[1:],
                pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends * 4), pa.py_buffer(symbols)]).cast(pa.binary()),
                pa.array(np.diff(ends)), pa.array(added(at >= 0).astype(np.int64) + int(v.texts > 0)),
                pa.array(added(base) + base_end), pa.array(added(inside)),
                pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(times, pa.int64())], ["word", "times"])),
            ], [*batch.schema.names[1:], "symbols", "n_tokens", "n_known", "base", "inside", "far"])
            if len(kind_of) > HELD:
                kind_of.clear()

    rows = docs.select(
        F.col(f"`{text}`").cast("binary").alias("text"), F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key}`").cast("bigint").alias("doc_id"), train.alias("train"))
    coded = rows.mapInArrow(
        task, "row bigint, doc_id bigint, train boolean, symbols binary, n_tokens bigint, n_known bigint, base double, "
        "inside double, far array<struct<word:binary,times:bigint>>")
    path = work_dir(docs.sparkSession, "coded")
    coded.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


@dataclass
class Model:
    start: np.ndarray  # [state]
    move: np.ndarray  # [from, to]
    emit: np.ndarray  # [symbol, state]


def first_model(unigram: np.ndarray, states: int) -> Model:
    """Unigram emissions, shaken so that states differ; states tend to stay."""
    random = np.random.default_rng(5)
    emit = unigram[:, None] * np.exp(random.normal(0, 0.8, size=(len(unigram), states)))
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


class _Forward:
    """Forward numbers of every token of some sequences, by position, brought back to a sum of 1 now and then."""

    def __init__(self, model: Model, symbols: np.ndarray, lengths: np.ndarray):
        self.layout = layout = Layout(lengths)
        self.laid = np.empty(len(symbols), dtype=np.int64)
        self.laid[layout.place] = symbols
        self.emitted = np.take(model.emit, self.laid, axis=0)
        self.alpha = alpha = np.empty_like(self.emitted)
        self.steps = list(layout.steps())
        ones, taken, before = np.ones(alpha.shape[1]), np.zeros(len(lengths)), 0
        #: what the numbers of each token were divided by
        self.scale = np.ones(len(alpha))
        for t, (at, n) in enumerate(self.steps):
            here = alpha[at : at + n]
            if t:
                np.matmul(alpha[before : before + n], model.move, out=here)
                here *= self.emitted[at : at + n]
            else:
                np.multiply(self.emitted[:n], model.start, out=here)
            if t % RESCALED == RESCALED - 1:
                scale = here @ ones
                here /= scale[:, None]
                taken[:n] += np.log(scale)
                self.scale[at : at + n] = scale
            before = at
        self.ends = layout.place[np.cumsum(lengths) - 1]
        #: natural log of each sequence's probability
        self.log = taken[layout.rank] + np.log(alpha[self.ends].sum(1))


def log_likelihood(model: Model, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log of each sequence's probability, by the scaled forward recursion."""
    return _Forward(model, symbols, lengths).log


class Expected:
    """Expected counts of starts, moves and emissions."""

    def __init__(self, model: Model):
        self.model = model
        self.start, self.move = np.zeros_like(model.start), np.zeros_like(model.move)
        self.emit, self.log = np.zeros(model.emit.shape), 0.0

    def add(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        model, forward = self.model, _Forward(self.model, symbols, lengths)
        alpha, steps = forward.alpha, forward.steps
        self.log += float(forward.log.sum())
        beta, ones = np.empty_like(alpha), np.ones(alpha.shape[1])
        beta[forward.ends] = 1  # the others are set from the tokens behind them
        ahead = forward.emitted  # becomes emission times backward number
        back = np.ascontiguousarray(model.move.T)
        for t in range(len(steps) - 1, 0, -1):
            at, n = steps[t]
            before = steps[t - 1][0]
            later, here = ahead[at : at + n], beta[before : before + n]
            later *= beta[at : at + n]
            np.matmul(later, back, out=here)
            if t % RESCALED == 0:
                here /= (here @ ones)[:, None]
        # shares of the states at each token; and of the moves into each token but the first ones
        first = steps[0][1]
        beta *= alpha
        total = beta @ ones
        beta /= total[:, None]
        self.start += beta[:first].sum(0)
        total *= forward.scale  # of all moves into a token
        before = forward.layout.before
        for low in range(first, len(alpha), 1 << 16):
            high = min(len(alpha), low + (1 << 16))
            later = ahead[low:high] / total[low:high, None]
            self.move += (np.take(alpha, before[low:high], axis=0).T @ later) * model.move
        states, laid = self.emit.shape[1], forward.laid
        del forward, alpha, ahead, before  # as large as the cells of the emissions
        cells = (laid[:, None] * states + np.arange(states)).ravel()
        self.emit += np.bincount(cells, weights=beta.ravel(), minlength=self.emit.size).reshape(self.emit.shape)

    def pieces(self) -> Iterator[tuple[int, bytes]]:
        head = np.concatenate([self.start, self.move.ravel(), [self.log]])
        yield -1, head.tobytes()
        for low in range(0, len(self.emit), PIECE):
            part = self.emit[low : low + PIECE]
            if part.any():
                yield low, part.tobytes()


def _sequences(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols and lengths of batches of sequences, and their places; those of like length together, as all walk in step."""
    texts = [np.frombuffer(x.as_buffer(), dtype=np.int32) for x in column]
    order = np.argsort([len(t) for t in texts], kind="stable") if texts else np.zeros(0, np.int64)
    lengths = np.array([len(texts[i]) for i in order], dtype=np.int64)
    for low, high in batches(lengths.tolist(), TOKENS):
        yield np.concatenate([texts[i] for i in order[low:high]]), lengths[low:high], order[low:high]


def baum_welch(coded: DataFrame, model: Model, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """The model after some rounds over all training sequences, and their log likelihood before each round."""
    spark, prior, logs = coded.sparkSession, None, []
    train = coded.where("train").select("symbols")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def task(batches_in: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            expected = Expected(shared.value)
            for batch in batches_in:
                for symbols, lengths, _ in _sequences(batch.column(0)):
                    expected.add(symbols, lengths)
            rows = list(expected.pieces())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["piece", "counts"])

        parts = added_pieces(train.mapInArrow(task, "piece bigint, counts binary"))
        if prior is None:
            prior = model.emit.mean(1)
        model, log = _maximised(model, parts, prior)
        logs.append(log)
        shared.unpersist()
    return model, logs


def _maximised(model: Model, parts: dict[int, np.ndarray], prior: np.ndarray) -> tuple[Model, float]:
    states = len(model.start)
    emit = np.zeros(model.emit.shape)
    for low, part in parts.items():
        if low >= 0:
            emit[low : low + PIECE] = part.reshape(-1, states)
    head = parts.get(-1, np.zeros(states + states * states + 1))
    start, move, log = head[:states] + 1.0, head[states:-1].reshape(states, states) + 1.0, float(head[-1])
    emit = emit + PRIOR * prior[:, None]
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0)), log


def _score(shared):
    def task(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            total = np.zeros(batch.num_rows)
            for symbols, lengths, places in _sequences(batch.column(0)):
                total[places] = log_likelihood(shared.value, symbols, lengths) / math.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(total)], [*batch.schema.names[1:], "path"])

    return task


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", states: int = STATES,
          rounds: int = ROUNDS) -> DataFrame:
    """Per document: id, whether it was trained on, token counts, log10 probabilities of base and model."""
    spark = docs.sparkSession
    ship(spark)
    known, counts = vocabulary(docs, train, key, text)
    coded = encode(docs, train, key, text, known)
    unigram = known.unigram()
    model, _ = baum_welch(coded, first_model(unigram, states), rounds)
    columns = ["row", "doc_id", "train", "n_tokens", "n_known", "base", "inside"]
    kinds = "row bigint, doc_id bigint, train boolean, n_tokens bigint, n_known bigint, base double, inside double"
    scored = coded.select("symbols", *columns).mapInArrow(_score(spark.sparkContext.broadcast(model)), f"{kinds}, path double")
    # words outside the broadcast head get their counts by a join on the word
    far = coded.select("row", F.explode("far").alias("far")).select("row", "far.word", "far.times")
    c = F.col("c")
    more = far.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(c + 1)).alias("log"))
    extra = F.coalesce("log", F.lit(0.0))
    return scored.join(more, "row", "left").select(
        "doc_id", "train", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"), (F.col("base") + extra).alias("base_score"),
        (F.col("path") + F.col("inside") + extra).alias("score"))


def op5_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = F.coalesce(hex_id() % 7 != 2, F.lit(True))
    scored = score(table(spark, sf_dir, "documents"), train)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
