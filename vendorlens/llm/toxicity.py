"""Toxic spans by a linear-chain conditional random field, summed up to document scores.

A token is tagged *toxic* or *other*. Its features are its word and the word's beginnings of
four to six letters, so that inflected forms share weights. The labels name documents, not tokens, so labelled tokens are made
first: a token of a toxic document is labelled toxic if one of its features occurs in far more
toxic than clean documents. Weights of features and tag transitions are then fitted by
gradient steps on forward-backward expectations. Marginals of all tokens of a whole text give
the expected number of toxic tokens and the surest one; a logistic fit on those is the score.

The model is fitted on a bounded sample of labelled rows (`SAMPLE`, `FIT`), chosen by a hash
of the id from texts of all lengths; every document is scored over its whole text, and neither labels nor any column but the text
enter a score. NULL and empty texts score as texts without toxic tokens. Labels with NULL id or
mark are not learned from; a document with several labels is toxic if one says so. Documents
without a label are scored like any other; repeated ids give repeated rows. Without usable labels of both kinds, scores are
0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .chains import Layout, batches
from .common import hex_id, ship, sliced, staged, table

#: Labelled documents that feature counts are learned from: (toxic, clean).
SAMPLE = (8_000, 16_000)
#: Of these, how many go to one file: every file that a task writes to a local folder makes its executor start a process.
IN_FILE = 1_000
#: Of these, how many of each kind the field's weights are fitted on at most, and the characters to draw for each of them:
#: texts of any length are drawn whole until `FIT` * `FIT_CHARS` characters of a kind are reached.
FIT, FIT_CHARS = 1_000, 8_000
#: Most informative features kept, and steps of the fit.
FEATURES, STEPS = 20_000, 60
#: Least toxic documents times log lift of a feature that marks tokens as toxic.
MARK = 25.0
#: Moves between tokens whose shares are held at once while fitting.
MOVES = 1 << 17
#: Words whose scores a task remembers before it forgets them all.
REMEMBERED = 150_000

_EDGES = re.compile(r"^\W+|\W+$")
SPANS = "array<struct<start:int,end:int>>"


def features(token: str) -> list[str]:
    """The word and its beginnings; ``token`` is lower case."""
    word = _EDGES.sub("", token)
    if not word:
        return []
    return [word + "$"] + [word[:n] for n in (4, 5, 6) if len(word) >= n]


@dataclass
class Field:
    """Weights of features for the toxic tag, its bias, log weights of transitions, the score's logistic."""

    weights: dict[str, float]
    bias: float
    transitions: np.ndarray  # [from, to], 1 is toxic
    logistic: np.ndarray | None = None

    def emission(self, token: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(token))

    def marginals(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of the toxic tag for each token of sequences that follow each other."""
        layout = Layout(lengths)
        odds = np.empty(len(emissions))
        odds[layout.place] = np.exp(np.clip(emissions, -30, 30))
        forward, backward = _messages(odds, layout, np.exp(self.transitions))
        both = forward * backward
        return (both / (both + (1 - forward) * (1 - backward)))[layout.place]

    def evidence(self, marginals: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per sequence: log of 1 + expected toxic tokens that are likelier toxic than not, and the surest one."""
        out = np.zeros((len(lengths), 2))
        sure = np.where(marginals >= 0.5, marginals, 0.0)
        filled = np.flatnonzero(lengths)
        if len(filled):
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])[filled]
            out[filled, 0] = np.log1p(np.add.reduceat(sure, first))
            out[filled, 1] = np.maximum.reduceat(marginals, first)
        return out

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        if self.logistic is None:
            return np.zeros(len(evidence))
        return 1 / (1 + np.exp(-(self.logistic[0] + evidence @ self.logistic[1:])))


def _messages(odds: np.ndarray, layout: Layout, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages, each as the toxic share of the two."""
    forward, backward = np.empty_like(odds), np.full_like(odds, 0.5)
    steps = list(layout.steps())
    before = None
    for at, n in steps:
        here = odds[at : at + n]
        if before is None:
            share = here / (1 + here)
        else:
            q = before[:n]
            toxic = here * (q * move[1, 1] + (1 - q) * move[0, 1])
            share = toxic / (toxic + q * move[1, 0] + (1 - q) * move[0, 0])
        forward[at : at + n] = before = share
    for (at, _), (after, n) in zip(reversed(steps[:-1]), reversed(steps[1:])):
        b = backward[after : after + n]
        toxic, other = odds[after : after + n] * b, 1 - b
        up = move[1, 1] * toxic + move[1, 0] * other
        backward[at : at + n] = up / (up + move[0, 1] * toxic + move[0, 0] * other)
    return forward, backward


def fit_field(texts: list[str], toxic: list[int], marks: dict[str, bool]) -> Field:
    """Fit on tokens labelled through ``marks`` (feature -> whether it marks a toxic token)."""
    known = {f: i for i, f in enumerate(marks)}
    marking = np.array(list(marks.values()), dtype=bool)
    words: dict[str, int] = {}
    seen: list[list[int]] = []
    ids, lengths = [], []
    for text in texts:
        tokens = text.lower().split()
        lengths.append(len(tokens))
        for t in tokens:
            if t not in words:
                words[t] = len(words)
                seen.append([known[f] for f in features(t) if f in known])
            ids.append(words[t])
    ids, lengths = np.array(ids, dtype=np.int32), np.array(lengths, dtype=np.int64)
    flags = np.array([bool(fs) and bool(marking[fs].any()) for fs in seen], dtype=bool)
    gold = flags[ids] & np.repeat(np.array(toxic, dtype=bool), lengths)
    # (word, feature) pairs, to spread expectations over features
    pair_word = np.repeat(np.arange(len(seen)), np.array([len(fs) for fs in seen], dtype=np.int64))
    pair_feature = np.array([f for fs in seen for f in fs], dtype=np.int64)

    layout = Layout(lengths)
    y = np.empty(len(ids)); y[layout.place] = gold
    steps = list(layout.steps())
    tail = np.concatenate([np.arange(after, after + n, dtype=np.int32) for after, n in steps[1:]]) if len(steps) > 1 else np.zeros(0, np.int32)
    head = np.concatenate([np.arange(at, at + n, dtype=np.int32) for (at, _), (_, n) in zip(steps, steps[1:])]) if len(steps) > 1 else tail
    laid = np.empty(len(ids), dtype=np.int32); laid[layout.place] = ids

    weights, bias, moves = np.zeros(len(known)), -4.0, np.zeros((2, 2))
    parameters = np.concatenate([weights, [bias], moves.ravel()])
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    gold_words = np.bincount(laid, weights=y, minlength=len(seen))
    gold_moves = np.array([[((1 - y[head]) * (1 - y[tail])).sum(), ((1 - y[head]) * y[tail]).sum()],
                           [(y[head] * (1 - y[tail])).sum(), (y[head] * y[tail]).sum()]])
    for step in range(1, STEPS + 1):
        weights, bias, moves = parameters[: len(known)], parameters[len(known)], parameters[-4:].reshape(2, 2)
        by_word = bias + np.bincount(pair_word, weights=weights[pair_feature], minlength=len(seen))
        odds = np.exp(np.clip(by_word, -30, 30))[laid]
        move = np.exp(moves)
        f, b = _messages(odds, layout, move)
        p = f * b
        rest = (1 - f) * (1 - b)
        rest += p
        p /= rest
        del rest
        joint = np.zeros((2, 2))
        for low in range(0, len(head), MOVES):  # the driver holds a slice's moves at a time
            h, t = head[low : low + MOVES], tail[low : low + MOVES]
            fh, bt, ot = f[h], b[t], odds[t]
            share = np.stack([(1 - fh) * move[0, 0] * (1 - bt), (1 - fh) * move[0, 1] * ot * bt,
                              fh * move[1, 0] * (1 - bt), fh * move[1, 1] * ot * bt])
            share /= share.sum(0)
            joint += share.sum(1).reshape(2, 2)
        off = gold_words - np.bincount(laid, weights=p, minlength=len(seen))
        del odds, f, b, p
        gradient = np.concatenate([
            np.bincount(pair_feature, weights=off[pair_word], minlength=len(known)) - 0.05 * weights,
            [off.sum()], (gold_moves - joint).ravel() - 1.0 * moves.ravel(),
        ])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        parameters = parameters + 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights, bias, moves = parameters[: len(known)], parameters[len(known)], parameters[-4:].reshape(2, 2)
    field = Field({f: float(w) for f, w in zip(known, weights)}, float(bias), moves.copy())
    del laid, y, head, tail, layout
    emissions = (bias + np.bincount(pair_word, weights=weights[pair_feature], minlength=len(seen)))[ids]
    field.logistic = _logistic(field.evidence(field.marginals(emissions, lengths), lengths), np.array(toxic, dtype=float))
    return field


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -4, 4)
    return w


def _count_features(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each kind that hold a feature, summed per task as far as memory allows."""
    counts = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([counts[1][f] for f in names], pa.int64()),
             pa.array([counts[0][f] for f in names], pa.int64())], ["feature", "toxic", "clean"])
        for c in counts:
            c.clear()
        return out

    for batch in batches_in:
        for text, toxic in zip(batch.column(0), batch.column(1)):
            words = set((text.as_py() or "").lower().split())
            counts[toxic.as_py()].update({f for w in words for f in features(w)})
            if len(counts[0]) + len(counts[1]) > REMEMBERED:
                yield flush()
    yield flush()


def labelled(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """Text and mark of at most ``sample`` (toxic, clean) labelled documents."""
    marks = (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("mark"))
        .where(F.col("id").isNotNull() & F.col("mark").isin(0, 1) & (hex_id("id") % 5 != 0))
        .groupBy("id").agg(F.max("mark").alias("mark"))
    )
    chosen = [
        marks.where(F.col("mark") == mark).orderBy(F.xxhash64("id"), "id").limit(n)
        for mark, n in ((1, sample[0]), (0, sample[1]))
    ]
    some = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most the sample's rows
    return docs.select(F.col("doc_id").alias("id"), "text").join(some, "id").select("id", "text", "mark")


def fit(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> Field:
    """Learn the field from a bounded sample of labelled documents."""
    ship(docs.sparkSession)
    # few rows of all tasks: as many files as the sample needs, not one for each task that read a part of the documents
    rows = staged(labelled(docs, labels, sample).repartition(-(-sum(sample) // IN_FILE)), "toxic-sample")
    sizes = {r["mark"]: r["n"] for r in rows.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Field({}, -10.0, np.zeros((2, 2)))
    counts = (
        rows.select("text", "mark").mapInArrow(_count_features, "feature string, toxic long, clean long")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 1")
    )
    # log likelihood ratio of the feature against the kind of document
    rate = (F.col("toxic") + 0.5) / sizes[1], (F.col("clean") + 0.5) / sizes[0]
    lift = rate[0] / rate[1]
    best = (
        counts.withColumn("lift", lift).where("lift > 1.5")
        .orderBy(F.desc(F.col("toxic") * F.log("lift")), "feature").limit(FEATURES).collect()
    )
    # a mark is far commoner in toxic documents, and too often so for chance
    marks = {r["feature"]: r["lift"] > 10 and r["toxic"] * math.log(r["lift"]) > MARK for r in best}
    fitted = [(text, mark) for mark in (1, 0) for text in drawn(rows.where(F.col("mark") == mark))]
    if len({mark for _, mark in fitted}) < 2:
        return Field({}, -10.0, np.zeros((2, 2)))
    return fit_field([text for text, _ in fitted], [mark for _, mark in fitted], marks)


def drawn(rows: DataFrame) -> list[str]:
    """Whole texts in the order of their ids' hashes, whatever their lengths: at most `FIT`, until the characters are reached.

    The text that reaches them is the last one.
    """
    rows = rows.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("id").alias("_h"), "id")
    order = ("_h", "id", F.xxhash64("text"))
    sizes = rows.orderBy(*order).limit(FIT).select("_h", F.length("text").alias("n")).collect()
    if not sizes:
        return []
    total = np.cumsum([r["n"] for r in sizes])
    count = min(len(sizes), int(np.searchsorted(total, FIT * FIT_CHARS)) + 1)
    # only texts up to the last one wanted are sorted with their content
    return [r["text"] for r in rows.where(F.col("_h") <= sizes[count - 1]["_h"]).orderBy(*order).limit(count).collect()]


def _spans(text: str, toxic: np.ndarray) -> list[dict]:
    """Offsets of runs of toxic tokens."""
    out: list[dict] = []
    last = False
    for token, hit in zip(re.finditer(r"\S+", text), toxic):
        if hit and last:
            out[-1]["end"] = token.end()
        elif hit:
            out.append({"start": token.start(), "end": token.end()})
        last = hit
    return out


def score(docs: DataFrame, field: Field, columns: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` with ``score`` and ``spans`` (code-point offsets of toxic spans)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)  # at most FEATURES weights

    def task(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, known = shared.value, {}
        for batch in sliced(batches_in):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            scores, spans = np.zeros(len(texts)), [[]] * len(texts)
            sizes = [t.count(" ") + 1 for t in texts]  # near enough to cut batches
            for low, high in batches(sizes):
                parts = []
                for t in texts[low:high]:  # one text's tokens at a time
                    words = t.lower().split()
                    for w in set(words).difference(known):
                        known[w] = field.emission(w)
                    parts.append(np.fromiter(map(known.__getitem__, words), dtype=float, count=len(words)))
                lengths, emissions = np.array([len(x) for x in parts]), np.concatenate(parts)
                marginals = field.marginals(emissions, lengths)
                scores[low:high] = field.scores(field.evidence(marginals, lengths))
                first = np.concatenate([[0], np.cumsum(lengths)])
                hits = np.flatnonzero(marginals >= 0.5)
                for i in np.unique(np.searchsorted(first, hits, side="right") - 1):
                    spans[low + i] = _spans(texts[low + i], marginals[first[i] : first[i + 1]] >= 0.5)
                if len(known) > REMEMBERED:
                    known = {}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                [*batch.schema.names[1:], "score", "spans"])

    kept = docs.select(F.col(f"`{text}`").alias("_text"), *[docs[f"`{c}`"] for c in columns])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    return kept.mapInArrow(task, f"{schema}, score double, spans {SPANS}")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; all columns."""
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"
    scored = score(named, fit(docs, labels), tuple(named.columns), text)
    return scored.where(F.col("score") < threshold).select(*named.columns).toDF(*docs.columns)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    held_out: Column = F.coalesce(hex_id() % 5 == 0, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )
