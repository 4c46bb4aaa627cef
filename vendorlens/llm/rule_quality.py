"""Text quality by a sparse ensemble of rules.

Statistics of a text (`STATISTICS`) are Spark columns: signs and words of a kind per word, lengths, repeated words and lines.
Shallow trees are grown on them by gradient boosting of the logistic loss; every path from a root to a node is
a rule, a conjunction of bounds on statistics. A logistic model with lasso weights over all rules keeps few of them; its
penalty is the greatest one whose loss on rows set aside is within a standard error of the
least. The kept rules are compiled into one Spark column, so texts are scored where they lie, without Python.

The model is fitted on a bounded sample of labelled rows: about `SAMPLE` of each kind and never more than `BOUND`, drawn by a
hash of the id and weighted back to their shares; only their statistics reach the driver. Nothing but the text enters a score.

NULL and empty texts have statistics of 0 and are scored like any other; texts are read whole. Labels with a NULL id or mark are
not learned from; a document with several labels is of quality 0 if one says so, and an id with several
rows is learned once, from its greatest statistics. Documents without a label are scored; repeated rows give repeated rows.
With labels of one kind or none the score is the smoothed share of quality 1, (ones + 1) / (labels + 2).
Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import SPACES, hex_id, staged, table

#: Labelled documents of each kind to fit on, about; the bound of a kind.
SAMPLE, BOUND = 8_000, 12_000
#: Trees, their depth, share of rows of a tree, least rows of a node, rate of boosting, cuts of a statistic.
TREES, DEPTH, PART, LEAF, RATE, CUTS = 40, 3, 0.5, 20, 0.2, 48
#: Penalties to try, as shares of the least one that leaves no rule; steps of the fit for each; share of rows set aside.
PENALTIES, STEPS, ASIDE = (0.2, 0.1, 0.05, 0.025, 0.012, 0.006), 120, 0.2
#: Score from which a text is predicted to be of quality 1.
ACCEPT = 0.7

#: Patterns that are counted in a text, per word.
COUNTED = {
    "capitals": r"\p{Lu}{2,}",
    "symbols": r"[#$%&*@^~<>=+|_\\/{}\[\]]+",
    "marks_in_a_row": r"[!?.,;:*#$%&]{2,}",
    "stops": r"[.!?][\x20\x09-\x0D]",
    "commas": r"[,;:]",
    "digits": r"[0-9]+",
    "long_words": r"\p{L}{16,}",
}
STATISTICS = ("words", "lines", "word_length", "distinct_words", "distinct_lines", "repeats", *COUNTED)


def _numbers(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """The statistics, by name."""
    n, rows = (F.greatest(F.size(x), F.lit(1)).cast("double") for x in (words, lines))
    next_ = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("b"))
    found = {
        "words": F.size(words),
        "lines": rows / n,
        "word_length": F.length(text) / n,
        "distinct_words": F.size(F.array_distinct(words)) / n,
        "distinct_lines": F.size(F.array_distinct(lines)) / rows,
        "repeats": F.size(F.filter(next_, lambda x: x["a"] == x["b"])) / n,
    }
    return found | {name: F.regexp_count(text, F.lit(pattern)) / n for name, pattern in COUNTED.items()}


def measured(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """``keep`` of ``df``, and the statistics of ``text``, rounded so that equal texts have equal ones."""
    whole = F.coalesce(df[f"`{text}`"].cast("string"), F.lit(""))
    parts = lambda marks: F.array_remove(F.split(whole, marks), "")
    held = df.select(*[df[f"`{c}`"] for c in keep], F.struct(
        whole.alias("text"), parts(f"[{SPACES}]+").alias("words"), parts("\n").alias("lines")).alias("_t"))
    found = _numbers(F.col("_t.text"), F.col("_t.words"), F.col("_t.lines"))
    numbers = F.struct(*[F.round(found[name].cast("double"), 9).alias(name) for name in STATISTICS])
    return held.select(*[F.col(f"`{c}`") for c in keep], numbers.alias("_s"))


@dataclass
class Rule:
    """A conjunction of bounds (statistic, above, up to; either may be None) and its weight."""

    bounds: tuple[tuple[str, float | None, float | None], ...]
    weight: float

    def column(self) -> Column:
        sides = [F.col(f"_s.{name}") > low for name, low, _ in self.bounds if low is not None]
        sides += [F.col(f"_s.{name}") <= high for name, _, high in self.bounds if high is not None]
        held = sides[0]
        for side in sides[1:]:
            held = held & side
        return F.when(held, F.lit(self.weight)).otherwise(F.lit(0.0))

    def __str__(self) -> str:
        sides = [f"{'' if low is None else f'{low:.6g} < '}{name}{'' if high is None else f' <= {high:.6g}'}" for name, low, high in self.bounds]
        return f"{self.weight:+.4f} if " + " and ".join(sides)


@dataclass
class Ensemble:
    """Rules and the bias of their weighted sum."""

    bias: float
    rules: list[Rule]

    def column(self) -> Column:
        """The score as a column over the statistics ``_s``."""
        total = F.lit(self.bias)
        for rule in self.rules:
            total = total + rule.column()
        return 1 / (1 + F.exp(-total))


def _grow(bins: np.ndarray, slope: np.ndarray, curve: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray]) -> tuple[list, np.ndarray]:
    """A tree by its nodes' bounds (statistic to lowest and highest bin), and its values on all rows."""
    width = max(map(len, cuts)) + 1
    offsets = np.arange(bins.shape[1]) * width
    nodes, value = [], np.zeros(len(bins))
    open_ = [({}, np.arange(len(bins)), rows)]
    for depth in range(DEPTH + 1):
        below = []
        for bounds, all_, mine in open_:
            if bounds:
                nodes.append(bounds)
            value[all_] = -RATE * slope[mine].sum() / (curve[mine].sum() + 1.0)
            if depth == DEPTH or len(mine) < 2 * LEAF:
                continue
            place = (bins[mine] + offsets).ravel()
            sums = [
                np.bincount(place, weights=None if w is None else np.repeat(w[mine], bins.shape[1]), minlength=width * bins.shape[1])
                .reshape(-1, width).cumsum(axis=1) for w in (slope, curve, None)]
            (g, h, n), gain = sums, 0.0
            left, right = g**2 / (h + 1.0), (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1.0)
            gain = left + right - g[:, -1:] ** 2 / (h[:, -1:] + 1.0)
            gain[(n < LEAF) | (n[:, -1:] - n < LEAF)] = 0.0
            f, cut = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[f, cut] <= 1e-6:
                continue
            low, high = bounds.get(f, (-1, width))
            for side, new in ((True, (low, min(high, cut))), (False, (max(low, cut), high))):
                below.append((bounds | {f: new}, all_[(bins[all_, f] <= cut) == side], mine[(bins[mine, f] <= cut) == side]))
        open_ = below
    return nodes, value


def _paths(bins: np.ndarray, y: np.ndarray, w: np.ndarray, cuts: list[np.ndarray]) -> list[dict]:
    """The paths of boosted trees, each once."""
    random, total = np.random.default_rng(11), np.full(len(y), np.log((w @ y) / (w @ (1 - y))))
    found: dict[tuple, dict] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        rows = np.flatnonzero(random.random(len(y)) < PART)
        nodes, value = _grow(bins, w * (p - y), w * p * (1 - p), rows, cuts)
        total += value
        found |= {tuple(sorted(n.items())): n for n in nodes}
    return list(found.values())


def _lasso(z: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float, start: np.ndarray, lipschitz: float) -> np.ndarray:
    """Weights (the last one is the bias, which is free) by accelerated proximal steps."""
    b = ahead = start
    momentum, step = 1.0, 1.0 / lipschitz
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-(z @ ahead[:-1] + ahead[-1])))
        off = w * (p - y)
        new = ahead - step * np.append(off @ z, off.sum())
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0.0)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / after * (new - b)
        b, momentum = new, after
    return b


def fit_rules(x: np.ndarray, y: np.ndarray, w: np.ndarray, names: tuple[str, ...]) -> Ensemble:
    """An ensemble for rows of statistics ``x`` with marks ``y`` and weights ``w``; both marks must occur."""
    w = w / w.sum()
    cuts = []
    for column in x.T:
        values = np.unique(column)
        middles = (values[1:] + values[:-1]) / 2
        cuts.append(np.unique(middles[np.linspace(0, len(middles) - 1, min(CUTS, len(middles))).astype(int)]) if len(middles) else middles)
    bins = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T)], axis=1)
    paths = _paths(bins, y, w * len(y), cuts)
    held = [np.logical_and.reduce([(bins[:, f] > low) & (bins[:, f] <= high) for f, (low, high) in p.items()]) for p in paths]
    distinct = {h.tobytes(): i for i, h in reversed(list(enumerate(held)))}  # of equal rules the first
    chosen = sorted(i for i in distinct.values() if 0 < held[i].sum() < len(y))
    if not chosen:
        return Ensemble(float(np.log((w @ y) / (w @ (1 - y)))), [])
    z = np.stack([held[i] for i in chosen], axis=1).astype(np.float32)
    scale = np.sqrt(np.maximum(w @ z * (1 - w @ z), 1e-4))
    z = (z / scale).astype(np.float32)
    aside = np.random.default_rng(13).random(len(y)) < ASIDE
    v = np.ones(z.shape[1] + 1)
    for _ in range(30):  # the greatest curvature of the loss
        u = w * (z @ v[:-1] + v[-1])
        v = np.append(u @ z, u.sum())
        top = np.linalg.norm(v)
        v /= top
    lipschitz = 0.3 * top
    prior = w @ y
    most = np.abs((w * (prior - y)) @ z).max()
    b = np.append(np.zeros(z.shape[1]), np.log(prior / (1 - prior)))
    inside = np.where(aside, 0.0, w)
    tries = []
    for share in PENALTIES:
        b = _lasso(z, y, inside / inside.sum(), share * most, b, lipschitz * 1.5)
        t = z[aside] @ b[:-1] + b[-1]
        loss = np.logaddexp(0, t) - y[aside] * t
        part = w[aside] / w[aside].sum()
        mean = part @ loss
        tries.append((mean, float(np.sqrt((part**2) @ (loss - mean) ** 2)), share, b))
    best = min(tries, key=lambda t: t[0])
    _, _, share, b = next(t for t in tries if t[0] <= best[0] + best[1])
    b = _lasso(z, y, w, share * most, b, lipschitz)
    rules = []
    for i, weight in zip(chosen, b[:-1] / scale):
        if weight:
            rules.append(Rule(tuple(
                (names[f], float(cuts[f][low]) if low >= 0 else None, float(cuts[f][high]) if high < len(cuts[f]) else None)
                for f, (low, high) in sorted(paths[i].items())), round(float(weight), 6)))
    return Ensemble(round(float(b[-1]), 6), rules)


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, key: str = "doc_id", text: str = "text", mark: str = "quality") -> Ensemble:
    """Learn from the labels of ids for which ``train`` (over ``doc_id``) holds."""
    marks = labels.select(labels[f"`{key}`"].cast("bigint").alias("doc_id"), labels[f"`{mark}`"].cast("int").alias("mark"))
    marks = marks.where("doc_id IS NOT NULL AND mark IN (0, 1)").where(F.lit(True) if train is None else train)
    marks = staged(marks.groupBy("doc_id").agg(F.min("mark").alias("mark")), "marks")
    counts = {r["mark"]: r["n"] for r in marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    alone = Ensemble(float(np.log((ones + 1) / (zeros + 1))), [])
    if not ones or not zeros:
        return alone
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    drawn = [marks.where((F.col("mark") == m) & (place < int(min(1.0, SAMPLE / n) * (1 << 30)))).limit(BOUND) for m, n in counts.items()]
    sample = staged(drawn[0].unionByName(drawn[1]), "sample")  # 2 * BOUND rows at most, so it may go to all tasks
    rows = docs.select(docs[f"`{key}`"].cast("bigint").alias("doc_id"), docs[f"`{text}`"].alias("text")).join(F.broadcast(sample), "doc_id")
    found = measured(rows, "text", "doc_id", "mark").groupBy("doc_id", "mark").agg(F.max("_s").alias("_s")).collect()
    found.sort(key=lambda r: r["doc_id"])
    y = np.array([r["mark"] for r in found], dtype=float)
    if not 0 < y.sum() < len(y):
        return alone
    w = np.where(y == 1, ones / y.sum(), zeros / (len(y) - y.sum()))
    return fit_rules(np.array([list(r["_s"]) for r in found]), y, w, STATISTICS)


def score(docs: DataFrame, model: Ensemble, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score and prediction of each document."""
    rows = docs.select(docs[f"`{key}`"].cast("bigint").alias("doc_id"), docs[f"`{text}`"].alias("text"))
    scored = measured(rows, "text", "doc_id").select("doc_id", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def op11_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(hex_id(), F.lit(4)) == 2, F.lit(False))
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
