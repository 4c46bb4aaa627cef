"""Rules, hard negatives and periodic runs against brute force, SQL and held-out marks."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vendorlens.llm import hard_negatives, periodic_runs, rule_quality

from .cases import CLASHES, documents, odd_rows, prose

# periodic runs


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Every stretch with a smallest period, by trying all periods."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(words[i : i + length - d] == words[i + d : i + length] for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        digest("".join("%d,%d,%d\n" % r for r in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9)), max_size=5), min_size=1, max_size=5))
def test_runs_of_any_texts(parts):
    texts = [[w for base, times in text for w in base * times] for text in parts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    found = periodic_runs.runs(np.array([w for t in texts for w in t], dtype=np.int64), bounds)
    assert [tuple(r) for r in found.tolist()] == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t)]


def test_runs_are_found_again_where_hashes_err(monkeypatch):
    """With hashes that call every two stretches equal, a lot is done again with others."""
    monkeypatch.setattr(periodic_runs.Hashes, "__init__", _weak(periodic_runs.Hashes.__init__))
    words = np.array([1, 2, 3] * 9 + [4, 5] * 7 + [6] * 30 + [7, 8, 9, 7, 8], dtype=np.int64)
    found = periodic_runs.runs(words, np.array([0, len(words)]))
    assert [tuple(r)[1:] for r in found.tolist()] == plain_runs(words.tolist())


def _weak(make):
    def init(self, words, seed):
        make(self, words, seed)
        if seed < 3:  # every stretch looks like every other
            self.parts = [(np.zeros_like(p), np.zeros_like(q)) for p, q in self.parts]

    return init


def test_a_grammar_derives_its_texts():
    """Parts that the grammar joins stand side by side, and every place of a nonterminal holds the same words."""
    random_ = random.Random(3)
    texts = [[random_.randrange(5) for _ in range(random_.randrange(60))] for _ in range(20)] + [[1, 2, 3, 4] * 20] * 2
    words = np.array([w for t in texts for w in t], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    grammar = periodic_runs.Grammar(words, bounds)
    place, size = np.concatenate(grammar.place), np.concatenate(grammar.size)
    for numbers, places in grammar.made:
        for x, at in zip(numbers.tolist(), places.tolist()):
            assert (words[at : at + size[x]] == words[place[x] : place[x] + size[x]]).all()
    whole = {(int(at), int(size[x])) for numbers, places in grammar.made for x, at in zip(numbers, places)}
    assert all((int(b), len(t)) in whole for b, t in zip(bounds, texts) if len(t) > 1)


def test_periodic_runs_of_documents(spark):
    folded = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    rows = odd_rows() + [(i, prose(i, 150 + i), "en", "a", 1) for i in folded] + [(900, "a b " * 400 + "c " * 50, "en", "a", 1)]
    rows = [r if len(r[1] or "") < 100_000 else (r[0], prose(1, 3_000, 5_000) + " x" * 9, *r[2:]) for r in rows]  # trying all periods is slow
    found = periodic_runs.periodic_runs(documents(spark, rows, clashes=True), fold=periodic_runs.folded_places).collect()
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted(((r["doc_id"], *(r[c] for c in names)) for r in found), key=key) == sorted(((r[0], *plain_row(r[0], r[1])) for r in rows), key=key)
    assert sum(r["n_runs"] > 0 for r in found) >= 8


# hard negatives

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain_negatives(rows: list[tuple]) -> list[tuple]:
    """All scores, sorted; ``rows`` are (id, numbers, label)."""
    usable = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    order = lambda s, i: (-s, i is None, i or 0)
    out = []
    for a, (i, v, label) in enumerate(usable):
        if i is None or i % 100:
            continue
        scores = [(sum(x * y for x, y in zip(v, w)), j, m) for b, (j, w, m) in enumerate(usable) if b != a]
        positives = sorted((order(s, j), j, s) for s, j, m in scores if m == label)[:5]
        for _, p, positive in positives:
            inside = sorted((order(s, j), j, s) for s, j, m in scores if m != label and 80 * positive <= 100 * s <= 100 * positive)
            out += [(i, p, r, j, positive, s) for r, (_, j, s) in enumerate(inside[:5], 1)]
    return sorted(out, key=str)


def mined(spark, rows):
    codes = hard_negatives.coded(spark.createDataFrame(rows, VECTORS), turned_label=hard_negatives._next_label)
    return sorted((tuple(r) for r in hard_negatives.mine(codes, codes.where(F.col("id") % 100 == 0)).collect()), key=str)


def test_hard_negatives_against_all_scores(spark, monkeypatch):
    random_ = np.random.default_rng(5)
    centres = random_.standard_normal((6, 24))
    rows = []
    for i in range(700):
        label = i % 3
        v = centres[(i + i // 90) % 6] + 0.4 * random_.standard_normal(24)
        rows.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), label))
    rows += [(i, rows[3][1], 2) for i in range(700, 760)]  # many equal vectors
    rows += [(100, rows[5][1], 1), (100, rows[5][1], 1), (8, rows[8][1], 1)]  # equal ids
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 2_000)  # some blocks
    found = mined(spark, rows)
    assert found == plain_negatives(rows) and len(found) > 100


def test_hard_negatives_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.5]
    rows = [
        (100, one, 1), (1, one, 1), (None, one, 1), (2, [0.9, 0.5], 2), (3, None, 2), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2), (6, one, None),
        (200, [], 1), (9, [], 1), (300, [0.5], 3), (301, [0.5, 0.0, 0.1], 3), (302, [0.45], 4), (None, [0.9, 0.5], 2), (400, [-1.0, 0.0], 5), (401, [1.0, 0.0], 5),
    ]
    assert mined(spark, rows) == plain_negatives(rows)
    assert mined(spark, []) == [] and mined(spark, [(100, [1e30], 1), (200, [1e30], 1)]) == []
    clash = spark.createDataFrame(rows, VECTORS).select("*", *[F.lit("clash").alias(c) for c in CLASHES if c != "label"])
    assert hard_negatives.coded(clash).count() == 12


def test_intervals_hold_the_scores(spark):
    random_ = np.random.default_rng(6)
    rows = [(i * 50, (random_.standard_normal(70) * 10.0 ** random_.integers(-3, 3)).astype(np.float32).tolist(), 0) for i in range(300)]
    codes = hard_negatives.coded(spark.createDataFrame(rows, VECTORS)).collect()
    block = hard_negatives.Block([r for r in codes if r["id"] % 100 == 0])
    packed = np.stack([np.frombuffer(bytes(r["code"]), np.uint64) for r in codes])
    least, most = block.intervals(slice(None), packed, np.array([r["along"] for r in codes]), np.array([r["rest"] for r in codes]))
    scores = block.vector @ np.stack([np.frombuffer(bytes(r["vector"]), np.int64) for r in codes]).T
    assert (least <= scores).all() and (scores <= most).all()
    assert ((most - least) < 1.5 * block.size[:, None] * np.array([r["size"] for r in codes])).all()


# quality rules


def junk(seed: int) -> str:
    words = prose(seed, 80).split()
    return " ".join(w + "***" for w in words) if seed % 2 else " ".join(w.upper() for w in words)


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, prose(i, 40 + i % 50) if i % 5 else junk(i), "en", "a", 1) for i in range(600)]
    labels = [(i, int(i % 5 > 0), 0) for i in range(500)] + [(1, 0, 0), (None, 1, 1), (7, None, 0)]
    return documents(spark, rows, clashes=True), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_of_documents_without_label(spark, judged):
    docs, labels = judged
    model = rule_quality.fit(docs, labels)
    found = {r["doc_id"]: r for r in rule_quality.score(docs, model).collect()}
    assert len(found) == 600 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())
    assert sum(found[i]["predicted"] == (i % 5 > 0) for i in range(500, 600)) >= 99
    assert 0 < len(model.rules) < 200 and all(str(r) for r in model.rules)


def test_compiled_rules_score_like_their_bounds(spark, judged):
    docs, labels = judged
    model = rule_quality.fit(docs, labels)
    rows = rule_quality.measured(docs, "text", "doc_id").select("doc_id", "_s", model.column().alias("score")).collect()
    for r in rows:
        inside = [x.weight for x in model.rules if all((a is None or r["_s"][n] > a) and (b is None or r["_s"][n] <= b) for n, a, b in x.bounds)]
        assert math.isclose(r["score"], 1 / (1 + math.exp(-model.bias - sum(inside))), rel_tol=1e-9)


def test_lasso_meets_its_conditions():
    """At the optimum a kept weight's slope is the penalty, and no other slope is greater."""
    random_ = np.random.default_rng(2)
    z = (random_.random((400, 12)) < 0.4).astype(float)
    y = (random_.random(400) < 1 / (1 + np.exp(-(2 * z[:, 0] - 2 * z[:, 1])))).astype(float)
    w, b = np.full(400, 1 / 400), np.zeros(13)
    for _ in range(20):
        b = rule_quality._lasso(z, y, w, 0.02, b, 3.0)
    off = w * (1 / (1 + np.exp(-(z @ b[:-1] + b[-1]))) - y)
    slope, kept = off @ z, b[:-1] != 0
    assert np.allclose(slope[kept], -0.02 * np.sign(b[:-1][kept]), atol=1e-5) and (np.abs(slope) <= 0.02 + 1e-5).all()
    assert abs(off.sum()) < 1e-5 and kept[0] and kept[1] and kept.sum() < 12


def test_statistics_of_texts(spark):
    texts = [(1, None), (2, ""), (3, "Aa aa aa.\nBB | 12, c"), (4, "one")]
    rows = {r["doc_id"]: r["_s"] for r in rule_quality.measured(spark.createDataFrame(texts, "doc_id int, text string"), "text", "doc_id").collect()}
    assert rows[1] == rows[2] and rows[2]["words"] == 0
    s = rows[3]
    assert (s["words"], s["lines"], s["distinct_words"]) == (7, round(2 / 7, 9), 1) and s["capitals"] == s["symbols"] == round(1 / 7, 9)
    assert s["repeats"] == 0 and s["digits"] == s["commas"] == s["stops"] == round(1 / 7, 9)


def test_labels_of_one_kind(spark):
    docs = documents(spark, odd_rows())
    ones = spark.createDataFrame([(i, 1, 0) for i in range(4, 9)], "doc_id bigint, quality int, toxic int")
    assert {round(r["score"], 9) for r in rule_quality.score(docs, rule_quality.fit(docs, ones)).collect()} == {round(6 / 7, 9)}
    assert {r["score"] for r in rule_quality.score(docs, rule_quality.fit(docs, ones.limit(0))).collect()} == {0.5}
