"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vendorlens.llm import (
    chains, common, components, decontamination, exact_dedup, hmm, language_id, mixing, ngram_join, suffix_dedup, toxicity, url_filter, warc,
)

from ..compare import difference
from .cases import bare, documents, near_links, odd_rows, prose, repeated_words


def test_exact_dedup_against_grouping(spark):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 11]
    found = {r["doc_id"]: r for r in exact_dedup.exact_dedup(documents(spark, rows)).collect()}
    groups: dict[str, list] = {}
    for r in rows:
        groups.setdefault(bare(r[1]), []).append(r)
    for text, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0]))[0]
        for r in members:
            got = found[r[0]]
            assert (got["keep_id"], got["group_size"], got["kept"]) == (keep, len(members), r[0] == keep)
            assert got["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_exact_dedup_resolves_equal_digests(spark):
    """With a digest of one hex digit many different texts hit each other."""
    rows = [(i, f"text {i % 40}", "en", "a", 1) for i in range(120)]
    docs = documents(spark, rows)
    found = exact_dedup.exact_dedup(docs, digest=lambda c: F.substring(F.sha2(c, 256), 1, 1)).collect()
    assert len(found) == 120
    assert all(r["keep_id"] == r["doc_id"] % 40 and r["group_size"] == 3 for r in found)


def test_exact_dedup_state_grows_over_calls(spark):
    source, folder = common.work_dir(spark, "records"), common.work_dir(spark, "state")
    for low, high in ((0, 30), (30, 60)):
        docs = documents(spark, [(i, f"t{i % 20}", "en", "a", 1) for i in range(low, high)])
        exact_dedup.records(docs, "doc_id", "text", exact_dedup.sha256).write.mode("append").parquet(source)
        state = exact_dedup.stream_into_state(spark, source, folder, batch_bytes=4_000).collect()
    assert len(state) == 20
    assert sorted(r["best"]["id"] for r in state) == list(range(20)) and all(r["group_size"] == 3 for r in state)


def test_rows_in_loses_no_row(spark):
    rows = common.staged(spark.range(1_000).select(F.lit("f").alias("_file"), F.col("id").alias("_row")), "rows")
    for bits in (32_768, 1 << 20):
        clear, marked = common.rows_in(rows, rows.where("_row % 7 = 0"), bits=bits)
        assert clear.where("_row % 7 = 0").count() == 0
        assert clear.count() + marked.count() == 1_000


def test_filter_grows_with_its_keys(spark):
    """Up to its bound the filter has sixteen bits for each key, so few rows are marked in vain, however many keys there are."""
    assert common.filter_bits(0) == common.filter_bits(1_000) == 1 << 20 and common.filter_bits(10**7) == 1 << 28
    assert common.filter_bits(10**12) == common.MOST_BITS
    rows = common.staged(spark.range(3_000_000).select(F.lit("f").alias("_file"), F.col("id").alias("_row")), "rows")
    keys = rows.where("_row % 2 = 0")  # more than the bits of the least filter
    _, marked = common.rows_in(rows, keys)
    assert marked.where("_row % 2 = 0").count() == 1_500_000 and marked.where("_row % 2 = 1").count() < 150_000


def test_marginals_against_all_taggings():
    field = toxicity.Field({"bad$": 4.0}, -2.0, np.array([[0.3, -0.5], [0.1, 1.2]]))
    words = ["bad", "good", "bad", "x"]
    emissions = np.array([field.emission(w) for w in words])
    weights = {}
    for tags in np.ndindex(*[2] * 4):
        score = sum(e for e, t in zip(emissions, tags) if t) + sum(field.transitions[a, b] for a, b in zip(tags, tags[1:]))
        weights[tags] = math.exp(score)
    total = sum(weights.values())
    want = [sum(w for t, w in weights.items() if t[i]) / total for i in range(4)]
    got = field.marginals(np.concatenate([emissions[:2], emissions]), np.array([2, 4]))
    assert np.allclose(got[2:], want)


def test_toxicity_on_held_out_documents(spark):
    random_ = random.Random(4)
    stems, rows, labels = ["vile", "grubb", "skunk"], [], []
    for i in range(600):
        words = prose(i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(random_.randrange(len(words)), random_.choice(stems) + random_.choice(["", "est", "ig", "on", "a" * (i % 5)]))
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    docs = documents(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, marks)).collect()
    held = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = [(r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in held]
    assert sum(right) >= 0.97 * len(right)
    texts = dict((r[0], r[1]) for r in rows)
    hit = [texts[r["doc_id"]][s["start"] : s["end"]] for r in scored if r["doc_id"] % 4 == 0 for s in r["spans"]]
    assert hit and all(any(x in h for x in stems) for h in hit)
    # offsets are those of the text, also where lower case is longer
    marked = [r for r in scored if r["doc_id"] % 4 == 0 and r["spans"]][:5]
    longer = documents(spark, [(r["doc_id"], "İİİ İ\u2003" * 3 + texts[r["doc_id"]], "en", "a", 1) for r in marked])
    for r in toxicity.score(longer, toxicity.fit(docs, marks)).collect():
        text = "İİİ İ\u2003" * 3 + texts[r["doc_id"]]
        assert r["spans"] and all(any(x in text[s["start"] : s["end"]] for x in stems) for s in r["spans"])


@pytest.mark.parametrize("clean_words", [60, 2_500])
def test_toxicity_learns_from_long_documents(spark, clean_words):
    """Toxic documents, then all documents, are longer than 8,000 characters."""
    rows, labels = [], []
    for i in range(160):
        toxic = i % 4 == 0
        words = prose(i, 2_500 if toxic else clean_words).split()
        if toxic:
            for k in range(6):
                words.insert(300 * k + i, "vile" + "a" * (k % 3))
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    docs = documents(spark, rows)
    field = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    if clean_words > 60:  # unseen texts, longer still; without long clean texts to learn from they cannot be told apart
        rows += [(1_000, prose(1_000, 6_000), "en", "a", 1), (1_001, prose(1_001, 6_000) + " vile vilea vileaa vile", "en", "a", 1)]
    scored = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.score(documents(spark, rows), field).collect()}
    assert scored == {i: i == 1_001 or (i < 1_000 and i % 4 == 0) for i in scored}


def _distance(pattern, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(pattern):
        now = [i + 1]
        for j, b in enumerate(text):
            now.append(min(before[j] + (a != b), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before), before.index(min(before))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.lists(st.integers(0, 3), max_size=14))
def test_edit_distance(pattern, text):
    assert decontamination.edit_distance(pattern, text) == _distance(pattern, text)


def test_decontamination_against_all_passages(spark):
    random_ = random.Random(3)
    items = [(i, prose(1_000 + i, 12 + 3 * i, 2_000)) for i in range(12)]
    rows = []
    for i in range(120):
        words = prose(i, 200, 2_000).split()
        if i % 3:
            item = items[i % 12][1].split()
            for _ in range(int(len(item) * random_.choice([0, 0.1, 0.2, 0.4]))):
                item[random_.randrange(len(item))] = f"edit{random_.randrange(99)}"
            at = random_.randrange(150)
            words[at:at] = [w.upper() + "," if i % 2 else w for w in item]
        rows.append((i, "\n ".join(words), "en", "a", 1))
    want = {}
    for i, text, *_ in rows:
        for k, item in items:
            pattern = item.split()
            best = _distance(pattern, text.lower().replace(",", "").split())[0]
            if best <= int(0.2 * len(pattern)):
                want[i, k] = best
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.find(docs, benchmark).collect()
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in found}
    assert set(got) <= set(want) and len(got) >= 0.95 * len(want)
    assert all(got[k] >= want[k] for k in got)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        passage = texts[r["doc_id"]][r["start"] : r["end"]].lower().replace(",", "").split()
        assert abs(len(passage) - r["item_words"]) <= 0.2 * r["item_words"]
    kept = {r["doc_id"] for r in decontamination.drop_contaminated(docs, benchmark).collect()}
    assert kept == {r[0] for r in rows} - {i for i, _ in got}


@pytest.mark.parametrize("words", [60, 200, 500])
def test_recall_of_a_single_long_item(words):
    """One item alone in its size class; fresh edit patterns at the most edits a match may have."""
    index, random_ = decontamination.Index([(0, prose(77, words, 5_000))]), np.random.default_rng(123)
    item = index.items[0][1]
    edited = [decontamination._edited(item, int(0.2 * len(item)), random_) for _ in range(200)]
    filler = decontamination.Normal()(prose(78, 100, 5_000))
    found = index.search([np.concatenate([filler, e, filler]) for e in edited])
    assert sum(map(bool, found)) >= 0.93 * len(edited)  # 95 % less the chance of 200 draws


def test_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 30)
    items = [(i, prose(50 + i, 25)) for i in range(4)]
    docs = documents(spark, [(i, prose(9 + i, 30) + " " + t + " " + prose(7 * i, 9), "en", "a", 1) for i, t in items])
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontamination.find(docs, benchmark).collect()) == [(i, i) for i in range(4)]
    assert decontamination.drop_contaminated(docs, benchmark).count() == 0


def test_mix_meets_targets(spark):
    random_ = random.Random(8)
    sizes = {"a": 40, "b": 300, "c": 500, "d": 80, None: 60}
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((len(rows), "w " * int(random_.paretovariate(1.3) * 12), "en", source, 1))
    docs = documents(spark, rows)
    found = mixing.mix(docs).toPandas()
    assert mixing.mix(docs.repartition(5)).toPandas().sort_values("doc_id")["taken"].tolist() == found.sort_values("doc_id")["taken"].tolist()
    by_id = {r[0]: r for r in rows}
    found["source"] = [by_id[i][3] or "~null" for i in found["doc_id"]]
    assert all(s == len(by_id[i][1].split()) for i, s in zip(found["doc_id"], found["size"]))
    assert (found["taken"] <= 2 * found["size"]).all()
    totals = found.groupby("source")["size"].sum().sort_index()
    weights, open_ = np.array([5, 2, 1, 5, 2], dtype=float), np.ones(5, dtype=bool)
    want, total = np.zeros(5), 1.5 * totals.sum()
    while True:
        want[open_] = (total - want[~open_].sum()) * weights[open_] / weights[open_].sum()
        over = open_ & (want > 2 * totals.values + 1e-9)
        if not over.any():
            break
        want[over] = 2 * totals.values[over]
        open_ &= ~over
    per = found.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert np.allclose(per["target"].values, want)
    assert (abs(per["taken"] - per["target"]) <= 0.005 * per["target"]).all()


def test_mixing_rows_of_one_id(spark, monkeypatch):
    """Equal rows are one entry of a bucket, and are all written out."""
    monkeypatch.setattr(mixing, "WRITTEN", 100)
    rows = [(None if i % 2 else 7, "a b c", "en", "hot", 1) for i in range(1_000)] + [(i, "w " * (i % 30), "en", "b", 1) for i in range(400)]
    found = mixing.mix(documents(spark, rows)).toPandas()
    assert len(found) == 1_400 and (found["doc_id"].isna().sum(), (found["doc_id"] == 7).sum()) == (500, 501)
    hot = found[found["source_size"] == 3_000]
    assert len(hot) == 1_000 and abs(hot["taken"].sum() - hot["target"].iloc[0]) <= 3 and hot["copies"].between(0, 2).all()


def test_ranks_over_ranges(spark):
    frame = spark.createDataFrame([(f"s{i:03d}",) for i in range(500)] + [(None,)], "source string").repartition(7)
    ranked = mixing.ranked(frame, "source").orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(501))
    assert [r["source"] for r in ranked] == [f"s{i:03d}" for i in range(500)] + [None]


def test_forward_and_expectations_against_all_paths():
    random_ = np.random.default_rng(2)
    emit = random_.random((4, 2)); emit /= emit.sum(0)
    move = random_.random((2, 2)); move /= move.sum(1, keepdims=True)
    model = hmm.Model(np.array([0.3, 0.7]), move, emit)
    sequences = [[0, 1, 3], [2], [1, 1, 0, 2]]
    expected, moves, logs = np.zeros((4, 2)), np.zeros((2, 2)), []
    for s in sequences:
        paths = {}
        for path in np.ndindex(*[2] * len(s)):
            p = model.start[path[0]] * emit[s[0], path[0]]
            for a, b, x in zip(path, path[1:], s[1:]):
                p *= move[a, b] * emit[x, b]
            paths[path] = p
        total = sum(paths.values())
        logs.append(math.log(total))
        for path, p in paths.items():
            for x, k in zip(s, path):
                expected[x, k] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
    flat, lengths = np.concatenate(sequences), np.array([3, 1, 4])
    assert np.allclose(hmm.log_likelihood(model, flat, lengths), logs)
    counts = hmm.Expected(model)
    counts.add(flat, lengths)
    assert np.allclose(counts.emit, expected, atol=1e-5) and np.allclose(counts.move, moves, atol=1e-5)
    assert math.isclose(counts.log, sum(logs))


def test_base_score_and_learning(spark, monkeypatch):
    monkeypatch.setattr(hmm, "HEAD", 60)
    monkeypatch.setattr(hmm, "COUNTED", 90)
    texts = [(i, prose(i, 40, 50) if i % 2 else prose(i, 40, 50).replace("w", "v"), "en", "a", 1) for i in range(80)]
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    found = {r["doc_id"]: r for r in hmm.score(documents(spark, texts), train, states=2, rounds=5).collect()}
    tokens = {i: t.encode().lower().split() + ["END"] for i, t, *_ in texts}
    counts = Counter(x for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for x in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in counts for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    held = [r for r in found.values() if not r["train"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_baum_welch_never_loses_likelihood(spark):
    docs = documents(spark, [(i, prose(i, 30, 20), "en", "a", 1) for i in range(40)])
    known, _ = hmm.vocabulary(docs, F.lit(True), "doc_id", "text")
    coded = hmm.encode(docs, F.lit(True), "doc_id", "text", known)
    _, logs = hmm.baum_welch(coded, hmm.first_model(known.unigram(), 3), 5)
    assert all(b >= a - 30 for a, b in zip(logs, logs[1:])) and logs[-1] > logs[0]  # the prior costs a little


def test_symbol_probabilities_add_up(spark):
    docs = documents(spark, [(i, prose(i, 30, 20), "en", "a", 1) for i in range(10)])
    known, _ = hmm.vocabulary(docs, F.lit(True), "doc_id", "text")
    model = hmm.first_model(known.unigram(), 4)
    assert np.allclose(model.emit.sum(0), 1) and np.allclose(model.move.sum(1), 1)


def test_layout_against_loops():
    lengths = np.array([2, 0, 5, 1])
    layout = chains.Layout(lengths)
    values = np.arange(8)
    laid = np.empty(8, dtype=int)
    laid[layout.place] = values
    assert [laid[a : a + n].tolist() for a, n in layout.steps()] == [[2, 0, 7], [3, 1], [4], [5], [6]]
    assert list(chains.batches([3, 3, 9, 1], 6)) == [(0, 2), (2, 3), (3, 4)]


def test_segmentations_against_all_cuts():
    pieces = ["▁", "▁a", "a", "ab", "b", "ba"]
    random_ = np.random.default_rng(6)
    chances = random_.random((7, 1)); chances /= chances.sum()
    model = language_id.Model(pieces, ["x"], chances)

    def brute(word: str) -> float:
        if not word:
            return 1.0
        total = 0.0
        for n in range(1, len(word) + 1):
            head = word[:n]
            if head in pieces:
                total += chances[pieces.index(head), 0] * brute(word[n:])
            elif n == 1:
                total += chances[6, 0] * brute(word[1:])
        return total

    words = ["a", "abba", "zab", "baab", "b"]
    assert np.allclose(np.exp(model.logs(words))[:, 0], [brute("▁" + w) for w in words])
    lattice = language_id.Lattice(words, model.pieces)
    share = lattice.expected(chances[lattice.piece, 0])
    # every letter lies in one piece of each segmentation
    covered = np.bincount(lattice.word, weights=share * (lattice.end - lattice.start), minlength=len(words))
    assert np.allclose(covered, [len(w) + 1 for w in words])


def test_long_words_and_tiny_probabilities():
    """Words of 40 and 4,000 letters, with probabilities of 1e-14, against decimals of any size; plain sums and logarithms agree."""
    pieces = ["▁", "▁a", "a", "ab", "b", "ba", "abab"]
    chances = np.array([1e-3, 1e-14, 1e-14, 1e-9, 1e-14, 1e-5, 1e-14, 1e-14])[:, None] * np.array([[1.0, 0.5]])
    model = language_id.Model(pieces, ["x", "y"], chances)

    def exact(word: str, k: int) -> float:
        sums = [Decimal(1)]
        for j in range(1, len(word) + 1):
            here = Decimal(0)
            for n in range(1, min(4, j) + 1):
                part = word[j - n : j]
                if part in pieces:
                    here += sums[j - n] * Decimal(chances[pieces.index(part), k])
                elif n == 1:
                    here += sums[j - n] * Decimal(chances[-1, k])
            sums.append(here)
        return float(sums[-1].ln())

    words = ["ab" * 20, "a", "abba" * 10, "z" * 33, "ab" * 2_000, "baz" * 500]
    found = model.logs(words)
    assert np.isfinite(found).all()
    assert np.allclose(found, [[exact("▁" + w, k) for k in range(2)] for w in words], rtol=1e-9)
    kinds = {plain for _, _, plain in model.lattices(words)}
    assert kinds == {True, False}
    lattice = language_id.Lattice(["abab" * 6, "b"], model.pieces)
    c = chances[lattice.piece, 0]
    assert np.allclose(lattice.expected(c * np.exp(model.lift[0] * lattice.size)), lattice.expected_from_logs(np.log(c)), rtol=1e-9)
    expected = model.expected(words, np.array([0, 1, 0, 1, 0, 1]), np.array([1, 2, 1, 1, 3, 1]))
    sizes = np.array([len(p) for p in pieces] + [1])
    letters = [sum(n * (len(w) + 1) for w, n, of in zip(words, [1, 2, 1, 1, 3, 1], [0, 1, 0, 1, 0, 1]) if of == k) for k in range(2)]
    assert np.allclose(expected @ sizes, letters)


def test_languages_of_words_without_spaces(spark):
    rows = [(i, ("abcde" if i % 2 else "vwxyz") * (20 + 40 * (i % 5)), "aa" if i % 2 else "bb", "s", 1) for i in range(40)]
    docs = documents(spark, rows + [(40, "a" * 5_000 + "!" + "b" * 3_000, "aa", "s", 1)])
    found = {r["doc_id"]: r for r in language_id.identify(docs, language_id.learn(docs, F.col("doc_id") < 30, "lang", "text")).collect()}
    assert all(found[r[0]]["lang_pred"] == r[2] for r in rows) and all(0 <= r["score"] <= 1 for r in found.values())


def test_language_ties_go_to_the_first(spark):
    docs = documents(spark, [(1, "same words", "bb", "s", 1), (2, "same words", "aa", "s", 1), (3, "words", None, "s", 1)])
    found = {r["doc_id"]: r for r in language_id.identify(docs, language_id.learn(docs, F.lit(True), "lang", "text")).collect()}
    assert found[3]["lang_pred"] == "aa" and math.isclose(found[3]["score"], 0.5)


def test_language_on_held_out_documents(spark):
    random_ = random.Random(1)
    letters = {"aa": "abcdeilmnorst", "bb": "fghkpquvwxyzo", "cc": "äöüßeinrst"}
    rows = []
    for i in range(300):
        lang = "aa bb cc".split()[i % 3]
        rows.append((i, " ".join("".join(random_.choices(letters[lang], k=5)) for _ in range(20)), lang, "s", 1))
    rows.append((300, "12 ... 34", "aa", "s", 1))
    docs = documents(spark, rows)
    model = language_id.learn(docs, F.col("doc_id") % 3 + F.col("doc_id") % 2 != 1, "lang", "text")
    found = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert sum(found[r[0]]["lang_pred"] == r[2] for r in rows[:300]) >= 297
    assert found[300]["lang_pred"] == "und" and found[300]["score"] == 0


def _near_rows() -> list[tuple]:
    random_ = random.Random(12)
    rows = []
    for g in range(60):
        base = prose(g, random_.choice([3, 8, 60, 200])).split()
        for _ in range(random_.choice([1, 1, 2, 5])):
            words = list(base)
            for _ in range(random_.choice([0, 0, 1, 2, 5])):
                words[random_.randrange(len(words))] = f"e{random_.randrange(50)}"
            rows.append((len(rows), " ".join(words), "en", "a", 1))
    rows += [(len(rows) + k, prose(77, 150) + f" end{k}", "en", "a", 1) for k in range(90)]  # a large bucket
    return rows


@pytest.mark.parametrize("small,block", [(64, 256), (4, 16)])
def test_ngram_join_against_all_pairs(spark, monkeypatch, small, block):
    """Workers import the module anew, so the block size reaches them through the plan only."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = _near_rows()
    links, classes = near_links([r[:2] for r in rows])
    found = {r["doc_id"]: r for r in ngram_join.ngram_join(documents(spark, rows), recall=0.999).collect()}
    assert {i: found[i]["n_links"] for i in found} == {r[0]: links[r[0]] for r in rows}
    assert {i: found[i]["class_id"] for i in found} == classes
    kept = {r["doc_id"] for r in ngram_join.drop_near_copies(documents(spark, rows)).collect()}
    assert kept == set(classes.values())


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.999):
        bands, rows = ngram_join.bands_for(0.8, recall, 320)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= 320


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7)]
    found = components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_repeated_spans_against_all_windows(spark):
    random_ = random.Random(21)
    passages = [prose(500 + i, n, 900) for i, n in enumerate((12, 20, 25, 40, 90))]
    rows = []
    for i in range(80):
        words = prose(i, 150, 900).split()
        for p in random_.sample(passages, random_.choice([0, 1, 1, 2])):
            at = random_.randrange(len(words))
            words[at:at] = p.split()
        rows.append((i, "\n".join(words), "en", "a", 1))
    rows += [(90, rows[0][1], "en", "a", 1), (91, "one " * 300, "en", "a", 1)]
    want = repeated_words([r[:2] for r in rows], 20)
    found: dict[int, set[int]] = {}
    for r in suffix_dedup.repeated_spans(documents(spark, rows), length=20, gram=8).collect():
        assert r["words"] >= 20
        found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    assert found == want


def test_repeats_of_a_run_over_many_tasks(spark):
    """One document's suffixes with the same first words fill several tasks; the other document follows inside the last one."""
    shared = [prose(900 + i, 60, 900) for i in range(8)]
    rows = [(0, "so " * 700, "en", "a", 1), (1, "so " * 40, "en", "a", 1)]
    rows += [(2 + i, shared[i % 8], "en", "a", 1) for i in range(16)]
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "false"), spark.conf.set(names[1], "8")
        found: dict[int, set[int]] = {}
        for r in suffix_dedup.repeated_spans(documents(spark, rows).coalesce(1), length=20, gram=8).collect():
            found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert found == repeated_words([r[:2] for r in rows], 20)


def test_archive_lookup(spark):
    hosts = ["b.example.org", "a.example.org", "example.org", "x.net"]
    pages = [(i, f"http://{hosts[i % 4]}/p/{i // 8}" if i % 50 else None, f"<p>{i % 90}</p>") for i in range(400)]
    archive = warc.write_archive(spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3), block_lines=16, file_bytes=20_000)
    everything = archive.read(archive.captures()).collect()
    assert sorted(r["page_id"] for r in everything) == list(range(400))
    first = {}
    for i, _, html in pages:
        first.setdefault(html, i)
    for r in everything:
        keep = first[f"<p>{r['page_id'] % 90}</p>"]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if keep == r["page_id"] else ("revisit", keep))
    asked = spark.createDataFrame([("http://example.org/p/3",), ("http://x.net/p/7#top",), ("http://none.org/",)], "url string")
    got = {r["page_id"] for r in archive.read(archive.lookup(asked)).collect()}
    assert got == {i for i, u, _ in pages if u in ("http://example.org/p/3", "http://x.net/p/7")}


def test_lookup_of_keys_that_fill_files(spark):
    """A key with most lines fills blocks and index files; every line is found once, whoever asks how often."""
    pages = [(i, "http://hot.org/x" if i % 3 else f"http://h{i % 7}.org/{i}", f"<p>{i % 50}</p>") for i in range(900)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or one task would write the index
    try:
        archive = warc.write_archive(frame, block_lines=16)
        assert archive.index.count() > 2
        found = [r["page_id"] for r in archive.read(archive.lookup(frame.unionByName(frame))).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(found) == list(range(900))


def test_folders_that_tasks_can_open():
    assert warc.openable("file:///a/b") == "file:///a/b" and warc.openable("/a/b") == "/a/b" and warc.openable("s3a://b/k") == "s3://b/k"
    with pytest.raises(ValueError):
        warc.openable("wasb://b/k")


def test_keys_sort_hosts_with_their_subdomains():
    assert warc.reversed_key("https://WWW.Example.org/a?b#c") == "org,example,www)/a?b"
    assert warc.reversed_key("http://example.org") == "org,example)/" and warc.reversed_key(None) == ""


def test_trust_travels_along_links(spark):
    """Trust flows with links, distrust against them; a dense matrix gives the same numbers."""
    hosts = ["good.org", "friend.com", "bad.net", "fan.com", "alone.com"]
    links = {"good.org": ["friend.com"], "friend.com": ["good.org", "friend.com"], "fan.com": ["bad.net"], "bad.net": ["fan.com"]}
    pages = [(i, f"http://{h}/{'fr/' if h == 'good.org' else 'x'}", "".join(f'<a href="http://{t}/">x</a>' for t in links.get(h, []))) for i, h in enumerate(hosts)]
    found = {r["host"]: r for r in url_filter.judge(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert found["fan.com"]["verdict"] == "block" and found["fan.com"]["rule"] is None
    assert found["friend.com"]["verdict"] == "allow" and found["friend.com"]["trust"] > 0 and found["alone.com"]["verdict"] == "allow"
    index = {h: i for i, h in enumerate(hosts)}
    w = np.zeros((5, 5))
    for a, bs in links.items():
        bs = [b for b in bs if b != a]
        for b in bs:
            w[index[a], index[b]] = 1 / len(bs)
    t = seed_t = np.array([1.0, 0, 0, 0, 0])
    d = seed_d = np.array([0, 0, 1.0, 0, 0])
    for _ in range(url_filter.ROUNDS):
        t, d = 0.15 * seed_t + 0.85 * w.T @ t, 0.15 * seed_d + 0.85 * w @ d
    assert np.allclose([found[h]["trust"] for h in hosts], t / 0.15) and np.allclose([found[h]["distrust"] for h in hosts], d / 0.15)


def test_longest_rule_and_first_of_equal_ones(spark):
    rules = (("allow", "a.org", "/x"), ("block", "b.a.org", ""), ("block", "a.org", "/y"), ("allow", "org", "/y/zz"), ("block", "a.org", "/x"))
    pages = [(1, "http://b.a.org/x", None), (2, "http://a.org/x", None), (3, "http://a.org/y/zz", None), (4, "http://b.a.org/q", None)]
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(
        spark.createDataFrame(pages, "page_id bigint, url string, html string"), rules).collect()}
    assert found == {1: ("a.org/x", "allow"), 2: ("a.org/x", "allow"), 3: ("org/y/zz", "allow"), 4: ("b.a.org", "block")}


def test_url_sql_with_links_between_hosts(spark, tmp_path):
    """The SQL settles too, over links that the given pages do not have."""
    random_ = random.Random(9)
    hosts = [f"h{i}.{'net' if i % 5 == 0 else 'org' if i % 7 == 0 else 'com'}" for i in range(40)]
    pages = [(i, f"http://{random_.choice(hosts)}/{random_.choice(['fr/', 'x', 'y/z'])}", "".join(
        f'<a href="http://{random_.choice(hosts)}/">x</a>' for _ in range(random_.randrange(3)))) for i in range(150)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = url_filter.op10_url_filter(spark, str(tmp_path)).toPandas()
    import duckdb

    with duckdb.connect() as connection:
        connection.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        assert difference(found, connection.sql(url_filter.ORACLE).df()) is None
    assert (found["rule"].isna() & (found["verdict"] == "block")).any()


def test_trust_of_long_chains_is_settled(spark):
    """Hosts more than ten links from a seed, and a cycle, against the solved linear system."""
    hosts = ["h0.net", *[f"h{i}.com" for i in range(1, 13)], "good.org", "friend.com"]
    links = {hosts[i]: [hosts[i - 1]] for i in range(1, 13)} | {"good.org": ["friend.com"], "friend.com": ["good.org"] + [f"x{i}.com" for i in range(9)]}
    pages = [(i, f"http://{h}/{'fr/' if h == 'good.org' else 'x'}", "".join(f'<a href="http://{t}/">x</a>' for t in links.get(h, []))) for i, h in enumerate(hosts)]
    found = {r["host"]: r for r in url_filter.judge(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    index = {h: i for i, h in enumerate(hosts + [f"x{i}.com" for i in range(9)])}
    w = np.zeros((len(index), len(index)))
    for a, bs in links.items():
        for b in bs:
            w[index[a], index[b]] = 1 / len(bs)
    seed_t, seed_d = np.zeros(len(index)), np.zeros(len(index))
    seed_t[index["good.org"]] = seed_d[index["h0.net"]] = 1.0
    t, d = np.linalg.solve(np.eye(len(index)) - 0.85 * w.T, seed_t), np.linalg.solve(np.eye(len(index)) - 0.85 * w, seed_d)
    assert np.allclose([found[h]["trust"] for h in hosts], [t[index[h]] for h in hosts], atol=1e-8)
    assert np.allclose([found[h]["distrust"] for h in hosts], [d[index[h]] for h in hosts], atol=1e-8)
    assert [found[h]["verdict"] for h in hosts[1:13]] == ["block"] * 4 + ["allow"] * 8
