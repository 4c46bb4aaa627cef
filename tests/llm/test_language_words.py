"""Words of a language: cut, counted and scored once."""

from __future__ import annotations

import sys
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from vendorlens.llm import language_id


def test_words_are_the_letters_of_tokens():
    characters = "".join(map(chr, [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]))
    text = "x".join(characters) + " a1b \t2² Ⅷ¼_ \x1cÉ-É　ǅ'\U0001d7d8\U00010400"
    by_letter = ["".join(c for c in token if c.isalpha()) for token in text.lower().split()]
    assert language_id.words_of(text) == [w for w in by_letter if w]
    assert language_id.words_of(None) == language_id.words_of(" 12 .") == []


def test_words_are_counted_by_language(monkeypatch):
    monkeypatch.setattr(language_id, "HELD", 3)
    rows = [("b", "Eins, eins. ZWEI"), ("a", "one 1 one!"), ("b", "drei vier"), ("a", None), ("b", "(eins)")]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["lang", "text"])
    found: dict = {}
    for part in language_id._count_words(iter([batch])):
        for r in part.to_pylist():
            found[r["lang"], r["word"]] = found.get((r["lang"], r["word"]), 0) + r["c"]
    assert found == {("b", "eins"): 3, ("b", "zwei"): 1, ("a", "one"): 2, ("b", "drei"): 1, ("b", "vier"): 1}


def test_a_word_is_scored_once_whatever_stands_beside_it(spark, monkeypatch):
    class Once(language_id.Model):
        def logs(self, words):
            assert len(set(words)) == len(words)
            return super().logs(words)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: SimpleNamespace(value=value))
    pieces = ["▁", "d", "o", "r", "w", "wo"]
    model = Once(pieces, ["x", "y"], np.random.default_rng(3).dirichlet(np.ones(len(pieces) + 1), 2).T)
    docs = spark.createDataFrame([(1, "word, (word) word. \"word\""), (2, "word word word word"), (3, "1, 2.")], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert found[1]["lang_pred"] == found[2]["lang_pred"] and found[1]["score"] == found[2]["score"] > 0.5
    assert found[3]["lang_pred"] == "und" and found[3]["score"] == 0
