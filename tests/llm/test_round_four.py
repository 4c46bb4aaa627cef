"""The driver's memory while the field is fitted."""

from __future__ import annotations

import tracemalloc

import numpy as np

from vendorlens.llm import toxicity


def test_fit_holds_few_numbers_per_token(monkeypatch):
    random = np.random.default_rng(2)
    words = [f"word{i}" for i in range(500)]
    texts = [" ".join(random.choice(words, 4_000)) + (" vile" if i % 2 else "") for i in range(100)]
    monkeypatch.setattr(toxicity, "STEPS", 2)
    tracemalloc.start()
    field = toxicity.fit_field(texts, [i % 2 for i in range(100)], {"vile$": True, "word7$": False})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert field.logistic is not None and field.emission("vile") > field.emission("word7")
    assert peak / sum(len(t.split()) for t in texts) < 130
