"""Expected emissions of the hidden Markov model."""

from __future__ import annotations

import numpy as np

from vendorlens.llm import hmm


def test_emissions_of_all_states_are_added_in_one_pass(monkeypatch):
    random = np.random.default_rng(4)
    model = hmm.first_model(random.dirichlet(np.ones(30)), 4)
    lengths = np.array([1, 5, 40, 40, 300])
    symbols = random.integers(0, 30, lengths.sum())
    expected, calls, plain = hmm.Expected(model), [], np.bincount

    def counted(*args, **named):
        calls.append(1)
        return plain(*args, **named)

    monkeypatch.setattr(hmm.np, "bincount", counted)
    expected.add(symbols, lengths)
    monkeypatch.undo()
    assert len(calls) == 1
    assert np.allclose(expected.emit.sum(1), np.bincount(symbols, minlength=30))
    assert np.allclose(expected.start.sum(), 5) and np.allclose(expected.move.sum(), (lengths - 1).sum())
