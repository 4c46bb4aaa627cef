"""Recursions along many token sequences at once, one numpy step per position.

Tokens of a batch are laid out by position: first the first tokens of all sequences (longest
sequence first), then the second ones, and so on. A step then works on one contiguous slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Tokens that are laid out at once; a longer sequence is laid out alone.
BATCH_TOKENS = 1 << 19


class Layout:
    """Positions of the tokens of sequences with the given lengths."""

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")  # sequences, longest first
        self.rank = np.empty(len(lengths), dtype=np.int64)
        self.rank[self.order] = np.arange(len(lengths))
        longest = int(lengths.max()) if len(lengths) else 0
        # sequences that have a token at position t
        self.active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
        self.starts = np.concatenate([[0], np.cumsum(self.active)])
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
        within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        #: place of each token (given sequence after sequence) in the layout
        self.place = self.starts[within] + np.repeat(self.rank, lengths)

    @property
    def before(self) -> np.ndarray:
        """For each place the place of the token before it (of first tokens: no sense)."""
        step = np.concatenate([[0], self.starts[:-2]]) - self.starts[:-1] if len(self.active) else np.zeros(0, np.int64)
        return np.arange(int(self.starts[-1])) + np.repeat(step, self.active)

    def steps(self) -> Iterator[tuple[int, int]]:
        """Start and number of tokens of each position."""
        return zip(self.starts[:-1].tolist(), self.active.tolist())


def batches(lengths: list[int], most: int = BATCH_TOKENS) -> Iterator[tuple[int, int]]:
    """Ranges of sequences with at most ``most`` tokens together."""
    first = tokens = 0
    for i, n in enumerate(lengths):
        if i > first and tokens + n > most:
            yield first, i
            first, tokens = i, 0
        tokens += n
    if first < len(lengths):
        yield first, len(lengths)


def added_pieces(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sums of arrays by piece: ``parts`` has ``piece`` and ``counts`` (float64 bytes).

    Pieces of one place meet in one partition, which holds their sum only; the sums, a model's size, are returned.
    """

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in rows:
            for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(counts.as_buffer(), dtype=np.float64)
                sums[piece] = sums[piece] + part if piece in sums else part.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["piece", "counts"])

    rows = parts.select("piece", "counts").repartition("piece").mapInArrow(add, "piece bigint, counts binary").collect()
    return {r["piece"]: np.frombuffer(bytes(r["counts"]), np.float64) for r in rows}
