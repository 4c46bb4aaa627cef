"""Small tables with every odd case, and brute-force versions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; as columns of the input they must not matter.
CLASHES = [
    "row", "_file", "_row", "id", "digest", "sha256", "order", "best", "node", "n", "bands", "grams", "rank", "size", "bucket",
    "score", "spans", "word", "c", "k1", "k2", "place", "h", "host", "first", "_text", "c0", "c1", "train", "path", "mark",
]


def prose(seed: int, words: int, stock: int = 400) -> str:
    random_ = random.Random(seed)
    return " ".join(f"w{random_.randrange(stock)}x{random_.randrange(7)}" for _ in range(words))


def odd_rows() -> list[tuple]:
    long = prose(1, 30_000, 5_000)
    copy = prose(2, 120)
    near = copy.split()
    near[60] = "changed"
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r", "en", "a", 6), (None, "no id", None, "b", 5),
        (None, "no id", None, "b", 5), (4, long, "en", "b", len(long)), (5, copy, "en", "c", 1), (6, copy, "en", "c", 1),
        (7, copy.replace(" ", "\n "), "en", None, 1), (8, " ".join(near), "en", None, 1), (9, "one", "de", "c", 3),
        (10, "one two", "de", "c", 7), (11, "one two", "de", "c", 7), (11, "one two", "de", "c", 7), (12, "äöü ß 漢字 \U0001f600", "de", "ä", 9),
        (13, "1 2 3 ... !!!", None, "a", 13), (14, "x" * 5_000, "en", "a", 5_000), (15, copy + " " + prose(3, 80), "en", "a", 1),
    ]


def documents(spark: SparkSession, rows: list[tuple], clashes: bool = False) -> DataFrame:
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES]) if clashes else df


def bare(text: str | None) -> str:
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def near_links(rows: list[tuple[int, str]], threshold: float = 0.8) -> tuple[Counter, dict]:
    """Links and classes of ids by comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    links: Counter = Counter()
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            (i, s), (j, t) = sets[a], sets[b]
            if s and t and len(s & t) >= threshold * len(s | t) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return links, {i: find(i) for i in root}


def repeated_words(rows: list[tuple[int, str]], length: int) -> dict[int, set[int]]:
    """Word places of each id that lie in ``length`` words that another id has as well."""
    owners, words = defaultdict(set), {i: (t or "").encode().split() for i, t in rows}
    for i, w in words.items():
        for k in range(len(w) - length + 1):
            owners[tuple(w[k : k + length])].add(i)
    out: dict[int, set[int]] = {}
    for i, w in words.items():
        places = {p for k in range(len(w) - length + 1) if len(owners[tuple(w[k : k + length])]) > 1 for p in range(k, k + length)}
        if places:
            out[i] = places
    return out
