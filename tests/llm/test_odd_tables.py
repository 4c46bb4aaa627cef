"""Nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vendorlens.llm import (
    decontamination, exact_dedup, hmm, language_id, mixing, ngram_join, periodic_runs, rule_quality, suffix_dedup, toxicity,
    url_filter, warc,
)

from .cases import CLASHES, documents, odd_rows

BENCHMARK = [(1, "the quick brown fox jumps over the lazy dog again and again"), (None, "no id " * 8), (3, None), (4, ""), (5, "tiny")]
LABELS = [(5, 1, 0), (6, 1, 1), (9, 0, 1), (10, None, None), (None, 1, 1), (12, 1, 0), (12, 1, 0), (2, 1, 1), (14, 1, 0)]


def _train():
    return F.lit(True)


def _benchmark(spark):
    return spark.createDataFrame(BENCHMARK, "item_id bigint, text string")


def _labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


OPERATORS = {
    "exact": lambda spark, docs: exact_dedup.exact_dedup(docs),
    "near": lambda spark, docs: ngram_join.ngram_join(docs),
    "mix": lambda spark, docs: mixing.mix(docs),
    "language": lambda spark, docs: language_id.identify(docs, language_id.learn(docs, _train(), "lang", "text")),
    "toxicity": lambda spark, docs: toxicity.score(docs, toxicity.fit(docs, _labels(spark))),
    "hmm": lambda spark, docs: hmm.score(docs, _train(), states=2, rounds=2),
    "quality": lambda spark, docs: rule_quality.score(docs, rule_quality.fit(docs, _labels(spark))),
    "runs": lambda spark, docs: periodic_runs.periodic_runs(docs, fold=periodic_runs.folded_places),
}
FILTERS = {
    "exact": lambda spark, docs: exact_dedup.drop_exact_copies(docs),
    "near": lambda spark, docs: ngram_join.drop_near_copies(docs),
    "benchmark": lambda spark, docs: decontamination.drop_contaminated(docs, _benchmark(spark)),
    "toxicity": lambda spark, docs: toxicity.drop_toxic(docs, _labels(spark)),
}
MATCHES = {
    "suffix": lambda spark, docs: suffix_dedup.repeated_spans(docs),
    "benchmark": lambda spark, docs: decontamination.find(docs, _benchmark(spark)),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_per_document(spark, name):
    docs = documents(spark, odd_rows(), clashes=True)
    found = OPERATORS[name](spark, docs).select("doc_id").toPandas()["doc_id"].tolist()
    key = lambda x: (x != x, x)
    assert sorted((float("nan") if x is None else x for x in found), key=key)[:16] == sorted(float(r[0]) for r in odd_rows() if r[0])
    assert len(found) == len(odd_rows())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_keep_columns(spark, name):
    docs = documents(spark, odd_rows(), clashes=True)
    kept = FILTERS[name](spark, docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert 0 < len(rows) <= len(odd_rows())
    assert all(r[c] == "clash" for r in rows for c in CLASHES)
    assert FILTERS[name](spark, documents(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(MATCHES))
def test_matches_of_odd_and_empty_tables(spark, name):
    found = MATCHES[name](spark, documents(spark, odd_rows(), clashes=True)).toPandas()
    ids = set(found["doc_id"].dropna().astype(int))
    assert ids == ({5, 6, 7, 8, 15} if name == "suffix" else set())
    assert MATCHES[name](spark, documents(spark, [])).count() == 0


def test_empty_benchmark_and_labels(spark):
    docs = documents(spark, odd_rows())
    assert decontamination.find(docs, _benchmark(spark).limit(0)).count() == 0
    assert toxicity.drop_toxic(docs, _labels(spark).limit(0)).count() == len(odd_rows())


PAGES = [
    (1, "http://a.org/x", "<p>one</p>"), (2, None, None), (3, "nonsense", ""), (None, "http://b.net/", "<p>one</p>"),
    (5, "HTTP://WWW.Example.ORG/fr/a?q#f", "x" * 200_000), (5, "HTTP://WWW.Example.ORG/fr/a?q#f", "x" * 200_000), (6, "http://c.com/\r\nEvil: 1", "ä漢"),
]


def test_pages(spark):
    clashes = [F.lit("clash").alias(c) for c in CLASHES]
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").select("*", *clashes)
    archive = warc.write_archive(pages)
    rows = {(r["page_id"], r["record_type"]): r for r in archive.read(archive.lookup(pages)).collect()}
    assert len(rows) == 7 and archive.read(archive.captures()).count() == 7
    assert rows[(None, "revisit")]["refers_to"] == 1 and rows[(3, "revisit")]["refers_to"] == 2
    assert rows[(5, "revisit")]["payload_bytes"] == 200_000 and rows[(2, "response")]["payload_bytes"] == 0
    verdicts = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    assert verdicts[2]["host"] == "" and verdicts[2]["verdict"] == "allow" and verdicts[3]["rule"] is None
    assert (verdicts[5]["host"], verdicts[5]["path"], verdicts[5]["rule"]) == ("www.example.org", "/fr/a", "org/fr/")
    assert verdicts[None]["verdict"] == "block"
    nothing = pages.limit(0)
    archive = warc.write_archive(nothing)
    assert archive.read(archive.captures()).count() == 0
    assert url_filter.judge(nothing).count() == 0


def test_pipeline_over_odd_and_empty_tables(spark, tmp_path):
    for name, rows in (("odd", odd_rows()), ("empty", [])):
        folder = tmp_path / name
        documents(spark, rows).write.parquet(str(folder / "documents.parquet"))
        _labels(spark).write.parquet(str(folder / "labels.parquet"))
        _benchmark(spark).write.parquet(str(folder / "benchmark.parquet"))
        found = corpus_pipeline.run(spark, str(folder)).collect()
        assert all(r["taken"] <= 2 * r["size"] for r in found)
        # copies 6 and 7, near copy 8, repeated rows and empty texts go; of equal texts the longest stays
        assert bool(found) == bool(rows)
