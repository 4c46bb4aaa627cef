"""Registered queries against their SQL, and the pipeline against its operators."""

from __future__ import annotations

import pytest

import corpus_pipeline
from vendorlens.llm.common import table
from vendorlens.llm.queries import oracles, queries

from ..compare import difference, sql_connection

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_sql(spark, name):
    found = queries()[name](spark, SMALL).toPandas()
    assert len(found) > 0
    assert difference(found, sql_connection(SMALL).sql(oracles()[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracles())))
def test_query_runs_over_the_whole_table(spark, name):
    found = queries()[name](spark, SMALL).toPandas()
    if name not in ("op3_decontamination", "op8_suffix_dedup"):
        assert sorted(found["doc_id"]) == sorted(r[0] for r in table(spark, SMALL, "documents").select("doc_id").collect())


def test_pipeline_keeps_what_its_stages_keep(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and names[0] == "toxicity" and names[-1].startswith("mixing")
    found = corpus_pipeline.run(spark, SMALL).toPandas()
    documents = table(spark, SMALL, "documents").toPandas()
    assert found["doc_id"].is_unique and set(found["doc_id"]) <= set(documents["doc_id"])
    assert len(found) > 0.7 * len(documents)
    texts = documents.set_index("doc_id")["text"].loc[found["doc_id"]]
    assert texts.str.replace(r"[\x20\x09-\x0D]", "", regex=True).is_unique
    items = table(spark, SMALL, "benchmark").toPandas()["text"]
    assert not any(item in text for item in items for text in texts)
