"""The sample that the toxic field is fitted on."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorlens.llm import toxicity


def test_the_sample_is_written_to_few_files(spark, monkeypatch):
    kept, staged = [], toxicity.staged
    monkeypatch.setattr(toxicity, "staged", lambda df, name: kept.append(staged(df, name)) or kept[-1])
    docs = spark.createDataFrame([(i, f"plain words {i}" + " vile" * (i % 4 == 0)) for i in range(200)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id bigint, quality int, toxic int")
    field = toxicity.fit(docs.repartition(40), labels, (100, 200))
    learned = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).count()
    assert len(kept) == 1 and kept[0].count() == learned and len(kept[0].inputFiles()) == 1
    assert field.logistic is not None
