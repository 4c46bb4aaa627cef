"""A corpus pipeline: toxic documents go, then exact and near copies, then benchmark leaks; the rest is mixed.

Every stage reads what its predecessor kept, as Parquet, and returns the columns of
``documents``; the last one returns the mix (see `vendorlens.llm.mixing`). Empty tables give
empty results at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vendorlens.llm.common import staged, table
from vendorlens.llm.decontamination import drop_contaminated
from vendorlens.llm.exact_dedup import drop_exact_copies
from vendorlens.llm.mixing import mix
from vendorlens.llm.ngram_join import drop_near_copies
from vendorlens.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model is fitted on labelled documents among ``docs``."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest row of each group of texts that are equal without white space."""
    return drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of each class of documents linked by a Jaccard similarity of 0.8 or more."""
    return drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document in the mix of sources."""
    return mix(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

#: A trained field, MinHash and Newton steps are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
