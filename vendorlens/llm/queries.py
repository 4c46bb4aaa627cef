"""Registered queries of the operators and their SQL, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontamination, exact_dedup, hard_negatives, hmm, language_id, mixing, ngram_join, periodic_runs, rule_quality, suffix_dedup, toxicity,
    url_filter, warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_decontamination": decontamination.op3_decontamination,
        "op4_mixing": mixing.op4_mixing,
        "op5_hmm": hmm.op5_hmm,
        "op6_language_id": language_id.op6_language_id,
        "op7_ngram_join": ngram_join.op7_ngram_join,
        "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
        "op9_warc": warc.op9_warc,
        "op10_url_filter": url_filter.op10_url_filter,
        "op11_rule_quality": rule_quality.op11_rule_quality,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_periodic_runs": periodic_runs.op13_periodic_runs,
    }


def oracles() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.ORACLE,
        "op9_warc": warc.ORACLE,
        "op10_url_filter": url_filter.ORACLE,
        "op12_hard_negatives": hard_negatives.ORACLE,
    }
