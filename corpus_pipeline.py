"""Corpus preparation: quality, toxicity, exact dedup, near dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.  The
classifiers learn from the labelled rows among their own input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tutorlens.llm import best_fit_packing, exact_dedup, quality_mil, simhash_near_dedup, toxicity_crf
from tutorlens.llm.common import staged, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_mil.keep_good(docs, quality_mil.fit(docs, table(spark, sf_dir, "labels")))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity_crf.keep_clean(docs, toxicity_crf.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_near_dedup.keep_representatives(docs, width=4, max_distance=4)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), max_tokens=1024, end_id=2)


STAGES = [
    ("quality_classifier", keep_good),
    ("toxicity", keep_clean),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]

#: Trained classifiers, tokenisers and SimHash have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
