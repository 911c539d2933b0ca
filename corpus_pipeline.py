"""Corpus pipeline: quality classifier, quality rules, near-duplicates,
decontamination, token ids. Each stage reads all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes each stage's rows to the
shared folder and reads them again for the next one, so a lost executor never
repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinelake.llm import bpe, decontaminate, quality_classifier, quality_rules, simhash
from cinelake.llm.registry import tokenizer_path
from cinelake.llm.tables import prepare, read, staged


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects (operator 7)."""
    return quality_classifier.keep_good(docs, read(spark, sf_dir, "labels"))


def check_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject (operator 2)."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each near-duplicate group (operator 5)."""
    prepare(spark)
    return simhash.keep_one(docs, words_a_shingle=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item (operator 9)."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left (operator 1)."""
    prepare(spark)
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("quality-classifier", classify),
    ("quality-rules", check_rules),
    ("near-duplicates", deduplicate),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

#: A trained classifier, learned cutoffs and graph components have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
