"""A corpus cleaned and encoded: five stages over the documents, each judged on its own input.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes each result
as Parquet in the shared folder and reads it back as the next stage's documents, so a lost
executor costs tasks of one stage only. All stages but the last return the columns of the
documents. Stages define their own behaviour for nulls, empty and repeated rows (see there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard, pieces, rules, toxicity
from tidemark.llm.frames import staged
from tidemark.llm.queries import reachable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels, does not reject."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither base rule nor certified cutoff rejects."""
    return rules.drop_rejected(docs, _table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    reachable(spark)
    return jaccard.keep_one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    reachable(spark)
    return pieces.encode_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]

#: The learned weights, the connected components and the encoding have no SQL statement;
#: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
