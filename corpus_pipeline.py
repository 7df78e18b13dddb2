"""A corpus pipeline: toxicity, near duplicates, benchmark passages, personal data, source mix.

Every stage takes all documents its predecessor kept and returns the columns of documents; each result is written as Parquet
to the cluster's shared folder and read again, so that a lost executor repeats a stage at most.

NULLs in any column, empty and very long texts, repeated rows, empty tables and further columns go through every stage as the
operators' docstrings say: a NULL or empty text is clean, private of nothing, and near to all other empty texts; rows with a NULL
doc_id are documents; further columns ride along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradevault.llm import decontamination, mixing, pii, simhash, toxicity
from tradevault.llm.columns import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity reaches the threshold."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one of the smallest id, of each group of near duplicates: fingerprints of four-word shingles that a chain
    of at most four differing bits each connects."""
    return simhash.dedup(docs, radius=simhash.RADIUS, size=simhash.SIZE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark passages out; drop documents that are mostly benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data, and terms that give it away, by their kind."""
    return pii.sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that sources, languages and topics meet their target weights."""
    return mixing.sample(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

#: Trained models, sampled draws and 64-bit shingle hashes cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
