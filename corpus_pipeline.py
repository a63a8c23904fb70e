"""A training corpus from raw documents: filter, deduplicate, decontaminate, redact and pack.

Every stage calls one operator of ``activlake.llm``, works on all rows that its predecessor kept
and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm import decontamination, packing, pii, simhash, toxicity
from activlake.llm.common import stored, table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity model scores one half or more."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return simhash.deduplicate(docs)


def decontamination_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; the length column follows."""
    redacted = pii.redact(docs)
    if "n_chars" not in redacted.columns:
        return redacted
    kind = docs.schema["n_chars"].dataType
    return redacted.withColumn("n_chars", F.length("text").cast(kind))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 ids at most."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination_filter),
    ("personal_data", personal_data),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot express the trained stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
