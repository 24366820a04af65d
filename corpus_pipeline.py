"""The corpus pipeline: toxic documents go, then exact copies, then near copies; the rest is mixed to target weights and packed.

Each stage gets the rows that the one before it kept, as a table of its own, and all but the last give back the
columns of ``documents``. The stages are calls of the operators in ``pistespark.llm``; their texts say what they
do with nulls, empty and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pistespark.llm import exact_dedup, mixing, packing, simhash, toxicity
from pistespark.shared import table, written


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not predict to be toxic."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def exactly_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space: the longest, then the smallest doc_id."""
    return exact_dedup.keepers(docs)


def nearly_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id."""
    return simhash.keepers(docs)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as far, as the mix takes their words."""
    return mixing.mixed(docs)


def into_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packing plan: a row per sequence with its bucket, batch and slot. text_hash tells the rows of one doc_id apart."""
    return packing.packed(docs)


STAGES = [("toxicity", not_toxic), ("exact_dedup", exactly_once), ("near_dedup", nearly_once), ("mixing", to_weights), ("packing", into_batches)]

#: A trained model and a similarity search decide; tests compare the stages with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
