"""From raw documents to packed token ids: five stages, each written as Parquet and read again by the next.

Stages map (spark, docs, sf_dir) to a DataFrame; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.llm import decontaminate, langid, mixing, simhash
from tallyroute.llm.queries import mixing_weights, packed_tokens, table
from tallyroute.session import materialize_at, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without text or letters go."""
    return langid.keep_known(docs, langid.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.mixed_documents(docs, F.array("source"), mixing_weights)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packed_tokens(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("packing", packing),
]

#: SQL can express neither the language model nor the fingerprints; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize_at(stage(spark, docs, sf_dir), scratch_path(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
