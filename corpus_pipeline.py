"""From raw documents to sharded training data, in five stages; each is written before the next.

Every stage but the last keeps the columns of ``documents`` and hands on only what it keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from permeate.llm import decontaminate, jaccard, langid, mixing, sharding
from permeate.llm.tables import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; null texts and texts without letters go."""
    return langid.known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest id, of each group linked by 5-word runs."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that benchmark items contaminate."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return sharding.documents_sharded(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

#: SQL can't express what an automaton learned from samples or label propagation decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stored(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
