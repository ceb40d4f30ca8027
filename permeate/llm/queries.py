"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from permeate.llm import alignment, collocations, decontaminate, editprint, jaccard, langid, lines, lm, mixing, quality, sharding, simhash, warc
from permeate.llm.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduped(table(spark, sf_dir, "documents"))


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_warc", warc.SQL)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_archived(table(spark, sf_dir, "pages"))


@query("op4_lm_scores")
def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"))


@query("op5_decontamination", decontaminate.SQL)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(docs, benchmark)


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.fingerprints(table(spark, sf_dir, "documents"))


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


@query("op8_ngram_jaccard", jaccard.SQL)
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query("op9_source_mix", mixing.SQL)
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.documents_mixed(table(spark, sf_dir, "documents"))


@query("op10_shards")
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.documents_sharded(table(spark, sf_dir, "documents"))


@query("op11_simhash")
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


@query("op13_collocations", collocations.SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"))
