"""A training corpus from `documents`: language ID, line dedup, near-duplicates, benchmark
decontamination, mixing. Each stage takes what its predecessor kept and, but for the last,
returns the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import decontaminate, language_id, line_dedup, mixing, simhash
from quillon.llm.common import cut, fold, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language is found: without text, without a letter or
    long and unlike any language learned."""
    model = language_id.learn(docs.where(~F.coalesce(fold(parts=4) == 2, F.lit(False))))
    found = docs.select(F.struct("*").alias("row"), language_id.verdict(F.col("text"), model).alias("found"))
    return found.where(language_id.known(F.col("row.text"), F.col("found"))).select("row.*")


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that match an earlier line."""
    return line_dedup.clean(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [("language", known_language), ("lines", first_lines), ("near_copies", one_of_near_copies), ("benchmark", uncontaminated), ("mix", mixed)]

#: The language stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
