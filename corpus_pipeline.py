"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination and mixing, each on all that the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import decontaminate, language_id, line_dedup, mixing, near_dedup
from docflow.llm.common import materialize, table

#: A profile this far from every language is no text of any of them: random letters score 0.15 to 0.27, documents 0.36 and more.
LEAST_LANGUAGE_SCORE = 0.3
#: Percent of 5-word shingles that two documents share to be near-duplicates here; op6_near_dedup has its own, 85.
NEAR_PERCENT = 80
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those unlike every learned language, go."""
    docs = docs.select(COLUMNS)
    return language_id.keep_identified(docs, language_id.train(docs), LEAST_LANGUAGE_SCORE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words and more are cut; documents that were such copies as a whole go."""
    return line_dedup.drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return near_dedup.keep_one(docs, NEAR_PERCENT)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, by the target of its source."""
    return mixing.taken_words(mixing.mix(docs))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate_documents),
    ("mixing", mix_sources),
]
#: Rank-order profiles, minhashes and hypergeometric draws have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
