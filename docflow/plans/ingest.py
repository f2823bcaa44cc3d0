"""The whole run: search, metadata, waterfall, full text, gate, diff, batches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import udfs
from ..config import Config
from ..operators import ranking, sinks, waterfall
from ..operators.prepare import prepare
from ..sources import service
from ..sources.corpus import stored_state
from ..storage import materialize, materialize_counting


def branch_stem(config: Config, now: datetime) -> str:
    return f"{config.corpus.branch_prefix}{now:%Y-%m-%d}-pubmed-"


#: Pages (page, xml) of the full texts of survivors(pmcid).
Fetch = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Run:
    """What a run has found: records with their reason, survivors as prepared, changes in batches with their branches and titles, statistics."""

    records: DataFrame
    prepared: DataFrame
    changes: DataFrame
    batches: DataFrame
    branches: DataFrame
    descriptions: DataFrame
    statistics: DataFrame


def run(spark: SparkSession, config: Config, documents: DataFrame, open_ids: DataFrame, taken: DataFrame, now: datetime, **options: str) -> Run:
    """A run over the service's answers; documents, open_ids and taken as in ``process``."""
    pages = materialize(service.search_pages(spark, config, **options), "pages")
    return process(spark, config, pages, lambda survivors: service.article_pages(survivors, config.ncbi.batch_size, **options), documents, open_ids, taken, now)


def process(spark: SparkSession, config: Config, pages: DataFrame, fetch: Fetch, documents: DataFrame, open_ids: DataFrame, taken: DataFrame, now: datetime) -> Run:
    """pages(page, xml) of records, wherever they come from, and how to fetch full texts.

    documents: as sources.corpus reads them; open_ids(id) and taken(number): open batches' ids, and the day's used branch numbers.
    The waterfall's cheap steps come before any full text is fetched. Nothing is written here; see operators.sinks.
    """
    records = materialize(ranking.first_seen(udfs.parse_records(pages), ["pmid"], ["page", "at"]), "records")
    rejected = documents.where("folder = 'rejected' and id is not null and not nested").select("id")
    flagged = waterfall.with_state(records, stored_state(documents), rejected, open_ids)
    flagged, seen = materialize_counting(flagged.withColumn("reason", waterfall.first_reason(waterfall.record_rules())), "flagged", **sinks.record_metrics())
    survivors = flagged.where("reason is null")
    fetched = materialize(fetch(survivors), "article_pages")
    articles = ranking.last_seen(udfs.parse_articles(fetched), ["pmcid"], ["page", "at"])
    prepared, made = materialize_counting(prepare(survivors, articles, config, now), "prepared", **sinks.document_metrics())
    changes = prepared.where(F.col("outcome").isin("new", "updated"))
    batched = materialize(sinks.batches(changes, config.corpus.max_pr_size), "batches")
    wanted, used = -(-(made["new"] + made["updated"]) // config.corpus.max_pr_size), taken.count()
    stem = branch_stem(config, now)
    numbers = ranking.free_numbers(spark, wanted, taken, used)
    sizes = batched.groupBy("batch").agg(F.count("*").alias("documents"))
    branches = numbers.join(sizes, "batch").select("batch", F.concat(F.lit(stem), F.col("number").cast("string")).alias("branch"), sinks.title(now, F.col("number"), F.col("documents")).alias("title"))
    return Run(flagged, prepared, changes, batched, branches, sinks.descriptions(batched), sinks.observed_statistics(spark, seen, made))
