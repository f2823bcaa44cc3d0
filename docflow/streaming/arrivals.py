"""Runs over what arrives: pages of records come as files, and each is taken once.

An epoch of the stream is one run of ``plans.ingest.process``. Its rows carry the epoch's number and replace what the folder of that
number holds; what earlier epochs put into batches is open to later ones, so a record that arrives again is ``in_open_pr`` and branch numbers
go on. An epoch reads of earlier epochs alone: one that is run again leaves what it left before, and the statistics of all add up.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import Config
from ..plans import ingest
from ..storage import materialize

OUTCOMES = "pmid string, outcome string, reasons array<string>, error string, epoch int"
BATCHES = f"id string, number long, branch string, title string, rank long, outcome string, front_matter struct<{', '.join(f'{k}:{kind}' for k, kind in schemas.FRONT_MATTER)}>, text string, epoch int"
COUNTS = ("found", "excluded_total", "new", "updated", "unchanged", "errors")


def earlier_batches(spark: SparkSession, output: str, epoch: int) -> DataFrame:
    spark.createDataFrame([], BATCHES).write.mode("ignore").partitionBy("epoch").parquet(f"{output}/batches")  # so that there is a folder
    return spark.read.schema(BATCHES).parquet(f"{output}/batches").where(F.col("epoch") < epoch)


def run_epoch(spark: SparkSession, config: Config, documents: DataFrame, fetch: ingest.Fetch, output: str, now: datetime) -> Callable[[DataFrame, int], None]:
    def run(arrived: DataFrame, epoch: int) -> None:
        stored = materialize(arrived.select("page", "xml").repartition(spark.sparkContext.defaultParallelism, "page"), "arrived")  # a few large files are parsed by all cores
        pages = spark.read.schema(stored.schema).parquet(*stored.inputFiles()) if stored.inputFiles() else spark.createDataFrame([], stored.schema)  # in the caller's session
        earlier = materialize(earlier_batches(spark, output, epoch).select("id", "number"), "earlier")
        done = ingest.process(spark, config, pages, fetch, documents, earlier.select("id"), earlier.select("number").distinct(), now)
        late = done.prepared.select("pmid", "outcome", "reasons", "error")
        records = done.records.select("pmid", "reason").join(late, "pmid", "left")
        outcomes = records.select("pmid", F.coalesce("outcome", "reason").alias("outcome"), F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"), "error")
        outcomes.write.mode("overwrite").parquet(f"{output}/outcomes/epoch={epoch}")
        number = F.regexp_extract("branch", r"([0-9]+)$", 1).cast("long")
        batches = done.batches.join(done.branches, "batch").select(F.col("front_matter.id").alias("id"), number.alias("number"), "branch", "title", "rank", "outcome", "front_matter", "text")
        batches.write.mode("overwrite").parquet(f"{output}/batches/epoch={epoch}")
        done.statistics.select(*COUNTS, F.to_json("excluded").alias("excluded")).write.mode("overwrite").json(f"{output}/statistics/epoch={epoch}")

    return run


def ingest_arrivals(pages: DataFrame, config: Config, documents: DataFrame, fetch: ingest.Fetch, output: str, checkpoint: str, now: datetime) -> None:
    """A stream pages(page, xml) of records, taken as far as it goes; documents and fetch as in ``plans.ingest.process``."""
    spark = documents.sparkSession
    run = run_epoch(spark, config, documents, fetch, output.rstrip("/"), now)
    pages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def outcomes(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(OUTCOMES).parquet(f"{output.rstrip('/')}/outcomes")


def batches(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(BATCHES).parquet(f"{output.rstrip('/')}/batches")


def statistics(spark: SparkSession, output: str) -> DataFrame:
    """One row: the counts of all epochs."""
    rows = spark.read.schema(", ".join(f"{c} long" for c in COUNTS) + ", excluded string").json(f"{output.rstrip('/')}/statistics")
    reasons = rows.select(F.explode(F.from_json("excluded", "map<string,long>")).alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("n"))
    excluded = reasons.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("excluded"))
    return rows.agg(*[F.sum(c).alias(c) for c in COUNTS]).join(F.broadcast(excluded), F.lit(True))  # one row each
