"""Job 1, incremental ingestion of documents.

Takes the files of documents that have come since its last run, decides on each document (waterfall, gate, duplicates, difference from
the corpus) and adds what passed to the corpus. It runs until nothing new is there, and then ends.

    python -m jobs.ingest_increment --config jobs/ingest_increment.yaml --documents PATH --registry PATH --protected PATH --output PATH --checkpoint PATH

Output, all below --output and partitioned by the stream's epoch:

* ``outcomes/epoch=N/outcome=O``: a row for each document that arrived, with its reasons and its batch
* ``corpus/epoch=N/lang=L``: documents that were accepted, with their texts
* ``statistics/epoch=N``: counts, as JSON

What is new is known by the stream's checkpoint. An epoch writes to folders of its own and overwrites them, and it reads what
earlier epochs alone have left: one that is run again, after a crash before its commit, leaves the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.config import Quality
from docflow.operators import sinks
from docflow.plans import increment

from .common import JobConfig, as_pattern, log, parse, session

DOCUMENTS = "doc_id long, text string, lang string, source string"
ACCEPTED = "doc_id long, source string, license string, tier int, content_hash string, outcome string, batch long, text string, epoch long, lang string"
OUTCOMES = increment.DECISIONS.replace(", outcome string", "") + ", epoch long, outcome string"


class Config(JobConfig):
    min_body_chars: int = 1500
    allowed_languages: list[str]
    allowed_licenses: list[str]
    #: Whether a document needs a licence at all; if not, one that has a licence needs an allowed one.
    require_license: bool = True
    tiers: dict[str, int] = {}
    batch_size: int = 20
    #: Files of one epoch at most; 0 for no limit.
    max_files: int = 0

    @property
    def rules(self) -> Quality:
        return Quality(min_body_chars=self.min_body_chars, allowed_languages=self.allowed_languages, allowed_licenses=self.allowed_licenses, require_license=self.require_license)


def accepted_before(spark: SparkSession, output: str, epoch: int) -> DataFrame:
    """Documents as the epochs before this one left them."""
    path = f"{output}/corpus"
    spark.createDataFrame([], ACCEPTED).write.mode("ignore").partitionBy("epoch", "lang").parquet(path)  # so that there is a folder
    return increment.latest(spark.read.schema(ACCEPTED).parquet(path).where(F.col("epoch") < epoch))


def apply_epoch(config: Config, registry: str, protected: str, output: str) -> Callable[[DataFrame, int], None]:
    def run(arrivals: DataFrame, epoch: int) -> None:
        spark = arrivals.sparkSession
        known, held = spark.read.parquet(registry).select("doc_id", "quality", "toxic"), spark.read.parquet(protected).select("item_id")
        decisions = increment.decide(arrivals, accepted_before(spark, output, epoch), known, held, config.rules, config.tiers, config.batch_size)
        decisions.write.mode("overwrite").partitionBy("outcome").parquet(f"{output}/outcomes/epoch={epoch}")

        # Texts of decided documents, by id and hash: rows that repeat both have one text.
        kept = decisions.where(F.col("outcome").isin("new", "updated")).select("doc_id", "lang", "source", "license", "tier", "content_hash", "outcome", "batch")
        bodies = arrivals.select("doc_id", increment.body_of(F.col("text")).alias("text")).withColumn("content_hash", increment.content_hash(F.col("text")))
        accepted = bodies.join(kept, ["doc_id", "content_hash"]).dropDuplicates(["doc_id"])
        accepted.write.mode("overwrite").partitionBy("lang").parquet(f"{output}/corpus/epoch={epoch}")

        reasons = decisions.select(F.explode("reasons").alias("reason"))
        counts = sinks.run_statistics(decisions.count(), reasons, decisions).withColumn("duplicates", F.lit(decisions.where("outcome = 'duplicate'").count()))
        counts.write.mode("overwrite").json(f"{output}/statistics/epoch={epoch}")
        log.info("epoch %s: read %s documents, wrote %s", epoch, decisions.count(), counts.toJSON().first())

    return run


def run(spark: SparkSession, config: Config, documents: str, registry: str, protected: str, output: str, checkpoint: str) -> int:
    """Takes all that is new and returns the number of the last epoch, -1 if there has been none."""
    output = output.rstrip("/")
    stream = spark.readStream.schema(DOCUMENTS)
    if config.max_files:
        stream = stream.option("maxFilesPerTrigger", config.max_files)
    log.info("reading new files of %s, checkpoint %s", documents, checkpoint)
    query = stream.parquet(as_pattern(documents)).writeStream.foreachBatch(apply_epoch(config, registry, protected, output)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    done = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
    log.info("wrote to %s: %s", output, f"epochs {done}" if done else "nothing, as nothing is new")
    return max(done, default=-1)


def outcomes(spark: SparkSession, output: str) -> DataFrame:
    """Every decision of every epoch."""
    return spark.read.schema(OUTCOMES).parquet(f"{output.rstrip('/')}/outcomes")


def corpus(spark: SparkSession, output: str) -> DataFrame:
    """Every accepted version of every document."""
    return spark.read.schema(ACCEPTED).parquet(f"{output.rstrip('/')}/corpus")


def main(argv: list[str] | None = None) -> None:
    paths = {
        "documents": "folder of documents that grows", "registry": "labels: what is known of documents", "protected": "ids that are taken", "output": "folder for the results", "checkpoint": "folder for the stream's mark",
    }
    config, given = parse(Config, __doc__.splitlines()[0], paths, argv)
    spark = session("ingest_increment")
    try:
        run(spark, config, **given)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
