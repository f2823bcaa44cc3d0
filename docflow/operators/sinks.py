"""What a run leaves behind: statistics, batches with descriptions, originals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..functions.text import record_url
from .ranking import batch_number, global_rank
from .waterfall import GATE_REASONS, record_rules

# The description of a batch.
HEADER = "| id | titolo | doc_type | modality | topics | stato | PubMed |\n| --- | --- | --- | --- | --- | --- | --- |"
NOTICE = "Tutti i documenti sono in stato `pending`: servono revisione e approvazione clinica."


def batches(changes: DataFrame, size: int) -> DataFrame:
    """changes(pmid, front_matter, ...) with rank and batch, by evidence tier and then pmid as a string."""
    keys = changes.select(F.col("front_matter.evidence_tier").alias("tier"), "pmid")
    ranked = global_rank(keys, ["tier", "pmid"]).drop("tier")
    return changes.join(ranked, "pmid").withColumn("batch", batch_number(F.col("rank"), size))


def table_row(cells: list[Column]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")) for c in cells]), F.lit(" |"))


def descriptions(batched: DataFrame) -> DataFrame:
    """(batch, documents, description): a Markdown table of at most a batch's documents."""
    front = F.col("front_matter")
    row = table_row([
        F.concat(F.lit("`"), front["id"], F.lit("`")), front["title"], front["doc_type"], F.array_join(front["modality"], ", "), F.array_join(front["topics"], ", "), F.col("outcome"),
        F.concat(F.lit("["), F.col("pmid"), F.lit("]("), record_url(F.col("pmid")), F.lit(")")),
    ])
    rows = F.transform(F.array_sort(F.collect_list(F.struct("rank", row.alias("row")))), lambda x: x["row"])
    made = batched.groupBy("batch").agg(F.count("*").alias("documents"), rows.alias("rows"))
    return made.select("batch", "documents", F.concat_ws("\n", F.lit(HEADER), F.array_join("rows", "\n"), F.lit(""), F.lit(NOTICE)).alias("description"))


def run_statistics(found: int, reasons: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row: found, excluded (reason to count, by reason), excluded_total, new, updated, unchanged, errors.

    reasons(reason) counts every gate reason of a document, so the total may exceed the documents; errors in reading the
    corpus count as errors and as excluded.
    """
    counted = reasons.groupBy("reason").count()
    excluded = counted.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "count")))).alias("excluded"), F.coalesce(F.sum("count"), F.lit(0)).alias("excluded_total"), F.coalesce(F.sum(F.when(F.col("reason") == "error_read_corpus", F.col("count"))), F.lit(0)).alias("unread"))
    ends = outcomes.agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("new", "updated", "unchanged", "error")])
    both = excluded.join(F.broadcast(ends), F.lit(True))  # one row each
    return both.select(F.lit(found).cast("long").alias("found"), "excluded", "excluded_total", "new", "updated", "unchanged", (F.col("error") + F.col("unread")).alias("errors"))


STATISTICS = "found long, excluded map<string,long>, excluded_total long, new long, updated long, unchanged long, errors long"
OUTCOMES = ("new", "updated", "unchanged", "error")


def record_metrics() -> dict[str, Column]:
    """What to observe of flagged records (reason): how many there are, and how many of each reason."""
    return {"found": F.count(F.lit(1)), **{reason: F.count_if(F.col("reason") == reason) for reason in dict(record_rules())}}


def document_metrics() -> dict[str, Column]:
    """What to observe of prepared documents (outcome, reasons)."""
    gate = {f"quality:{reason}": F.count_if(F.array_contains("reasons", reason)) for reason in GATE_REASONS}
    return {**{o: F.count_if(F.col("outcome") == o) for o in (*OUTCOMES, "no_open_access_fulltext")}, **gate}


def observed_statistics(spark: SparkSession, records: dict[str, int], documents: dict[str, int]) -> DataFrame:
    """The row of run_statistics from what was observed while records and documents were stored."""
    excluded = {k: n for k, n in sorted({**records, **documents}.items()) if n and k not in ("found", *OUTCOMES)}
    ends = [documents[o] for o in OUTCOMES]
    return spark.createDataFrame([(records["found"], excluded, sum(excluded.values()), *ends[:3], ends[3] + records["error_read_corpus"])], STATISTICS)


def title(day: datetime, number: Column, documents: Column) -> Column:
    return F.concat(F.lit(f"Ingestion PubMed {day:%Y-%m-%d} #"), number.cast("string"), F.lit(": "), documents.cast("string"), F.lit(" documenti"))


def write_batches(batched: DataFrame, path: str, branches: DataFrame) -> None:
    """Documents as rows (branch, file, text), a folder for each branch. branches(batch, branch).

    A branch is written as a whole: one that is there already is replaced, others stay, and nothing is seen of a write that fails. So
    a run that is repeated with its branches leaves each document once.
    """
    rows = batched.join(branches.select("batch", "branch"), "batch").select("branch", F.concat(F.lit("corpus/"), F.col("front_matter.id"), F.lit(".md")).alias("file"), "text")
    _replace(rows.repartition("branch")).parquet(path)


def write_change_sets(branches: DataFrame, described: DataFrame, path: str) -> None:
    """What a reviewer is told of each branch, (branch, title, documents, description), as JSON in a folder for each; replaced like the branches."""
    rows = branches.join(described, "batch").select("branch", "title", "documents", "description")
    _replace(rows).json(path)


def write_originals(batched: DataFrame, path: str, branches: DataFrame) -> None:
    """The markup of each branch's documents, (branch, file, xml), beside them; replaced like the branches."""
    rows = batched.join(branches.select("batch", "branch"), "batch").select("branch", F.concat(F.lit("pmid-"), "pmid", F.lit(".xml")).alias("file"), "xml")
    _replace(rows.repartition("branch")).parquet(path)


def _replace(rows: DataFrame) -> DataFrameWriter:
    return rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("branch")


def open_batches(spark: SparkSession, path: str, stem: str) -> tuple[DataFrame, DataFrame]:
    """(id) of documents in batches that are still there, and (number) that branches of this stem have used."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "id string"), spark.createDataFrame([], "number long")
    rows = spark.read.schema("file string, text string, branch string").parquet(path)
    number = F.when(F.col("branch").startswith(stem), F.substring("branch", len(stem) + 1, 1 << 20).try_cast("long"))
    ids = rows.select(F.regexp_extract("file", r"^corpus/(.+)\.md$", 1).alias("id")).where("id <> ''").distinct()
    return ids, rows.select(number.alias("number")).where("number is not null").distinct()
