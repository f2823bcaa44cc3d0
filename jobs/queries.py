"""The jobs as queries over the driver's tables, with the SQL that gives the same rows.

A query runs its job twice into one new folder in the cluster's shared folder, so that the second run finds nothing new, and returns all
output as it then stands. The files stay.
"""

from __future__ import annotations

import uuid
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import udfs
from docflow.plans.records import LICENSE_SQL
from docflow.storage import shared_dir

from . import ingest_increment, publish_reviews


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _config(module) -> object:
    return module.Config.model_validate(yaml.safe_load(Path(module.__file__).with_suffix(".yaml").read_text(encoding="utf-8")))


def job1_ingest_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every decision on every document, with the hash of the text that the corpus holds of it; batch 0 is none."""
    folder = _folder(spark, "job1")
    for _ in range(2):
        ingest_increment.run(spark, _config(ingest_increment), f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", f"{sf_dir}/benchmark.parquet", f"{folder}/out", f"{folder}/checkpoint")
    held = ingest_increment.corpus(spark, f"{folder}/out").select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    rows = ingest_increment.outcomes(spark, f"{folder}/out").join(held, "doc_id", "left")
    return rows.select("doc_id", "lang", "source", "license", "content_hash", F.col("tier").cast("long").alias("tier"), F.array_join("reasons", ",").alias("reasons"), "outcome", F.coalesce("batch", F.lit(0)).alias("batch"), "text_sha256")


def job2_publish_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every published document, its text without the front matter, and what is wrong with it."""
    folder = _folder(spark, "job2")
    for _ in range(2):
        publish_reviews.run(spark, _config(publish_reviews), f"{sf_dir}/documents.parquet", f"{sf_dir}/conversations.parquet", f"{folder}/out")
    rows = publish_reviews.published(spark, f"{folder}/out")
    read = udfs.read_document("text")
    problems = F.array_join(F.array_sort("problems"), "; ")
    return rows.select("doc_id", "folder", "status", F.sha2("notes", 256).alias("notes_sha256"), "changes", "errors", "path", "content_hash", F.sha2(read["body"], 256).alias("body_sha256"), problems.alias("problems"))


_C1 = _config(ingest_increment)
_TIERS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in _C1.tiers.items())
_IN = lambda values: ", ".join(f"'{v}'" for v in values)
JOB1 = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {LICENSE_SQL.format(c="coalesce(text, '')")} AS license, CASE lang {_TIERS} ELSE {max(_C1.tiers.values()) + 1} END AS tier FROM documents),
r AS (SELECT d.*, 'sha256:' || sha256(text) AS content_hash,
    CASE WHEN l.toxic = 1 THEN 'retracted' WHEN l.quality = 0 THEN 'rejected_in_corpus' WHEN b.item_id IS NOT NULL THEN 'in_open_pr' WHEN coalesce(source, '') = '' THEN 'no_pmcid' ELSE concat_ws(',',
      CASE WHEN lang IS NULL THEN 'language_missing' WHEN lang NOT IN ({_IN(_C1.allowed_languages)}) THEN 'language_not_allowed' END,
      CASE WHEN license NOT IN ({_IN(_C1.allowed_licenses)}) THEN 'license_not_allowed' END, CASE WHEN length(text) < {_C1.min_body_chars} THEN 'body_too_short' END) END AS reasons
  FROM d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT DISTINCT item_id FROM benchmark) b ON b.item_id = d.doc_id),
o AS (SELECT *, CASE WHEN reasons <> '' THEN 'excluded' WHEN row_number() OVER (PARTITION BY reasons = '', content_hash ORDER BY doc_id) > 1 THEN 'duplicate' ELSE 'new' END AS outcome FROM r)
SELECT doc_id, lang, source, license, content_hash, tier::BIGINT AS tier, reasons, outcome,
  CASE WHEN outcome = 'new' THEN (row_number() OVER (PARTITION BY outcome ORDER BY tier, doc_id::VARCHAR) - 1) // {_C1.batch_size} + 1 ELSE 0 END::BIGINT AS batch, CASE WHEN outcome = 'new' THEN sha256(text) END AS text_sha256 FROM o"""

QUERIES = {"job1_ingest_increment": job1_ingest_increment, "job2_publish_reviews": job2_publish_reviews}
ORACLES = {"job1_ingest_increment": JOB1, "job2_publish_reviews": publish_reviews.ORACLE}
