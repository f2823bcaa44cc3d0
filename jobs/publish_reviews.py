"""Job 2, publishing reviewed documents.

Reads documents and the comments on them, folds the comments into decisions, and publishes every document with its front matter in the
folder that its decision asks for: approved and pending ones in ``corpus``, rejected ones with the reviewer's notes in ``rejected``.

    python -m jobs.publish_reviews --config jobs/publish_reviews.yaml --documents PATH --comments PATH --output PATH

Output, below --output:

* ``documents/folder=F/status=S``: path, text with front matter, hash, and what the validator says against a document
* ``problems``: how many documents have which problem, by folder, as CSV
* ``statistics``: counts by folder and status, as JSON

The same input gives the same output: a second run overwrites what it finds, whole tables at a time. A run that fails in the middle leaves
its outputs to be overwritten by the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import udfs
from docflow.functions import content_hash
from docflow.operators import ranking, review
from docflow.operators.validate import EXPECTED, field_errors

from .common import JobConfig, log, parse, session

PUBLISHED = "doc_id long, notes string, changes long, errors long, path string, content_hash string, text string, problems array<string>, folder string, status string"


class Config(JobConfig):
    approve_role: str = "user"
    reject_role: str = "assistant"
    #: A rejection with shorter notes is one without notes.
    min_notes_chars: int = 1


def path_of(doc_id: Column) -> Column:
    return F.concat(F.lit("corpus/pmid-"), doc_id.cast("string"), F.lit(".md"))


def commands(comments: DataFrame, config: Config) -> DataFrame:
    """comments(conv_id, turn, role, text) -> (doc, turn, decision, notes): each turn's command on the document of its conversation."""
    notes = F.coalesce("text", F.lit(""))
    notes = F.when(F.length(notes) >= config.min_notes_chars, notes).otherwise("")
    body = F.when(F.col("role") == config.approve_role, "/approve").when(F.col("role") == config.reject_role, F.concat(F.lit("/reject "), notes))
    found = comments.select(F.col("conv_id").alias("doc"), "turn", review.parse_command(body, path_of(F.col("conv_id"))).alias("c"))
    return found.where("c is not null").select("doc", "turn", "c.decision", "c.notes")


def publish(documents: DataFrame, comments: DataFrame, config: Config) -> DataFrame:
    """documents(doc_id, text, lang, source) and comments -> rows as PUBLISHED. Of rows that repeat a doc_id the one with the smallest hash, language and source is published; none without a doc_id is."""
    text = F.coalesce("text", F.lit(""))
    hashed = documents.where("doc_id is not null").select("doc_id", "lang", "source", content_hash(text).alias("content_hash"))
    first = ranking.first_seen(hashed, ["doc_id"], ["content_hash", "lang", "source"])
    bodies = documents.select("doc_id", text.alias("body")).withColumn("content_hash", content_hash(F.col("body")))
    states = review.fold(commands(comments, config), "doc", ["turn"]).withColumnRenamed("doc", "doc_id")
    # What is small is joined first: bodies then meet it, and their copies, in one shuffle.
    rows = bodies.join(first.join(states, "doc_id", "left"), ["doc_id", "content_hash"]).dropDuplicates(["doc_id", "content_hash"])
    rows = rows.withColumns({"status": F.coalesce("status", F.lit("pending")), "changes": F.coalesce("changes", F.lit(0).cast("long")), "errors": F.coalesce("errors", F.lit(0).cast("long"))})
    rows = rows.withColumn("folder", F.when(F.col("status") == "rejected", "rejected").otherwise("corpus"))
    ident = F.concat(F.lit("pmid-"), F.col("doc_id").cast("string"))
    front = udfs.struct_of({
        "schema_version": F.lit(2), "id": ident, "title": ident, "language": F.col("lang"), "curation_status": F.col("status"), "review_notes": F.col("notes"), "content_hash": F.col("content_hash"),
        "pmid": F.col("doc_id").cast("string"), "journal": F.col("source"),
    })
    rows = rows.withColumn("front", front).withColumn("path", F.concat("folder", F.lit("/"), ident, F.lit(".md")))
    expected = F.create_map(*[F.lit(x) for pair in EXPECTED.items() for x in pair])[F.col("folder")]
    problems = field_errors(ident, F.col("front"), F.col("body"), expected)
    return rows.select("doc_id", "notes", "changes", "errors", "path", "content_hash", udfs.write_document("front", "body").alias("text"), problems.alias("problems"), "folder", "status")


def run(spark: SparkSession, config: Config, documents: str, comments: str, output: str) -> int:
    """Publishes all documents and returns how many there are."""
    output = output.rstrip("/")
    docs, said = spark.read.parquet(documents).select("doc_id", "text", "lang", "source"), spark.read.parquet(comments).select("conv_id", "turn", "role", "text")
    log.info("reading %s and %s", documents, comments)
    publish(docs, said, config).repartition("folder", "status", F.pmod(F.xxhash64("doc_id"), F.lit(16))).write.mode("overwrite").partitionBy("folder", "status").parquet(f"{output}/documents")
    done = published(spark, output)
    done.select("folder", F.explode("problems").alias("problem")).groupBy("folder", "problem").count().orderBy("folder", "problem").coalesce(1).write.mode("overwrite").csv(f"{output}/problems", header=True)
    counts = done.groupBy("folder", "status").agg(F.count("*").alias("documents"), F.sum("changes").alias("changes"), F.sum("errors").alias("errors")).orderBy("folder", "status")
    counts.coalesce(1).write.mode("overwrite").json(f"{output}/statistics")
    total = 0
    for row in spark.read.json(f"{output}/statistics", schema="folder string, status string, documents long, changes long, errors long").collect():  # a row for each status
        log.info("wrote %s: %s %s documents", output, row["documents"], row["status"])
        total += row["documents"]
    return total


def published(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(PUBLISHED).parquet(f"{output.rstrip('/')}/documents")


def main(argv: list[str] | None = None) -> None:
    paths = {"documents": "table of documents", "comments": "table of conversations about them", "output": "folder for the results"}
    config, given = parse(Config, __doc__.splitlines()[0], paths, argv)
    spark = session("publish_reviews")
    try:
        run(spark, config, **given)
    finally:
        spark.stop()


ORACLE = r"""
WITH c AS (SELECT conv_id AS doc, turn, CASE role WHEN 'user' THEN 'approve' ELSE 'reject' END AS decision, CASE WHEN role = 'assistant' THEN nullif(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g'), '') END AS notes
  FROM conversations WHERE role IN ('user', 'assistant')),
f AS (SELECT doc, min(turn) FILTER (WHERE decision = 'reject' AND notes IS NOT NULL) AS final FROM c GROUP BY doc),
s AS (SELECT c.doc, any_value(f.final) AS final, max(CASE WHEN c.turn = f.final THEN notes END) AS notes, coalesce(bool_or(decision = 'approve' AND (final IS NULL OR turn < final)), false) AS approved,
    count(*) FILTER (WHERE decision = 'reject' AND (final IS NULL OR turn < final) OR decision = 'approve' AND turn > final) AS errors FROM c JOIN f USING (doc) GROUP BY c.doc),
d AS (SELECT doc_id, coalesce(text, '') AS body, lang, source, CASE WHEN s.final IS NOT NULL THEN 'rejected' WHEN s.approved THEN 'approved' ELSE 'pending' END AS status, s.notes,
    coalesce(s.approved::INT + (s.final IS NOT NULL)::INT, 0)::BIGINT AS changes, coalesce(s.errors, 0)::BIGINT AS errors FROM documents LEFT JOIN s ON s.doc = doc_id),
p AS (SELECT *, CASE status WHEN 'rejected' THEN 'rejected' ELSE 'corpus' END AS folder, 'sha256:' || sha256(body) AS content_hash FROM d)
SELECT doc_id, folder, status, sha256(notes) AS notes_sha256, changes, errors, folder || '/pmid-' || doc_id || '.md' AS path, content_hash, sha256(body) AS body_sha256,
  array_to_string(list_sort(list_filter([CASE WHEN status = 'pending' THEN 'curation_status must be approved' END, CASE WHEN NOT regexp_matches(body, '\S') THEN 'empty body' END], lambda x: x IS NOT NULL)), '; ') AS problems FROM p"""

if __name__ == "__main__":
    main()
