"""Queries on review decisions and the corpus validator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import content_hash
from ..operators import review
from ..operators.validate import field_errors, validate
from ..streaming import review_stream
from .records import table


def review_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as comments: users approve, assistants reject, systems only talk; odd turns stand outside the corpus."""
    rows = table(spark, sf_dir, "conversations")
    body = F.concat(F.when(F.col("role") == "user", " /Approve ").when(F.col("role") == "assistant", "/reject\n").otherwise("/approved "), F.coalesce("text", F.lit("")))
    folder = F.when(F.col("turn") % 2 == 1, "docs/pmid-").otherwise("corpus/pmid-")
    found = review.parse_command(body, F.concat(folder, F.col("conv_id").cast("string"), F.lit(".md")))
    return rows.select("conv_id", "turn", found.alias("c")).where("c is not null").select("conv_id", "turn", "c.decision", "c.id", F.sha2("c.notes", 256).alias("notes_sha256"), "c.error")


REVIEW_COMMANDS = r"""
SELECT conv_id, turn, CASE role WHEN 'user' THEN 'approve' ELSE 'reject' END AS decision, CASE WHEN turn % 2 = 0 THEN 'pmid-' || conv_id END AS id,
  sha256(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')) AS notes_sha256, CASE WHEN turn % 2 = 1 THEN 'not on a document of the corpus' END AS error
FROM conversations WHERE role IN ('user', 'assistant')"""


def review_final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.fold(review_stream.commands_of_events(table(spark, sf_dir, "events")), "doc", ["ts", "event_id"])


REVIEW_FINAL_STATE = """
WITH c AS (SELECT event_id, ts, user_id AS doc, CASE WHEN event_type IN ('signup', 'purchase') THEN 'approve' ELSE 'reject' END AS decision, CASE WHEN event_type = 'click' THEN 'see ' || props END AS notes
  FROM events WHERE event_type IN ('signup', 'purchase', 'click', 'error')),
o AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY ts, event_id) AS r FROM c), f AS (SELECT doc, min(r) AS final FROM o WHERE decision = 'reject' AND notes IS NOT NULL GROUP BY doc)
SELECT o.doc, CASE WHEN min(f.final) IS NOT NULL THEN 'rejected' WHEN count(*) FILTER (WHERE decision = 'approve') > 0 THEN 'approved' ELSE 'pending' END AS status,
  max(CASE WHEN r = f.final THEN notes END) AS notes,
  ((min(f.final) IS NOT NULL)::INT + (count(*) FILTER (WHERE decision = 'approve' AND r < coalesce(f.final, 1000000000)) > 0)::INT)::BIGINT AS changes,
  count(*) FILTER (WHERE (decision = 'reject' AND r < coalesce(f.final, 1000000000)) OR (decision = 'approve' AND r > f.final))::BIGINT AS errors
FROM o LEFT JOIN f USING (doc) GROUP BY o.doc"""


def review_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fold over a stream of the events table."""
    # A pattern, as a stream's path is else taken for a folder; the table may be a file or a folder of files.
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")
    return review_stream.run_available(review_stream.review_states(review_stream.commands_of_events(events)))


def validator_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as corpus files: labels give their status, benchmark ids a wrong hash, and rejected ones of quality 1 lack notes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("body"), "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    changed = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit(True).alias("changed")).distinct()
    rows = docs.join(labels, "doc_id", "left").join(changed, "doc_id", "left")
    rejected = F.coalesce(F.col("toxic") == 1, F.lit(False))
    ident = F.concat(F.lit("pmid-"), F.col("doc_id").cast("string"))
    front = F.struct(
        F.when(F.col("lang") == "de", F.concat(ident, F.lit("0"))).otherwise(ident).alias("id"), F.col("doc_id").cast("string").alias("pmid"), F.concat(F.lit("PMC"), F.col("doc_id").cast("string")).alias("pmcid"),
        F.concat(F.lit("https://example.org/PMC"), F.when(F.col("lang") == "es", "x").otherwise(F.col("doc_id").cast("string"))).alias("source_uri"),
        F.when(F.col("changed"), "sha256:0").otherwise(content_hash(F.col("body"))).alias("content_hash"),
        F.when(F.col("quality").isNull(), "pending").when(rejected, "rejected").otherwise("approved").alias("curation_status"), F.when(F.col("quality") == 0, "poor").alias("review_notes"),
    )
    rows = rows.select("doc_id", "body", ident.alias("ident"), front.alias("front"), F.when(rejected, "rejected").otherwise("approved").alias("expected"))
    return rows.select("doc_id", F.explode(field_errors(F.col("ident"), F.col("front"), F.col("body"), F.col("expected"))).alias("message"))


VALIDATOR_ERRORS = r"""
WITH r AS (SELECT d.doc_id, coalesce(d.text, '') AS body, d.lang, l.quality, coalesce(l.toxic = 1, false) AS rejected, b.item_id IS NOT NULL AS changed
  FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT DISTINCT item_id FROM benchmark) b ON b.item_id = d.doc_id)
SELECT doc_id, 'id differs from the file name' AS message FROM r WHERE lang = 'de'
UNION ALL SELECT doc_id, 'pmcid is not in source_uri' FROM r WHERE lang = 'es'
UNION ALL SELECT doc_id, 'empty body' FROM r WHERE NOT regexp_matches(body, '\S')
UNION ALL SELECT doc_id, 'content_hash is not the body''s' FROM r WHERE changed
UNION ALL SELECT doc_id, 'curation_status must be approved' FROM r WHERE quality IS NULL
UNION ALL SELECT doc_id, 'rejected without review_notes' FROM r WHERE rejected AND coalesce(quality, 1) <> 0"""

def validator_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a corpus, of which some are in folders below, have wrong names, cannot be read, break the contract or repeat an id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("body"))
    rows = docs.join(table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("bad")), "doc_id", "left")
    folder = F.when(F.col("bad"), "rejected").otherwise("corpus")
    number = (F.col("doc_id") % 300).cast("string")
    front = F.struct(
        F.concat(F.lit("pmid-"), number).alias("id"), number.alias("pmid"), F.lit(None).cast("string").alias("pmcid"), F.lit("x").alias("source_uri"), content_hash(F.col("body")).alias("content_hash"),
        F.when(F.col("bad"), "rejected").otherwise("approved").alias("curation_status"), F.lit("seen").alias("review_notes"),
    )
    name = F.when(F.col("doc_id") % 7 == 0, "Bad name.md").otherwise(F.concat(F.lit("pmid-"), number, F.lit(".md")))
    rows = rows.select(
        F.concat(folder, F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit("/"), name).alias("path"), folder.alias("folder"), (F.col("doc_id") % 11 == 0).alias("nested"), name.alias("name"), front.alias("front_matter"), "body",
        F.when(F.col("doc_id") % 13 == 0, "front matter is missing").alias("error"), F.when(F.col("lang") == "fr", F.array(F.lit("license: missing"), F.lit("title: missing"))).alias("problems"),
    )
    return validate(rows)


VALIDATOR_TREE = r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS body, CASE WHEN l.toxic = 1 THEN 'rejected' ELSE 'corpus' END AS folder, CASE WHEN doc_id % 7 = 0 THEN 'Bad name.md' ELSE 'pmid-' || doc_id % 300 || '.md' END AS name
  FROM documents LEFT JOIN labels l USING (doc_id)),
f AS (SELECT *, folder || '/' || lpad(doc_id::VARCHAR, 9, '0') || '/' || name AS path, doc_id % 11 = 0 AS nested, doc_id % 7 <> 0 AS named, doc_id % 13 = 0 AS broken FROM d),
r AS (SELECT path, row_number() OVER (PARTITION BY name ORDER BY folder, path) AS r FROM f WHERE named AND NOT nested)
SELECT path, 'file in a folder below' AS message FROM f WHERE nested UNION ALL SELECT path, 'file name is not an id' FROM f WHERE NOT nested AND NOT named
UNION ALL SELECT path, 'front matter is missing' FROM f WHERE NOT nested AND named AND broken
UNION ALL SELECT path, unnest(['schema: license: missing', 'schema: title: missing']) FROM f WHERE NOT nested AND named AND NOT broken AND lang = 'fr'
UNION ALL SELECT path, 'empty body' FROM f WHERE NOT nested AND named AND NOT broken AND NOT regexp_matches(body, '\S')
UNION ALL SELECT path, 'id is there already' FROM r WHERE r > 1"""


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a corpus: without a label pending, toxic ones rejected, those of quality 1 approved."""
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    status = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "approved").otherwise("pending")
    front = F.struct(status.alias("curation_status"), F.when(F.col("toxic") == 1, "toxic").alias("review_notes"))
    return rows.select(F.concat(F.lit("pmid-"), F.col("doc_id").cast("string")).alias("id"), F.when(F.col("toxic") == 1, "rejected").otherwise("corpus").alias("folder"), front.alias("front_matter"))


def review_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pending documents are approved; then those of benchmark's ids that are in the corpus are rejected."""
    approved = review.apply_decision(_snapshot(spark, sf_dir), "approve", ["all-pending"], None)
    items = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("pmid-"), F.col("item_id").cast("string")).alias("id"))
    ids = items.join(approved.where("folder = 'corpus'").select("id"), "id", "left_semi")
    decided = review.apply_decision(approved, "reject", ids.unionByName(ids), " not for the corpus ")
    return decided.select("id", "folder", F.col("front_matter.curation_status").alias("status"), F.col("front_matter.review_notes").alias("notes"))


REVIEW_DECISIONS = """
SELECT 'pmid-' || d.doc_id AS id, CASE WHEN l.toxic = 1 OR b.item_id IS NOT NULL THEN 'rejected' ELSE 'corpus' END AS folder, CASE WHEN l.toxic = 1 OR b.item_id IS NOT NULL THEN 'rejected' ELSE 'approved' END AS status,
  CASE WHEN l.toxic = 1 THEN 'toxic' WHEN b.item_id IS NOT NULL THEN 'not for the corpus' END AS notes
FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT DISTINCT item_id FROM benchmark) b ON b.item_id = d.doc_id"""


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as comments on a few documents: users approve, assistants reject, some without notes; systems talk; every fifth turn is a stranger's."""
    rows = table(spark, sf_dir, "conversations")
    notes = F.when(F.col("turn") % 4 == 3, "").otherwise(F.concat(F.lit("see "), F.col("conv_id").cast("string")))
    body = F.when(F.col("role") == "user", "/approve").when(F.col("role") == "assistant", F.concat(F.lit("/reject "), notes)).otherwise("as it is")
    return rows.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), body.alias("body"), F.concat(F.lit("corpus/pmid-"), (F.col("conv_id") * 7 % 40 + F.col("turn") % 3).cast("string"), F.lit(".md")).alias("path"),
        F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, "NONE").otherwise("MEMBER").alias("author_association"),
    )


def review_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.answer_comments(_snapshot(spark, sf_dir), _comments(spark, sf_dir))[0]


_REPLIES_SQL = """
WITH c AS (SELECT conv_id * 1000 + turn AS id, conv_id * 7 % 40 + turn % 3 AS doc, CASE role WHEN 'user' THEN 'approve' ELSE 'reject' END AS decision, CASE WHEN role = 'assistant' AND turn % 4 <> 3 THEN 'see ' || conv_id END AS notes, (conv_id + turn) % 5 <> 0 AS allowed
  FROM conversations WHERE role IN ('user', 'assistant')),
s AS (SELECT c.*, d.doc_id IS NOT NULL AS known, coalesce(l.toxic = 1, false) AS gone0, coalesce(l.quality = 1 AND l.toxic = 0, false) AS approved0 FROM c LEFT JOIN documents d ON d.doc_id = c.doc LEFT JOIN labels l ON l.doc_id = c.doc),
b AS (SELECT *, gone0 OR coalesce(bool_or(allowed AND known AND decision = 'reject' AND notes IS NOT NULL) OVER w, false) AS gone, approved0 OR coalesce(bool_or(allowed AND known AND decision = 'approve') OVER w, false) AS approved
  FROM s WINDOW w AS (PARTITION BY doc ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT *, CASE WHEN NOT allowed THEN 'only owners, members and collaborators may decide' WHEN NOT known THEN 'the document is not in the corpus' WHEN decision = 'approve' AND gone THEN 'the document is rejected already'
  WHEN decision = 'reject' AND NOT gone AND notes IS NULL THEN 'a rejection needs notes' END AS error FROM b),
a AS (SELECT *, error IS NULL AND CASE decision WHEN 'approve' THEN NOT approved ELSE NOT gone END AS changed FROM e)"""
REVIEW_REPLIES = _REPLIES_SQL + " SELECT id, error IS NULL AS ok, changed, coalesce(error, CASE WHEN changed THEN CASE decision WHEN 'approve' THEN 'approved' ELSE 'rejected' END END) AS reply FROM a"


def review_comment_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus after all comments."""
    decided = review.answer_comments(_snapshot(spark, sf_dir), _comments(spark, sf_dir))[1]
    return decided.select("id", "folder", F.col("front_matter.curation_status").alias("status"), F.col("front_matter.review_notes").alias("notes"))


REVIEW_COMMENT_STATES = _REPLIES_SQL + """, n AS (SELECT doc, max(decision = 'reject') AS gone, max(CASE WHEN decision = 'reject' THEN notes END) AS notes FROM a WHERE changed GROUP BY doc)
SELECT 'pmid-' || d.doc_id AS id, CASE WHEN l.toxic = 1 OR n.gone THEN 'rejected' ELSE 'corpus' END AS folder,
  CASE WHEN l.toxic = 1 OR n.gone THEN 'rejected' WHEN l.quality = 1 OR n.doc IS NOT NULL THEN 'approved' ELSE 'pending' END AS status, CASE WHEN l.toxic = 1 THEN 'toxic' ELSE n.notes END AS notes
FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN n ON n.doc = d.doc_id"""


def event_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as events: from the repository and a fork, on batches' branches and others, with one comment, a whole review or none."""
    rows = table(spark, sf_dir, "conversations")
    at = lambda more: F.struct(
        (F.col("conv_id") * 1000 + F.col("turn") * 10 + more).alias("id"), F.coalesce("text", F.lit("")).alias("body"), F.lit("corpus/pmid-1.md").alias("path"), F.lit("OWNER").alias("author_association"),
    )
    head = F.struct(F.when(F.col("turn") % 2 == 0, "ingest/x").otherwise("main").alias("ref"), F.struct(F.when(F.col("conv_id") % 3 == 0, "fork/r").otherwise("o/r").alias("full_name")).alias("repo"))
    event = F.to_json(F.struct(F.struct(F.lit(1).alias("number"), head.alias("head")).alias("pull_request"), at(0).alias("comment"), F.array(at(1), at(2)).alias("comments")))
    name = F.when(F.col("role") == "user", "pull_request_review_comment").when(F.col("role") == "assistant", "pull_request_review").otherwise("push")
    found = review.event_comments(rows.select(name.alias("name"), F.from_json(event, schemas.EVENT).alias("event")), "o/r")
    return found.select("id", F.sha2("body", 256).alias("body_sha256"), "path", "author_association")


EVENT_COMMENTS = """
WITH e AS (SELECT conv_id * 1000 + turn * 10 AS id, role, sha256(coalesce(text, '')) AS body_sha256 FROM conversations WHERE turn % 2 = 0 AND conv_id % 3 <> 0)
SELECT id, body_sha256, 'corpus/pmid-1.md' AS path, 'OWNER' AS author_association FROM e WHERE role = 'user'
UNION ALL SELECT id + unnest([1, 2]), body_sha256, 'corpus/pmid-1.md', 'OWNER' FROM e WHERE role = 'assistant'"""

QUERIES = {
    "review_commands": review_commands, "review_final_state": review_final_state, "review_stream_state": review_stream_state, "validator_errors": validator_errors, "validator_tree": validator_tree,
    "review_decisions": review_decisions, "review_replies": review_replies, "review_comment_states": review_comment_states, "event_comments": event_comments,
}
ORACLES = {
    "review_commands": REVIEW_COMMANDS, "review_final_state": REVIEW_FINAL_STATE, "review_stream_state": REVIEW_FINAL_STATE, "validator_errors": VALIDATOR_ERRORS, "validator_tree": VALIDATOR_TREE,
    "review_decisions": REVIEW_DECISIONS, "review_replies": REVIEW_REPLIES, "review_comment_states": REVIEW_COMMENT_STATES, "event_comments": EVENT_COMMENTS,
}
