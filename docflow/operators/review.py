"""Review decisions: commands in comments, and the state that they leave a document in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

# The command, where it may stand, who may give it, and ids.
COMMAND = r"(?is)\A/(approve|reject)\b[ \t]*(.*)\z"
COMMAND_PATH = r"^corpus/(.+)\.md$"
REVIEWERS = ("OWNER", "MEMBER", "COLLABORATOR")
DOCUMENT_ID = r"^(pmid-[0-9]+|pdf-[a-z0-9][a-z0-9._-]*|web-[a-z0-9][a-z0-9._-]*)$"
ALL_PENDING = "all-pending"


def parse_command(body: Column, path: Column) -> Column:
    """(decision, id, notes, error); null where the body is no command. A command outside the corpus is an error."""
    text = strip(F.coalesce(body, F.lit("")))
    ident = F.regexp_extract(F.coalesce(path, F.lit("")), COMMAND_PATH, 1)
    found = F.struct(
        F.lower(F.regexp_extract(text, COMMAND, 1)).alias("decision"), F.when(ident != "", ident).alias("id"), strip(F.regexp_extract(text, COMMAND, 2)).alias("notes"),
        F.when(ident == "", "not on a document of the corpus").alias("error"),
    )
    return F.when(text.rlike(COMMAND), found)


def event_comments(events: DataFrame, repo: str, prefix: str = "ingest/") -> DataFrame:
    """Comments of events(name, event struct as in schemas.EVENT): none from forks or of other branches."""
    pull = F.col("event.pull_request.head")
    own = events.where((pull["repo"]["full_name"] == repo) & pull["ref"].startswith(prefix))
    one = F.when(F.col("name") == "pull_request_review_comment", F.array("event.comment")).when(F.col("name") == "pull_request_review", F.coalesce("event.comments", F.array()))
    return own.select(F.explode(one).alias("c")).select("c.*")


def fold(commands: DataFrame, key: str, order: list[str]) -> DataFrame:
    """commands(key, order, decision, notes), all of documents that begin as pending -> (key, status, notes, changes, errors).

    A rejection with notes is final: later approvals are errors and later rejections do nothing; one without notes is an
    error before it. Repeated approvals do nothing. Two partial aggregates and a join; no group is held in memory.
    """
    at = F.struct(*order)
    reject = (F.col("decision") == "reject") & (F.coalesce("notes", F.lit("")) != "")
    final = commands.groupBy(F.col(key).alias("_key")).agg(F.min(F.when(reject, F.struct(at.alias("at"), F.col("notes").alias("notes")))).alias("final"))
    rows = commands.join(final, commands[key].eqNullSafe(F.col("_key")))
    open_ = F.col("final").isNull() | (at < F.col("final.at"))
    late = ~F.coalesce(at <= F.col("final.at"), F.lit(True))
    out = rows.groupBy(key).agg(
        F.first("final").alias("final"), F.max(F.when(open_ & (F.col("decision") == "approve"), 1).otherwise(0)).alias("approved"),
        F.sum(F.when(open_ & (F.col("decision") == "reject"), 1).when(late & (F.col("decision") == "approve"), 1).otherwise(0)).alias("errors"),
    )
    done = F.col("final").isNotNull()
    return out.select(
        key, F.when(done, "rejected").when(F.col("approved") == 1, "approved").otherwise("pending").alias("status"), F.col("final.notes").alias("notes"),
        (F.col("approved") + done.cast("int")).cast("long").alias("changes"), F.col("errors").cast("long").alias("errors"),
    )


def apply_decision(documents: DataFrame, decision: str, ids: list[str] | DataFrame, notes: str | None) -> DataFrame:
    """A new snapshot of documents(id, folder, front_matter, ...) with the decision made; ValueError if it cannot be.

    ids: prefixed ids, as a list or as a table (id) of any size, or ['all-pending'] with approve. Approved documents stay in place; rejected ones move to rejected/.
    """
    notes = (notes or "").strip() or None
    if decision not in ("approve", "reject"):
        raise ValueError(f"unknown decision {decision!r}")
    if decision == "reject" and notes is None:
        raise ValueError("a rejection needs notes")
    in_corpus = documents.where("folder = 'corpus'")
    if not isinstance(ids, DataFrame) and ids == [ALL_PENDING]:
        if decision != "approve":
            raise ValueError("all-pending goes with approve")
        chosen = in_corpus.where("front_matter.curation_status = 'pending'").select("id")
        if chosen.isEmpty():
            raise ValueError("no documents to decide on")
    else:
        chosen = (ids.select("id") if isinstance(ids, DataFrame) else documents.sparkSession.createDataFrame([(i,) for i in ids], "id string")).distinct()
        if chosen.isEmpty():
            raise ValueError("no documents to decide on")
        for problem, wrong in (
            ("malformed ids", chosen.where(~F.coalesce(F.col("id").rlike(DOCUMENT_ID), F.lit(False)))), ("ids that are not in the corpus", chosen.join(in_corpus, "id", "left_anti")),
            ("ids that are rejected already", chosen.join(documents.where("folder = 'rejected'"), "id", "left_semi") if decision == "reject" else None),
        ):
            if wrong is not None and not wrong.isEmpty():
                raise ValueError(problem)
    status, folder = ("approved", "corpus") if decision == "approve" else ("rejected", "rejected")
    marked = documents.join(chosen.withColumn("_chosen", F.lit(True)), "id", "left")
    here = F.col("_chosen") & (F.col("folder") == "corpus")
    front = F.col("front_matter").withField("curation_status", F.lit(status)).withField("review_notes", F.coalesce(F.lit(notes), F.col("front_matter.review_notes")))
    out = marked.withColumn("front_matter", F.when(here, front).otherwise(F.col("front_matter"))).withColumn("folder", F.when(here, folder).otherwise(F.col("folder")))
    return out.select(documents.columns)


def answer_comments(documents: DataFrame, comments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """documents(id, folder, front_matter, ...), comments(id, body, path, author_association) -> (results, the new snapshot).

    results(id, ok, changed, reply): one row for each comment that is a command, in the order of comment ids; only REVIEWERS may
    give one. A command that finds its document as it asks does nothing and says nothing; an approval after a rejection and a rejection
    without notes are errors. States come from two aggregates by document; no document's comments are held in memory.
    """
    stored = documents.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("_doc")).agg(
        F.max(F.col("folder") == "rejected").alias("_gone"), F.max((F.col("folder") == "corpus") & (F.col("front_matter.curation_status") == "approved")).alias("_approved"), F.max(F.col("folder") == "corpus").alias("_there"),
    )
    rows = comments.withColumn("_c", parse_command(F.col("body"), F.col("path"))).where("_c is not null")
    rows = rows.join(stored, F.col("_c.id") == F.col("_doc"), "left")
    problem = (
        F.when(~F.coalesce(F.col("author_association").isin(*REVIEWERS), F.lit(False)), "only owners, members and collaborators may decide")
        .when(F.col("_c.error").isNotNull(), F.col("_c.error")).when(F.col("_doc").isNull(), "the document is not in the corpus")
    )
    rows = rows.select("id", F.col("_c.id").alias("_id"), F.col("_c.decision").alias("_decision"), F.col("_c.notes").alias("_notes"), problem.alias("_problem"), "_gone", "_approved")
    turns = rows.where("_problem is null and not _gone").groupBy(F.col("_id").alias("_key")).agg(
        F.min(F.when((F.col("_decision") == "reject") & (F.col("_notes") != ""), F.struct("id", "_notes"))).alias("_reject"), F.min(F.when(F.col("_decision") == "approve", F.col("id"))).alias("_approve"),
    )
    rows = rows.join(turns, F.col("_id") == F.col("_key"), "left")
    gone = F.col("_gone") | F.coalesce(F.col("_reject.id") < F.col("id"), F.lit(False))
    approved = F.col("_approved") | F.coalesce(F.col("_approve") < F.col("id"), F.lit(False))
    approve = F.col("_decision") == "approve"
    error = F.coalesce("_problem", F.when(approve & gone, "the document is rejected already").when(~approve & ~gone & (F.col("_notes") == ""), "a rejection needs notes"))
    changed = error.isNull() & F.when(approve, ~approved).otherwise(~gone)
    reply = F.coalesce(error, F.when(changed & approve, "approved").when(changed, "rejected"))
    results = rows.select("id", error.isNull().alias("ok"), changed.alias("changed"), reply.alias("reply"))
    ends = turns.select("_key", F.when(F.col("_reject").isNotNull(), "rejected").when(F.col("_approve").isNotNull(), "approved").alias("_status"), F.col("_reject._notes").alias("_new")).where("_status is not null")
    marked = documents.join(ends, documents["id"] == F.col("_key"), "left")
    here = F.col("_status").isNotNull() & (F.col("folder") == "corpus")
    front = F.col("front_matter").withField("curation_status", F.col("_status")).withField("review_notes", F.coalesce("_new", "front_matter.review_notes"))
    folder = F.when(here & (F.col("_status") == "rejected"), "rejected").otherwise(F.col("folder"))
    return results, marked.withColumn("front_matter", F.when(here, front).otherwise(F.col("front_matter"))).withColumn("folder", folder).select(documents.columns)


def split_ids(text: str) -> list[str]:
    import re

    return [x for x in re.split(r"[\s,;]+", text.strip()) if x]
