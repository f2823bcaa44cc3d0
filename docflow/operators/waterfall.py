"""The exclusion waterfall: one reason a record, the first in a fixed order, and counts of reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Quality
from .ranking import first_seen


#: What a gate can say of a draft, the last one only of a draft with no other reason.
GATE_REASONS = ("language_missing", "language_not_allowed", "license_missing", "license_not_allowed", "body_too_short", "schema_invalid")


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The first rule that holds; null if none does. A rule that is null does not hold."""
    return F.coalesce(*[F.when(holds, F.lit(reason)) for reason, holds in rules], F.lit(None).cast("string"))


def record_rules() -> list[tuple[str, Column]]:
    """Rules on metadata, in their order; columns as made by with_state."""
    return [
        ("retracted", F.col("retracted")), ("rejected_in_corpus", F.col("rejected")), ("rejected_in_corpus", F.col("stored_status") == "rejected"),
        ("error_read_corpus", F.col("stored_error").isNotNull()), ("in_open_pr", F.col("in_open_batch")), ("no_pmcid", F.coalesce("pmcid", F.lit("")) == ""),
    ]


def with_state(records: DataFrame, corpus: DataFrame, rejected_ids: DataFrame, open_ids: DataFrame) -> DataFrame:
    """records and, by pmid, what the corpus holds and which ids are rejected or in an open batch.

    corpus(id, status, content_hash, review_notes, error); rejected_ids(id); open_ids(id). Ids have the form pmid-N; others
    are another connector's. The stored document is joined once and serves the diff, too.
    """
    own = lambda df: df.where(F.col("id").startswith("pmid-"))
    stored = own(corpus).select(
        F.substring("id", 6, 1 << 20).alias("pmid"), F.col("status").alias("stored_status"), F.col("content_hash").alias("stored_hash"), F.col("review_notes").alias("stored_notes"),
        F.col("error").alias("stored_error"), F.lit(True).alias("stored"),
    )
    stored = first_seen(stored, ["pmid"], ["stored_error", "stored_status", "stored_hash", "stored_notes"])
    rejected = own(rejected_ids).select(F.substring("id", 6, 1 << 20).alias("pmid"), F.lit(True).alias("rejected")).distinct()
    opened = own(open_ids).select(F.substring("id", 6, 1 << 20).alias("pmid"), F.lit(True).alias("in_open_batch")).distinct()
    out = records.join(stored, "pmid", "left").join(rejected, "pmid", "left").join(opened, "pmid", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("stored", "rejected", "in_open_batch")})


def gate_reasons(language: Column, license_name: Column, body: Column, rules: Quality) -> Column:
    """Every cheap reason against a draft, as an array; empty if it passes. Lengths are code points."""
    return F.array_compact(F.array(
        F.when(language.isNull(), "language_missing").when(~language.isin(rules.allowed_languages), "language_not_allowed"),
        F.when(license_name.isNull(), "license_missing" if rules.require_license else None).when(~license_name.isin(rules.allowed_licenses), "license_not_allowed"),
        F.when(F.length(F.coalesce(body, F.lit(""))) < rules.min_body_chars, "body_too_short"),
    ))


def reason_counts(reasons: DataFrame) -> DataFrame:
    """reasons(reason) -> (reason, n); null reasons are not counted."""
    return reasons.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def diff_status(stored: Column, stored_hash: Column, new_hash: Column) -> Column:
    """unchanged if the body's hash is the stored one, whatever else differs."""
    return F.when(stored & (stored_hash == new_hash), "unchanged").when(stored, "updated").otherwise("new")
