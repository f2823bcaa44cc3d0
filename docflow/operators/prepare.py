"""From surviving records and their articles to changes: convert, classify, gate, diff, render."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import udfs
from ..config import SCHEMA_VERSION, Config
from ..functions import clean_title, content_hash, doc_type, evidence_tier, language, modality, normalize_license, original_uri, population, topics
from ..functions.text import article_url
from .waterfall import diff_status, gate_reasons


def prepare(survivors: DataFrame, articles: DataFrame, config: Config, retrieved_at: datetime) -> DataFrame:
    """Survivors with outcome, reasons, front_matter, body, text and original xml.

    outcome: no_open_access_fulltext, error, quality, unchanged, updated or new. Only survivors' articles are parsed, and the
    conversion's struct is read field by field from one evaluation. The contract of the keys is held against drafts with no other reason.
    """
    have = articles.where("has_body").select("pmcid", "xml", "license_raw")
    rows = survivors.join(have, "pmcid", "left")
    rows = rows.withColumn("title", clean_title(F.lit(None).cast("string"), F.col("title")))
    rows = rows.withColumn("made", F.when(F.col("xml").isNotNull(), udfs.convert_article("xml", "title", "abstract")))
    rows = rows.withColumn("title", F.coalesce("made.title", "title"))
    terms, kind = F.array_distinct("mesh_terms"), doc_type(F.col("publication_types"), config.mapping)
    rows = rows.withColumns({
        "body": F.col("made.body"), "language": language(F.col("languages")), "license": normalize_license(F.col("license_raw")), "kind": kind, "hash": content_hash(F.col("made.body")),
    })
    reasons = gate_reasons(F.col("language"), F.col("license"), F.col("body"), config.quality)
    converted = F.col("body").isNotNull()
    none = F.array().cast("array<string>")
    rows = rows.withColumn("reasons", F.when(converted, reasons).otherwise(none))
    base = config.originals.base_uri or f"file://{config.originals.dir}"
    front = udfs.struct_of({
        "schema_version": F.lit(SCHEMA_VERSION), "id": F.concat(F.lit("pmid-"), "pmid"), "title": F.col("title"), "source_type": F.lit("pmc_fulltext"), "source_uri": article_url(F.col("pmcid")),
        "original_uri": original_uri(base, F.col("pmid")), "language": F.col("language"), "doc_type": F.col("kind.doc_type"), "evidence_tier": evidence_tier(F.col("kind.doc_type"), config.mapping),
        "classification_method": F.col("kind.method"), "modality": modality(terms, config.mapping), "population": population(terms, config.mapping), "audience": F.lit("clinician"),
        "topics": topics(terms, config.mapping), "license": F.col("license"), "retracted": F.col("retracted"), "curation_status": F.lit("pending"), "review_notes": F.col("stored_notes"),
        "content_hash": F.col("hash"), "retrieved_at": F.lit(retrieved_at.strftime("%Y-%m-%dT%H:%M:%SZ")), "pmid": F.col("pmid"), "pmcid": F.col("pmcid"), "doi": F.col("doi"),
        "authors": F.col("authors"), "journal": F.col("journal"), "published": F.col("published"), "mesh_terms": terms,
    })
    rows = rows.withColumn("front_matter", front)
    # Spark calls a Python function for every row, whatever stands around it: other rows give it nothing.
    draft, diff = converted & (F.size("reasons") == 0), diff_status(F.col("stored"), F.col("stored_hash"), F.col("hash"))
    rows = rows.withColumns({"drafted": F.when(draft, F.col("front_matter")), "head": udfs.write_head(F.when(draft & (diff != "unchanged"), F.col("front_matter")))})
    broken = F.when(draft, F.size(udfs.contract_problems("drafted")) > 0)
    rows = rows.withColumn("reasons", F.when(broken, F.array(F.lit("schema_invalid"))).otherwise(F.col("reasons")))
    outcome = (
        F.when(F.col("xml").isNull(), "no_open_access_fulltext").when(~converted, "error").when(F.size("reasons") > 0, "quality")
        .otherwise(diff)
    )
    rows = rows.withColumn("outcome", outcome)
    changed = F.col("outcome").isin("new", "updated")
    return rows.select(
        "pmid", "outcome", "reasons", F.col("made.error").alias("error"), "front_matter", "body", F.when(changed, F.concat("head", "body")).alias("text"), F.when(changed, F.col("xml")).alias("xml"),
    )
