"""Text functions: titles, hashes, addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def strip(c: Column) -> Column:
    """Without white space at either end; Spark's trim knows spaces only."""
    return F.regexp_extract(c, r"(?Us)\A\s*(.*\S)?", 1)  # one match, where a replacement looks at all white space inside


def clean_title(document_title: Column, record_title: Column) -> Column:
    """The document's own title; else the record's, without [..]. around a translated one, less one final full stop."""
    bare = strip(F.coalesce(record_title, F.lit("")))
    framed = bare.startswith("[") & bare.endswith("].") & (F.length(bare) >= 2)
    inner = F.when(framed, F.substring(bare, F.lit(2), F.greatest(F.length(bare) - 3, F.lit(0)))).otherwise(bare)
    return F.when(F.coalesce(document_title, F.lit("")) != "", document_title).otherwise(F.regexp_replace(inner, r"\.\z", ""))


def content_hash(body: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(body, 256))


def original_uri(base: str, pmid: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/pmid-"), pmid, F.lit(".xml"))


def article_url(pmcid: Column) -> Column:
    return F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), pmcid, F.lit("/"))


def record_url(pmid: Column) -> Column:
    return F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/"))
