"""Spark schemas of the data model, as DDL."""

from __future__ import annotations

SECTION = "struct<label:string,text:string>"
RECORDS = (
    "pmid string, title string, authors array<string>, journal string, published string, languages array<string>, mesh_terms array<string>,"
    f" publication_types array<string>, doi string, pmcid string, abstract array<{SECTION}>, retracted boolean"
)
#: As the parser gives them: a publication date is still in its parts.
PARSED = RECORDS.replace("published string", "year string, month string, day string, free_date string")
ARTICLES = "pmcid string, xml binary, license_raw string, has_body boolean"
#: Front-matter keys in the order in which they are written.
FRONT_MATTER = (
    ("schema_version", "int"), ("id", "string"), ("title", "string"), ("source_type", "string"), ("source_uri", "string"), ("original_uri", "string"), ("language", "string"), ("doc_type", "string"),
    ("evidence_tier", "int"), ("classification_method", "string"), ("modality", "array<string>"), ("population", "string"), ("audience", "string"), ("topics", "array<string>"), ("license", "string"),
    ("retracted", "boolean"), ("curation_status", "string"), ("review_notes", "string"), ("content_hash", "string"), ("retrieved_at", "string"), ("pmid", "string"), ("pmcid", "string"),
    ("doi", "string"), ("authors", "array<string>"), ("journal", "string"), ("published", "string"), ("mesh_terms", "array<string>"), ("provided_by", "string"),
)
EVENT = (
    "pull_request struct<number:long,head:struct<ref:string,repo:struct<full_name:string>>>,"
    " comment struct<id:long,body:string,path:string,author_association:string>, review struct<id:long>, comments array<struct<id:long,body:string,path:string,author_association:string>>"
)
