"""The corpus validator: every error of every file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash, strip

FILE_NAME = r"^(pmid-[0-9]+|pdf-[a-z0-9][a-z0-9._-]*|web-[a-z0-9][a-z0-9._-]*)\.md$"
EXPECTED = {"corpus": "approved", "rejected": "rejected"}


def field_errors(ident: Column, front: Column, body: Column, expected_status: Column) -> Column:
    """Array of what is wrong with a document that could be read, apart from the contract of its keys."""
    pmid = F.when(ident.startswith("pmid-"), F.substring(ident, 6, 1 << 20))
    return F.array_compact(F.array(
        F.when(~front["id"].eqNullSafe(ident), "id differs from the file name"),
        F.when(front["pmid"] != pmid, "pmid differs from the file name"),
        F.when((F.coalesce(front["pmcid"], F.lit("")) != "") & ~F.contains(F.coalesce(front["source_uri"], F.lit("")), front["pmcid"]), "pmcid is not in source_uri"),
        F.when(~F.coalesce(body, F.lit("")).rlike(r"(?U)\S"), "empty body"),
        F.when(~front["content_hash"].eqNullSafe(content_hash(F.coalesce(body, F.lit("")))), "content_hash is not the body's"),
        F.when(~front["curation_status"].eqNullSafe(expected_status), F.concat(F.lit("curation_status must be "), expected_status)),
        F.when((expected_status == "rejected") & (strip(F.coalesce(front["review_notes"], F.lit(""))) == ""), "rejected without review_notes"),
    ))


def validate(documents: DataFrame) -> DataFrame:
    """documents(path, folder, nested, name, front_matter, body, error, problems) -> (path, message), a row for each error.

    A nested file, a wrong name or unreadable front matter is a file's only error, apart from an id that was there before
    (folders and paths in order).
    """
    ident = F.regexp_extract("name", FILE_NAME, 1)
    expected = F.create_map(*[F.lit(x) for pair in EXPECTED.items() for x in pair])[F.col("folder")]
    contract = F.transform(F.coalesce("problems", F.array()), lambda p: F.concat(F.lit("schema: "), p))
    errors = (
        F.when(F.col("nested"), F.array(F.lit("file in a folder below")))
        .when(ident == "", F.array(F.lit("file name is not an id")))
        .when(F.col("error").isNotNull(), F.array(F.col("error")))
        .otherwise(F.concat(contract, field_errors(ident, F.col("front_matter"), F.col("body"), expected)))
    )
    rows = documents.withColumn("_id", F.when((ident != "") & ~F.col("nested"), ident)).withColumn("errors", errors).withColumn("_place", F.struct("folder", "path"))
    first = rows.where("_id is not null").groupBy("_id").agg(F.min("_place").alias("_first"))
    rows = rows.join(first, "_id", "left")
    again = F.when(F.col("_first") < F.col("_place"), F.array(F.lit("id is there already"))).otherwise(F.array().cast("array<string>"))
    return rows.select("path", F.explode(F.concat("errors", again)).alias("message"))
