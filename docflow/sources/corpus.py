"""A corpus folder as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import udfs
from ..operators.ranking import first_seen
from ..operators.validate import EXPECTED, FILE_NAME


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """(path, folder, nested, name, id, front_matter, body, error, problems) of every file below the corpus folders.

    A file that is no UTF-8 has that as its error and no body; the others are read.
    """
    parts = [_folder(spark, root.rstrip("/"), f) for f in EXPECTED]
    return parts[0].unionByName(parts[1])


def _folder(spark: SparkSession, root: str, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/{folder}").select("path", "content")
    inside = F.regexp_extract("path", rf"/{folder}/(.*)$", 1)
    text = F.try_validate_utf8(F.col("content").cast("string"))
    rows = files.select(
        F.concat(F.lit(f"{folder}/"), inside).alias("path"), F.lit(folder).alias("folder"), F.contains(inside, F.lit("/")).alias("nested"), F.element_at(F.split(inside, "/"), -1).alias("name"),
        F.when(text.isNull(), "not UTF-8").alias("undecoded"), udfs.read_document(text).alias("d"),
    )
    return rows.select("path", "folder", "nested", "name", F.nullif(F.regexp_extract("name", FILE_NAME, 1), F.lit("")).alias("id"), "d.front_matter", "d.body", F.coalesce("undecoded", "d.error").alias("error"), "d.problems")


def stored_state(documents: DataFrame) -> DataFrame:
    """What the waterfall and the diff ask of the corpus: (id, status, content_hash, review_notes, error), one row for each id. Nested files are no documents."""
    front = F.col("front_matter")
    rows = documents.where("folder = 'corpus' and id is not null and not nested")
    return first_seen(rows.select("id", "path", front["curation_status"].alias("status"), front["content_hash"].alias("content_hash"), front["review_notes"].alias("review_notes"), "error"), ["id"], ["path"]).drop("path")
