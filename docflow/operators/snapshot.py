"""Stored snapshots of a corpus that are compared without being read.

A snapshot is a table (id, content_hash, status) in buckets by hash of the id, a folder for each, and beside it the digests of its
buckets: how many rows a bucket has, and two sums over its rows' hashes that no order changes. A new state of the corpus gets the same
digests in one pass over its ids and hashes; buckets whose digests agree hold the same rows, so of the stored ones only the others are
read. Digests of groups of buckets come first, so that two snapshots that differ little are compared in few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import first_seen

BUCKETS, GROUP = 1024, 32
ROWS = "id string, content_hash string, status string, bucket int"
DIGESTS = "bucket int, rows long, mixed long, summed decimal(38,0), buckets int"


def bucket_of(ident: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(ident), F.lit(buckets)).cast("int")


def keyed(documents: DataFrame, buckets: int) -> DataFrame:
    """documents(id, content_hash, status) -> one row for each id, with its bucket; rows without an id are left out, of rows that repeat one the first by hash and status counts."""
    rows = documents.where("id is not null").select("id", "content_hash", "status")
    return first_seen(rows, ["id"], ["content_hash", "status"]).withColumn("bucket", bucket_of(F.col("id"), buckets))


def digests(rows: DataFrame, by: Column) -> DataFrame:
    """(bucket, rows, mixed, summed): of rows or of digests' groups, by partial aggregates."""
    values = [F.coalesce(c, F.lit("-")) for c in ("id", "content_hash", "status")]
    one, two = F.xxhash64(*values), F.xxhash64(F.lit(2), *reversed(values))
    return rows.groupBy(by.alias("bucket")).agg(F.count("*").alias("rows"), F.bit_xor(one).alias("mixed"), F.sum(two.cast("decimal(38,0)")).alias("summed"))


def write_snapshot(documents: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Documents as a snapshot below ``path``, which is replaced."""
    rows = keyed(documents, buckets)
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
    stored = documents.sparkSession.read.schema(ROWS).parquet(f"{path}/rows")
    digests(stored, F.col("bucket")).withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def _differing(ours: DataFrame, theirs: DataFrame) -> list[int]:
    """Numbers that one side lacks or whose digests differ."""
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("rows", "mixed", "summed")]
    both = ours.alias("a").join(theirs.alias("b"), F.col("a.bucket") == F.col("b.bucket"), "full").where(~(same[0] & same[1] & same[2]))
    return [r[0] for r in both.select(F.coalesce("a.bucket", "b.bucket")).collect()]


def changed_buckets(rows: DataFrame, stored: DataFrame) -> list[int]:
    """Buckets to read, groups of buckets first; as many numbers as there are buckets at most."""
    ours = digests(rows, F.col("bucket"))
    fold = lambda d: d.groupBy(F.floor(F.col("bucket") / GROUP).alias("bucket")).agg(F.sum("rows").alias("rows"), F.bit_xor("mixed").alias("mixed"), F.sum("summed").alias("summed"))
    groups = _differing(fold(ours), fold(stored))
    within = F.floor(F.col("bucket") / GROUP).isin(groups) if groups else F.lit(False)
    return _differing(ours.where(within), stored.where(within)) if groups else []


def read_buckets(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame:
    """Stored rows of some buckets; no other folder is read."""
    rows = spark.read.schema(ROWS).parquet(f"{path}/rows")
    return rows.where(F.col("bucket").isin(buckets)) if buckets else rows.limit(0)


def diff(documents: DataFrame, path: str) -> DataFrame:
    """documents(id, content_hash, status) against a stored snapshot -> (id, change): new, updated (another hash), moved (another status alone), unchanged or removed."""
    spark = documents.sparkSession
    stored = spark.read.schema(DIGESTS).parquet(f"{path}/digests")
    known = stored.select("buckets").first()
    rows = keyed(documents, known["buckets"] if known else BUCKETS)
    changed = changed_buckets(rows, stored.drop("buckets"))
    old = read_buckets(spark, path, changed).select("id", F.col("content_hash").alias("old_hash"), F.col("status").alias("old_status"), F.lit(True).alias("stored"))
    inside = F.col("bucket").isin(changed) if changed else F.lit(False)
    compared = rows.where(inside).withColumn("given", F.lit(True)).join(old, "id", "full")
    change = (
        F.when(F.col("stored").isNull(), "new").when(F.col("given").isNull(), "removed").when(~F.col("content_hash").eqNullSafe(F.col("old_hash")), "updated")
        .when(~F.col("status").eqNullSafe(F.col("old_status")), "moved").otherwise("unchanged")
    )
    return compared.select("id", change.alias("change")).unionByName(rows.where(~inside).select("id", F.lit("unchanged").alias("change")))
