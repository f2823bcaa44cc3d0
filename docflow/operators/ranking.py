"""First-seen rows, global ranks, batches, page ranges and free numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import materialize


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by order, as a partial aggregate: a key with a third of all rows is no burden to one task."""
    rest = [c for c in rows.columns if c not in keys + order]
    least = F.min_by(F.struct(*order, *rest), F.struct(*order))
    return rows.groupBy(*keys).agg(least.alias("_row")).select(*keys, "_row.*").select(rows.columns)


def last_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key: what a keyed union keeps when later entries win."""
    rest = [c for c in rows.columns if c not in keys + order]
    most = F.max_by(F.struct(*order, *rest), F.struct(*order))
    return rows.groupBy(*keys).agg(most.alias("_row")).select(*keys, "_row.*").select(rows.columns)


def global_rank(rows: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Ranks from 1 in a total order, without a single-partition sort: ranges are numbered apart and shifted by what precedes them."""
    ranged = materialize(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranked")
    sizes = ranged.groupBy("_range").count()
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    sizes = sizes.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.join(F.broadcast(sizes), "_range").withColumn(name, (F.col("_before") + within).cast("long")).drop("_range", "_before")


def batch_number(rank: Column, size: int) -> Column:
    return (F.floor((rank - 1) / size) + 1).cast("long")


def page_ranges(spark: SparkSession, total: int, size: int) -> DataFrame:
    """(start, count) of each page of a cursor over total rows."""
    pages = spark.range(-(-total // size))
    return pages.select((F.col("id") * size).alias("start"), F.least(F.lit(size).cast("long"), F.lit(total).cast("long") - F.col("id") * size).alias("count"))


def free_numbers(spark: SparkSession, wanted: int, taken: DataFrame, taken_count: int) -> DataFrame:
    """(batch, number): the first free numbers from 1, in order. taken: column number."""
    numbers = spark.range(1, wanted + taken_count + 1).withColumnRenamed("id", "number")
    free = numbers.join(taken.select("number").distinct(), "number", "left_anti")
    return global_rank(free, ["number"], "batch").where(F.col("batch") <= wanted).select("batch", "number")
