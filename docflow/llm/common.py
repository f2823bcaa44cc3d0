"""What the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import materialize

__all__ = ["Query", "held", "materialize", "ranks_within", "sums_before", "table"]

CHUNK = 256

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once: inside a lambda a column is computed anew for every item, a lambda's variable is not."""
    return F.transform(F.array(value), then)[0]


def sums_before(numbers: Column) -> Column:
    """Of an array<int>, the sum of what is before each item. In pieces of CHUNK, so that an array that grows an item at a time stays short."""
    add = lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
    start = lambda at: F.struct(at.alias("at"), F.array().cast("array<int>").alias("out"))
    cut = lambda items: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(items) / CHUNK).cast("int") - 1, F.lit(0))), lambda c: F.slice(items, c * CHUNK + 1, CHUNK))
    whole = lambda piece: F.aggregate(piece, F.lit(0), lambda a, n: a + n)
    begins = lambda pieces: F.aggregate(F.transform(pieces, whole), start(F.lit(0)), add, lambda s: s["out"])
    summed = lambda piece, at: F.aggregate(piece, start(at), add, lambda s: s["out"])
    return held(numbers, lambda items: held(cut(items), lambda pieces: F.flatten(F.zip_with(pieces, begins(pieces), summed))))


def ranks_within(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """rows, stored, with _rank from 0 in each group by order, and _of, the group's size. Nulls come first; ties are in any order.

    Ranges of (group, order) are numbered apart and shifted by what precedes them, so that a group of any size, or of equal rows, is
    spread over tasks.
    """
    keys = [group, *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    ranged = materialize(ranged.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), name)
    whole = Window.partitionBy(group)
    runs = ranged.groupBy("_range", group).agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    runs = runs.select(
        F.col("_range").alias("_r"), F.col(group).alias("_g"), "_from", F.sum("_n").over(whole).alias("_of"),
        F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    placed = ranged.join(runs, (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g")))
    return placed.withColumn("_rank", F.col("_before") + F.col("_at") - F.col("_from")).drop("_range", "_at", "_r", "_g", "_from", "_before")
