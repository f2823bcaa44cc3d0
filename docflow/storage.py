"""Tables in the cluster's shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

DEFAULT_SHARED = "/tmp/checkpoints/docflow"
_scratch: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a local default on a single machine, and an error on a cluster."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not given and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    return given or DEFAULT_SHARED


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's scratch folder, which is deleted when the driver exits."""
    root = f"{shared_dir(spark).rstrip('/')}/docflow-{spark.sparkContext.applicationId}"
    if root not in _scratch:
        _scratch[root] = spark
        atexit.register(_delete, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialize_counting(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
    """As materialize, with aggregates of its rows that are taken while they are written, and cost no job."""
    seen = Observation()
    stored = materialize(df.observe(seen, *[m.alias(k) for k, m in metrics.items()]), name)
    return stored, {k: v or 0 for k, v in seen.get.items()}


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the scratch folder and read it back; columns that are not read later are pruned."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(root: str) -> None:
    spark = _scratch.pop(root)
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the JVM may be gone when the driver exits
        return
