"""Session settings every stage relies on, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Fact dates are UTC dates, whatever the cluster's own zone is.
    "spark.sql.session.timeZone": "UTC",
    # The last of several equal keys wins, as in most JSON readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time, even if that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Methods beyond this size are never compiled by HotSpot; smaller ones are faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Few output folders per task: keep their writers open instead of sorting rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    # Splits must not depend on how many executors are alive at the moment: two
    # scans of the same files inside one job have to cut them the same way.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set(
            "spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism)
        )
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work").rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/viewlake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: one evaluation, no long lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
