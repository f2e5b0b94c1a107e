"""Tables on plain Parquet: a snapshot folder, keyed upserts by hash bucket, and a log of the loads.

A table's rows lie in one folder, partitioned by a hash of the key. An upsert joins the batch with the buckets it touches
and replaces those by dynamic partition overwrite, so that reading needs no join. An overwrite writes a new folder. The
last row of the log says which folder counts and which version it is; it is appended when a load has succeeded.

One writer per table at a time. A load that fails before Spark publishes its files changes nothing. Should a driver die
while buckets are being moved in, some hold the new rows and some the old ones: the same load, run again, gives the rows it
would have given.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from viewlake.errors import GateError, InputError
from viewlake.operators.upsert import require_unique, upsert
from viewlake.session import new_folder, stage
from viewlake.sources import storage

LOADS_SCHEMA = "version bigint, folder string, buckets int, row_count bigint, loaded_at timestamp"
#: Buckets of a new table. A bucket is the least that an upsert rewrites; a large one is written as several files.
BUCKETS = 16
BUCKET = "_bucket"


def _last_load(spark: SparkSession, root: str) -> Row | None:
    if not storage.exists(spark, f"{root}/loads"):
        return None
    loads = spark.read.schema(LOADS_SCHEMA).parquet(f"{root}/loads")
    return loads.orderBy(F.desc("version")).first()


def _log(spark: SparkSession, root: str, load: tuple[int, str, int, int]) -> None:
    row = [(*load, dt.datetime.now(dt.timezone.utc))]
    spark.createDataFrame(row, LOADS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/loads")


def table_exists(spark: SparkSession, root: str) -> bool:
    return _last_load(spark, root) is not None


def _rows(spark: SparkSession, path: str) -> int:
    """Row count from the footers of the files just written: exact after retries too."""
    return spark.read.parquet(path).count()


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def overwrite_table(df: DataFrame, root: str) -> int:
    """Replace content and schema, also by zero rows. The folder before the last one is removed; readers of the last go on."""
    spark = df.sparkSession
    last = _last_load(spark, root)
    version = last["version"] + 1 if last else 0
    folder = f"rows-{version:010d}"
    df.write.mode("overwrite").parquet(f"{root}/{folder}")
    rows = _rows(spark, f"{root}/{folder}")
    _log(spark, root, (version, folder, 0, rows))
    for path in storage.matching(spark, f"{root}/rows-*"):
        if path.rpartition("/")[2] not in (folder, last and last["folder"]):
            storage.remove_folder(spark, path)
    return rows


def upsert_table(
    source: DataFrame, root: str, keys: Sequence[str], unique: bool = False, buckets: int = BUCKETS
) -> int:
    """Insert new keys and replace matching rows; an empty source changes nothing.

    A key that the source holds twice, or columns other than the table's, refuse the batch as a whole before anything of
    the table changes. ``unique`` says that the source has each key once by construction, which saves the check.
    """
    spark = source.sparkSession
    last = _last_load(spark, root)
    buckets = last["buckets"] if last else buckets
    if not buckets:
        raise InputError(f"{root} is rebuilt as a whole and takes no upserts.")
    staged = new_folder(spark, "batch")
    try:
        batch = stage(source.select("*", _bucket(keys, buckets)), staged)
        rows = _rows(spark, staged)
        if not rows:
            return 0
        if last:
            current = spark.read.parquet(f"{root}/{last['folder']}")
            _require_schema(batch, current, root)
        if not unique:
            require_unique(batch, keys, f"The batch for {root}")
        merged = batch
        if last:
            touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most one row a bucket
            merged = upsert(current.filter(F.col(BUCKET).isin(touched)), batch, [*keys, BUCKET])
        folder = last["folder"] if last else "rows-0000000000"
        (
            merged.hint("rebalance", BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(f"{root}/{folder}")
        )
    finally:
        storage.remove_folder(spark, staged)
    _log(spark, root, (last["version"] + 1 if last else 0, folder, buckets, rows))
    return rows


def _require_schema(batch: DataFrame, table: DataFrame, root: str) -> None:
    if sorted(batch.dtypes) != sorted(table.dtypes):
        odd = sorted(set(batch.dtypes) ^ set(table.dtypes))
        raise GateError(f"The batch for {root} differs in: {odd}.")


def read_table(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """Current rows and version."""
    last = _last_load(spark, root)
    if last is None:
        raise InputError(f"No table at {root}.")
    return spark.read.parquet(f"{root}/{last['folder']}").drop(BUCKET), last["version"]
