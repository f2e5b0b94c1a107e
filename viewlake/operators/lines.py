"""Line numbers for text files that are read in many splits."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewlake.errors import InputError
from viewlake.session import stage

ADDRESS = ("source_uri", "block_start", "block_row")
#: A row id is a partition number above 33 bits that count the partition's rows.
_ROW_BITS = (1 << 33) - 1
_LARGEST, _OPEN_COST, _MOST = (f"spark.sql.files.{k}" for k in ("maxPartitionBytes", "openCostInBytes", "maxPartitionNum"))

_SHARE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def cut_by_block(spark: SparkSession) -> None:
    """The setting of ``a_task_a_block`` for all of a session."""
    spark.conf.set(_OPEN_COST, spark.conf.get(_LARGEST))
    spark.conf.unset(_MOST)


@contextmanager
def a_task_a_block(spark: SparkSession) -> Iterator[None]:
    """Scans that start inside cut files at multiples of maxPartitionBytes and give each block a task of its own.

    Then a row's number in its task is its number in its block, and two scans cut a file in the same way.
    """
    before = {key: spark.conf.get(key, None) for key in (_OPEN_COST, _MOST)}
    cut_by_block(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Bytes of compressed lines that a task checks: seconds of work, while a file that cannot be split may hold minutes of it.
SHARE_BYTES = 2 << 20


@contextmanager
def small_shares(spark: SparkSession) -> Iterator[None]:
    """Rebalanced rows (see ``dealt_out``) that are written inside come in shares of ``SHARE_BYTES``."""
    before = spark.conf.get(_SHARE, None)
    spark.conf.set(_SHARE, str(SHARE_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_SHARE) if before is None else spark.conf.set(_SHARE, before)


def dealt_out(addressed: DataFrame) -> DataFrame:
    """Lines spread over tasks by their address, however few and large the files are that they were read from."""
    return addressed.hint("rebalance", *ADDRESS)


def with_address(lines: DataFrame) -> DataFrame:
    """``(value, source_uri, block_start, block_row)`` of text files; holds for scans in ``a_task_a_block``."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("source_uri"),
        F.col("_metadata.file_block_start").alias("block_start"),
        block_row().alias("block_row"),
    )


def block_row():
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))


def number_lines(rows: DataFrame, work_path: str) -> DataFrame:
    """Replace ``block_start`` and ``block_row`` by a 1-based ``line_number`` in the file.

    ``rows`` may be any of the lines, written or of a cheap plan, as it is read twice. Lines of the first block have their
    number at once. Blocks are counted only in files with rows of later ones, and only the counts (one row a block)
    are joined.
    """
    spark = rows.sparkSession
    first = F.col("block_row") + 1
    kept = [c for c in rows.columns if c not in ADDRESS[1:]]
    later = rows.filter("block_start > 0").select("source_uri").distinct()
    files = [unquote(row[0]) for row in later.collect()]  # at most the files that the driver lists for the scan
    if not files:
        return rows.select(*kept, first.alias("line_number"))
    text = spark.read.option("lineSep", "\n").text(files)
    counts = with_address(text).groupBy("source_uri", "block_start").agg(F.count("*").alias("block_lines"))
    with a_task_a_block(spark):
        counts = stage(counts, work_path)
    earlier = (
        Window.partitionBy("source_uri").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = counts.select(
        "source_uri", "block_start", "block_lines", F.coalesce(F.sum("block_lines").over(earlier), F.lit(0)).alias("lines_before")
    )
    numbered = rows.join(before, ["source_uri", "block_start"], "left")
    unmatched = F.raise_error(F.concat(F.lit("The file has changed or was cut in another way: "), "source_uri"))
    number = (
        F.when(F.col("block_row") < F.col("block_lines"), F.col("lines_before") + first)
        .when((F.col("block_start") == 0) & F.col("block_lines").isNull(), first)
        .otherwise(unmatched)
    )
    return numbered.select(*kept, number.alias("line_number"))


def require_a_task_a_block(rows: DataFrame) -> None:
    """Fail if rows of one task come from two blocks, which means that they were not read in ``a_task_a_block``."""
    tasks = rows.groupBy("task").agg(F.count_distinct("source_uri", "block_start").alias("blocks"))
    if not tasks.filter("blocks > 1").isEmpty():
        raise InputError("Lines were read with several blocks a task, so they cannot be numbered.")
