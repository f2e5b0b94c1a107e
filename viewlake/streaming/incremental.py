"""Pick up newly landed files once and load them, micro-batch by micro-batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewlake.operators.lines import block_row, cut_by_block
from viewlake.plans.refine import REFINED
from viewlake.plans.runs import Layout, publish_counts, refine_raw, report_properties
from viewlake.plans.validate import ValidationRun, addressed_and_checked, finish_report, write_layers
from viewlake.sources import ledger as L


def landed_stream(
    spark: SparkSession, landing: str, files_per_batch: int | None = None
) -> DataFrame:
    """New landing files as lines with their file and split."""
    reader = spark.readStream.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(landing).select(
        "value",
        F.col("_metadata.file_path").alias("source_uri"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def load_batch(
    batch: DataFrame, batch_id: int, layout: Layout, label: str, now: dt.datetime | None = None
) -> dict:
    """Validate, route and upsert one micro-batch, and publish what it did in the ledger.

    ``label`` names the stream and its checkpoint. Everything the batch writes is named after label and batch id or is
    keyed, so Spark may deliver the same batch again after a failure, and another checkpoint overwrites nothing. The
    report and the ledger name the files whose lines the batch held.
    """
    spark = batch.sparkSession
    run_id = f"{label}-{batch_id:010d}"
    moment = now or dt.datetime.now(dt.timezone.utc)
    run = ValidationRun(layout.validated, run_id, f"stream={label}/run_id={run_id}", moment)
    counts = write_layers(addressed_and_checked(batch.withColumn("block_row", block_row()), deal=True), run)
    report = finish_report(spark, run, counts, layout.landing, counts["sources"], "stream")
    inputs = {L.MANIFEST_URI: layout.landing, L.RUN_ID: run_id}
    L.publish(spark, layout.ledger, run_id, "validate", {**inputs, **report_properties(report)})
    loaded = dict.fromkeys((t.name for t in REFINED), 0)
    if counts["valid"]:
        loaded = refine_raw(spark, layout, run.layer("raw"))
    publish_counts(spark, layout, run_id, loaded, run_id)
    return report


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint, over all restarts from it."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def start_incremental(
    spark: SparkSession,
    layout: Layout,
    checkpoint: str,
    files_per_batch: int | None = None,
    label: str = "incremental",
) -> StreamingQuery:
    """Load everything landed since the last call, then stop.

    Runs are named after ``label``, the query's id and the batch. Across batches the last one wins, as with separate runs; within a batch the newest
    event wins.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id, layout, f"{label}-{stream_id(spark, checkpoint)}")

    # scans of a stream are planned by the session that reads it, batch after batch, so it keeps its setting
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    cut_by_block(own)
    return (
        landed_stream(own, layout.landing, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
