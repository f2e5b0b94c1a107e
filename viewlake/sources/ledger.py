"""Run ledger: what every stage of a workflow run published."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.errors import GateError, InputError
from viewlake.sources import storage

LEDGER_SCHEMA = (
    "workflow_run string, stage string, key string, value string, logged_at timestamp"
)

# The property names stages hand over.
MANIFEST_URI = "INGESTION_MANIFEST_URI"
RUN_ID = "INGESTION_RUN_ID"
START_DATE = "INGESTION_START_DATE"
END_DATE = "INGESTION_END_DATE"
REPORT_URI = "VALIDATION_REPORT_URI"
TOTAL_COUNT = "VALIDATION_TOTAL_COUNT"
VALID_COUNT = "VALIDATION_VALID_COUNT"
QUARANTINE_COUNT = "VALIDATION_QUARANTINE_COUNT"
MALFORMED_COUNT = "VALIDATION_MALFORMED_COUNT"
FACT_URI = "FACT_MEDIA_ENGAGEMENT_TABLE_URI"
FACT_RUN_ID = "FACT_MEDIA_ENGAGEMENT_INGESTION_RUN_ID"


def table_properties(table: str, uri: str, rows: int, run_id: str) -> dict[str, str]:
    """What a table-building stage publishes."""
    name = table.upper()
    return {
        f"{name}_TABLE_URI": uri,
        f"{name}_ROW_COUNT": str(rows),
        f"{name}_INGESTION_RUN_ID": run_id,
    }


def publish(
    spark: SparkSession,
    root: str,
    workflow_run: str,
    stage: str,
    properties: Mapping[str, str],
    logged_at: dt.datetime | None = None,
) -> None:
    """Append the properties; the newest entry of a key counts."""
    moment = logged_at or dt.datetime.now(dt.timezone.utc)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    rows = [(workflow_run, stage, key, value, moment) for key, value in properties.items()]
    frame = spark.createDataFrame(rows, LEDGER_SCHEMA)
    frame.coalesce(1).write.mode("append").partitionBy("workflow_run").parquet(root)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    if not storage.exists(spark, root):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(root)


def latest_properties(ledger: DataFrame) -> DataFrame:
    """Newest value per workflow run and key; equal times go to the larger value."""
    order = F.struct("logged_at", "value")
    return ledger.groupBy("workflow_run", "key").agg(F.max_by("value", order).alias("value"))


def run_properties(ledger: DataFrame, workflow_run: str, keys: Sequence[str]) -> dict[str, str]:
    """The asked-for properties of one run; at most ``len(keys)`` rows are collected."""
    chosen = ledger.filter(
        (F.col("workflow_run") == workflow_run) & F.col("key").isin(list(keys))
    )
    return {row["key"]: row["value"] for row in latest_properties(chosen).collect()}


def resolve(
    ledger: DataFrame | None,
    workflow_run: str | None,
    keys: Sequence[str],
    given: Mapping[str, str | None] | None = None,
) -> dict[str, str]:
    """Stage inputs: explicit parameters win; else the ledger must hold all of them."""
    given = {key: value for key, value in (given or {}).items() if value}
    if given:
        if set(given) != set(keys):
            raise InputError(f"Give all of {', '.join(keys)} or none.")
        return given
    if ledger is None or not workflow_run:
        raise InputError(f"No input: give {', '.join(keys)} or a workflow run.")
    found = run_properties(ledger, workflow_run, keys)
    if any(not found.get(key) for key in keys):
        raise InputError(f"The workflow run must contain {', '.join(keys)}.")
    return found


def lineage_mismatches(ledger: DataFrame, left: str, right: str) -> DataFrame:
    """Workflow runs whose two run-id properties are both there but differ."""
    latest = latest_properties(ledger.filter(F.col("key").isin(left, right)))
    pairs = latest.groupBy("workflow_run").agg(
        F.max(F.when(F.col("key") == left, F.col("value"))).alias("left_run"),
        F.max(F.when(F.col("key") == right, F.col("value"))).alias("right_run"),
    )
    return pairs.filter(F.col("left_run") != F.col("right_run"))


def resolve_fact_run(
    ledger: DataFrame | None,
    workflow_run: str | None,
    given: Mapping[str, str | None] | None = None,
    data_through: str | None = None,
) -> dict[str, str | None]:
    """Inputs of the curated rebuild; the fact table must come from the same run."""
    manual = {key: value for key, value in (given or {}).items() if value}
    if manual:
        return {**resolve(None, None, (RUN_ID, FACT_URI), manual), END_DATE: data_through}
    found = resolve(ledger, workflow_run, (RUN_ID, FACT_URI, FACT_RUN_ID))
    if found[FACT_RUN_ID] != found[RUN_ID]:
        raise GateError(
            f"The fact table is of run {found[FACT_RUN_ID]!r}, not of {found[RUN_ID]!r}."
        )
    end = run_properties(ledger, workflow_run, (END_DATE,)).get(END_DATE)
    return {**found, END_DATE: end}
