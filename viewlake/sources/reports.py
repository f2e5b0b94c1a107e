"""Validation reports: write, read, and the gates of the stages that follow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.errors import GateError
from viewlake.sources.landing import read_json_object, text_member

REPORT_SCHEMA = """
    additive_drift_detected boolean, contract_version string,
    error_counts map<string,bigint>, ingestion_manifest_uri string,
    ingestion_run_id string, input_s3_uris array<string>, job_name string,
    malformed_record_count bigint, quarantine_s3_uri string,
    quarantined_record_count bigint, raw_s3_uri string, report_s3_uri string,
    total_record_count bigint, unknown_field_counts_uri string,
    valid_record_count bigint, validated_at string
"""
REPORT_MEMBERS = "ingestion_run_id variant, raw_s3_uri variant, valid_record_count variant"
REPORT_FIELDS = [part.split()[0] for part in REPORT_SCHEMA.replace("\n", " ").split(", ")]


def write_report(spark: SparkSession, report: dict, path: str) -> DataFrame:
    row = tuple(report[name] for name in REPORT_FIELDS)
    frame = spark.createDataFrame([row], REPORT_SCHEMA)
    frame.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return frame


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).json(path)


@dataclass(frozen=True)
class ValidatedInput:
    raw_uri: str
    valid_records: int


def report_values(doc: DataFrame, *keep: str) -> DataFrame:
    """Lineage and count of report documents (``REPORT_MEMBERS``), NULL where the JSON type is wrong."""
    value = F.col("doc.valid_record_count")
    count = F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))
    return doc.select(
        *keep,
        text_member("doc.ingestion_run_id").alias("run_id"),
        text_member("doc.raw_s3_uri").alias("raw_uri"),
        F.when(count >= 0, count).alias("valid_records"),
    )


def validated_input(spark: SparkSession, report_uri: str, run_id: str) -> ValidatedInput:
    """Raw folder and record count of the report, if it belongs to ``run_id``."""
    row = report_values(read_json_object(spark, report_uri, REPORT_MEMBERS)).collect()[0]
    if row["run_id"] != run_id:
        raise GateError(f"The report is of run {row['run_id']!r}, not of {run_id!r}.")
    if row["raw_uri"] is None:
        raise GateError("The validation report has no raw_s3_uri.")
    if row["valid_records"] is None:
        raise GateError("The validation report has an invalid valid_record_count.")
    return ValidatedInput(row["raw_uri"], row["valid_records"])
