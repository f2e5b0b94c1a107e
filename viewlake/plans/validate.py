"""Validation run: check every landed line once, route it, and report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewlake.functions import contract as C
from viewlake.functions.rules import check_lines
from viewlake.operators.lines import a_task_a_block, dealt_out, number_lines, require_a_task_a_block, small_shares
from viewlake.session import new_folder
from viewlake.sources import storage
from viewlake.sources.landing import landing_lines, read_manifest, utc_text
from viewlake.sources.reports import write_report

LAYERS = ("raw", "quarantine", "drift")
#: Quarantined lines before they have their line number: address and text between tabs.
HELD = "held"
_HELD_FIELDS = ("source_uri", "block_start", "block_row", "task")


@dataclass(frozen=True)
class ValidationRun:
    """Where a run writes and what it stamps on its output."""

    root: str
    run_id: str
    partition: str
    validated_at: dt.datetime

    @property
    def base(self) -> str:
        return f"{self.root}/{self.partition}"

    def layer(self, name: str) -> str:
        return f"{self.base}/layer={name}"


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"[\r\n]+$", "")


def held_line() -> Column:
    """The first half of a quarantine row as JSON text behind the line's address; the record is as it was written.

    Serialising a parsed record again would change numbers such as ``1.0``.
    """
    head = F.to_json(F.struct(F.lit(C.CONTRACT_VERSION).alias("contract_version"), F.col("issues").alias("errors")))
    original = F.to_json(F.struct(F.make_valid_utf8(_trimmed(F.col("value"))).alias("original_line")))
    record = F.when(
        F.get(F.col("issues")["code"], F.lit(0)) == C.MALFORMED,
        F.substring(original, F.lit(2), F.length(original) - 2),
    ).otherwise(F.concat(F.lit('"event":'), _trimmed(F.col("value"))))
    opening = F.substring(head, F.lit(1), F.length(head) - 1)
    address = [F.col(name).cast("string") for name in _HELD_FIELDS]
    return F.concat_ws("\t", *address, F.concat_ws(",", opening, record))


def quarantine_lines(held: DataFrame, run: ValidationRun) -> DataFrame:
    """Whole quarantine rows from numbered ``(source_uri, line_number, text)``."""
    tail = F.to_json(
        F.struct(
            F.lit(run.run_id).alias("ingestion_run_id"),
            F.col("line_number").alias("source_line_number"),
            F.col("source_uri").alias("source_s3_uri"),
            F.lit(utc_text(run.validated_at)).alias("validated_at"),
        )
    )
    return held.select(F.concat_ws(",", "text", F.substring(tail, F.lit(2), F.length(tail))).alias("line"))


def routed_lines(checked: DataFrame) -> DataFrame:
    """``(layer, line)``: each record is raw or held for quarantine, each unknown path goes to drift."""
    main = F.when(
        # behind a valid record is white space alone, so line breaks are taken off without a pattern
        F.col("is_valid"), F.struct(F.lit("raw").alias("layer"), F.rtrim("value", F.lit("\r\n")).alias("line"))
    ).otherwise(
        F.struct(F.lit(HELD).alias("layer"), held_line().alias("line"))
    )
    drift = F.transform(
        "unknown_fields",
        lambda path: F.struct(
            F.lit("drift").alias("layer"), F.to_json(F.struct(path.alias("path"))).alias("line")
        ),
    )
    lines = F.when(F.size("unknown_fields") == 0, F.array(main)).otherwise(F.concat(F.array(main), drift))
    return checked.select(F.inline(lines))


def count_columns() -> list[Column]:
    """Run counts over checked lines."""
    codes = F.col("issues")["code"]
    return [
        F.count("*").alias("total"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("quarantined"),
        F.count_if(F.array_contains(codes, C.MALFORMED)).alias("malformed"),
    ]


def code_counts() -> list[Column]:
    """Issues per code; several issues of one record count one by one."""
    codes = F.col("issues")["code"]
    return [
        F.sum(F.size(F.filter(codes, _equals(code)))).alias(code)
        for code in C.CODES
    ]


def _equals(code: str):
    return lambda item: item == code


def error_counts(checked: DataFrame) -> DataFrame:
    issues = checked.select(F.explode(F.col("issues")["code"]).alias("code"))
    return issues.groupBy("code").agg(F.count("*").alias("issue_count"))


def unknown_field_counts(checked: DataFrame) -> DataFrame:
    paths = checked.select(F.explode("unknown_fields").alias("path"))
    return paths.groupBy("path").agg(F.count("*").alias("record_count"))


def addressed_and_checked(lines: DataFrame, deal: bool = False) -> DataFrame:
    """Verdicts for lines with their address (see ``landing_lines``).

    A line costs far more to check than to read, and a compressed file cannot be split. ``deal`` deals the lines out
    before they are checked, in shares that adaptive execution sizes (see ``small_shares``).
    """
    addressed = lines.withColumn("task", F.spark_partition_id())
    return check_lines(dealt_out(addressed) if deal else addressed)


def write_layers(checked: DataFrame, run: ValidationRun) -> dict:
    """Write all layers and return the run counts and the ``sources`` that had lines.

    One pass writes raw lines and drift, and holds the quarantined lines with their address. Only those are numbered
    then (see ``number_lines``) and written into the quarantine layer. The counts are observed in the
    stage that writes, which counts every partition once even if its task ran several times. The run folder is
    replaced as a whole, so a repeated run leaves no trace of an earlier attempt.
    """
    spark = checked.sparkSession
    counts = Observation()
    # the files of a run are named in its report, so their list is as bounded as that
    sources = F.array_sort(F.collect_set("source_uri")).alias("sources")
    observed = checked.observe(counts, *count_columns(), *code_counts(), sources)
    with a_task_a_block(spark), small_shares(spark):
        (
            routed_lines(observed)
            .write.mode("overwrite")
            .partitionBy("layer")
            .option("compression", "gzip")
            .text(run.base)
        )
    found = dict(counts.get)
    seen = found.pop("sources", None) or []
    totals = {name: value or 0 for name, value in found.items()}
    # Raw has a file even without valid records; quarantine is there only if something failed.
    if not totals.get("valid"):
        storage.make_file(spark, f"{run.layer('raw')}/part-none.txt")
    if totals.get("quarantined"):
        _write_quarantine(spark, run)
    return {**totals, "sources": list(seen)}


def _write_quarantine(spark: SparkSession, run: ValidationRun) -> None:
    """Number the held lines and write them as quarantine rows."""
    parts = F.split("value", "\t", len(_HELD_FIELDS) + 1)
    rows = spark.read.option("lineSep", "\n").text(run.layer(HELD)).select(parts.alias("part"))
    names = dict(zip((*_HELD_FIELDS, "text"), ("string", "bigint", "bigint", "int", "string"), strict=True))
    held = rows.select(*[F.col("part")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(names.items())])
    require_a_task_a_block(held)
    blocks = new_folder(spark, "blocks")
    numbered = number_lines(held.drop("task"), blocks)
    quarantine_lines(numbered, run).write.mode("overwrite").option("compression", "gzip").text(run.layer("quarantine"))
    storage.remove_folder(spark, run.layer(HELD))
    storage.remove_folder(spark, blocks)


def drift_table(spark: SparkSession, run: ValidationRun) -> tuple[DataFrame, str]:
    """Records per unknown path, written next to the report, also if there are none.

    Paths come from the data, so their number has no bound: they never pass through the driver.
    """
    path = f"{run.root}_drift/{run.partition}"
    storage.make_folder(spark, run.layer("drift"))
    found = spark.read.schema("path string").json(run.layer("drift"))
    counts = found.groupBy("path").agg(F.count("*").alias("record_count"))
    counts.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def run_validation(
    spark: SparkSession,
    manifest_uri: str,
    root: str,
    validated_at: dt.datetime,
    job_name: str = "validate",
) -> dict:
    """Validate everything a manifest names; return the report, which is also written."""
    manifest = read_manifest(spark, manifest_uri)
    partition = f"extraction_date={manifest.extraction_date}/run_id={manifest.run_id}"
    run = ValidationRun(root, manifest.run_id, partition, validated_at)
    counts = write_layers(addressed_and_checked(landing_lines(spark, manifest.sources), deal=True), run)
    return finish_report(spark, run, counts, manifest_uri, manifest.sources, job_name)


def finish_report(
    spark: SparkSession,
    run: ValidationRun,
    counts: dict,
    manifest_uri: str,
    sources: list[str],
    job_name: str,
) -> dict:
    drift, drift_uri = drift_table(spark, run)
    report_uri = f"{run.root}_reports/{run.partition}"
    report = {
        "additive_drift_detected": not drift.isEmpty(),
        "contract_version": C.CONTRACT_VERSION,
        "error_counts": {code: counts[code] for code in sorted(C.CODES) if counts[code]},
        "ingestion_manifest_uri": manifest_uri,
        "ingestion_run_id": run.run_id,
        "input_s3_uris": list(sources),
        "job_name": job_name,
        "malformed_record_count": counts["malformed"],
        "quarantine_s3_uri": run.layer("quarantine") if counts["quarantined"] else None,
        "quarantined_record_count": counts["quarantined"],
        "raw_s3_uri": run.layer("raw"),
        "report_s3_uri": report_uri,
        "total_record_count": counts["total"],
        "unknown_field_counts_uri": drift_uri,
        "valid_record_count": counts["valid"],
        "validated_at": utc_text(run.validated_at),
    }
    write_report(spark, report, report_uri)
    return report
