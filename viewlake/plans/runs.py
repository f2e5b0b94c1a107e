"""Whole runs: land a window, validate, refine, curate; each stage publishes last.

A stage writes its tables first and its ledger entry afterwards, and every write
replaces or upserts by key. So a run that broke off is simply run again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.plans.curate import visitor_engagement, with_audit
from viewlake.plans.refine import REFINED, RefinedTable, build_table, staged_events
from viewlake.plans.validate import run_validation
from viewlake.session import new_folder
from viewlake.sources import ledger as L
from viewlake.sources import storage
from viewlake.sources.landing import (
    Extraction,
    extract_window,
    iso_date,
    write_landing,
    write_manifest,
)
from viewlake.sources.reports import validated_input
from viewlake.sources.tables import overwrite_table, read_table, upsert_table


@dataclass(frozen=True)
class Layout:
    """Folders below one root."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def manifests(self) -> str:
        return f"{self.root}/manifests"

    @property
    def validated(self) -> str:
        return f"{self.root}/validated"

    @property
    def ledger(self) -> str:
        return f"{self.root}/run_ledger"

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"


def event_lines(events: DataFrame) -> DataFrame:
    """``(media_id, value)``: one JSON line per wire event, times in UTC to the microsecond."""
    stamp = F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    wire = events.withColumn("received_at", stamp) if "received_at" in events.columns else events
    line = F.to_json(F.struct(*wire.columns), {"ignoreNullFields": "false"})
    return wire.select("media_id", line.alias("value"))


def land(
    spark: SparkSession,
    layout: Layout,
    events: DataFrame,
    media_ids: Sequence[str],
    extraction: Extraction,
    workflow_run: str | None = None,
) -> str:
    """Write the window's events and the manifest; return the manifest's uri."""
    chosen = extract_window(events, media_ids, extraction.start, extraction.end)
    results = write_landing(event_lines(chosen), layout.landing, media_ids, extraction)
    manifest_uri = write_manifest(results, layout.manifests, extraction)
    _publish(
        spark, layout, workflow_run, "land",
        {
            L.MANIFEST_URI: manifest_uri,
            L.RUN_ID: extraction.run_id,
            L.START_DATE: extraction.start.isoformat(),
            L.END_DATE: extraction.end.isoformat(),
        },
    )
    return manifest_uri


def validate(
    spark: SparkSession,
    layout: Layout,
    validated_at: dt.datetime,
    workflow_run: str | None = None,
    manifest_uri: str | None = None,
) -> dict:
    """Validate the given manifest, or the one the workflow run published."""
    book = L.read_ledger(spark, layout.ledger)
    found = L.resolve(book, workflow_run, (L.MANIFEST_URI,), {L.MANIFEST_URI: manifest_uri})
    report = run_validation(spark, found[L.MANIFEST_URI], layout.validated, validated_at)
    _publish(spark, layout, workflow_run, "validate", report_properties(report))
    return report


def report_properties(report: Mapping) -> dict[str, str]:
    """What the validation stage hands over."""
    return {
        L.REPORT_URI: report["report_s3_uri"],
        L.TOTAL_COUNT: str(report["total_record_count"]),
        L.VALID_COUNT: str(report["valid_record_count"]),
        L.QUARANTINE_COUNT: str(report["quarantined_record_count"]),
        L.MALFORMED_COUNT: str(report["malformed_record_count"]),
    }


def refine(
    spark: SparkSession,
    layout: Layout,
    workflow_run: str | None = None,
    given: Mapping[str, str | None] | None = None,
    tables: Sequence[RefinedTable] = REFINED,
) -> dict[str, int]:
    """Upsert the validated events into the refined tables; return their row counts."""
    book = L.read_ledger(spark, layout.ledger)
    found = L.resolve(book, workflow_run, (L.RUN_ID, L.REPORT_URI), given)
    source = validated_input(spark, found[L.REPORT_URI], found[L.RUN_ID])
    counts = dict.fromkeys((t.name for t in tables), 0)
    if source.valid_records:
        counts = refine_raw(spark, layout, source.raw_uri, tables)
    publish_counts(spark, layout, workflow_run, counts, found[L.RUN_ID])
    return counts


def publish_counts(
    spark: SparkSession, layout: Layout, workflow_run: str | None, counts: Mapping[str, int], run_id: str
) -> None:
    for name, rows in counts.items():
        properties = L.table_properties(name, layout.table(name), rows, run_id)
        _publish(spark, layout, workflow_run, name, properties)


def refine_raw(
    spark: SparkSession, layout: Layout, raw_uri: str, tables: Sequence[RefinedTable] = REFINED
) -> dict[str, int]:
    """Load raw lines into the tables by way of a staged copy, which is removed again."""
    path = new_folder(spark, "events")
    try:
        events = staged_events(spark, raw_uri, path)
        # All gates come first: a bad batch must not reach one table and miss another.
        built = [(table, build_table(events, table)) for table in tables]
        return {table.name: load_table(rows, layout, table) for table, rows in built}
    finally:
        storage.remove_folder(spark, path)


def load_table(rows: DataFrame, layout: Layout, table: RefinedTable) -> int:
    """Upsert rows that a table's ``build`` has made, which have each key once."""
    return upsert_table(rows, layout.table(table.name), table.keys, unique=True)


def curate(
    spark: SparkSession,
    layout: Layout,
    refreshed_at: dt.datetime,
    workflow_run: str | None = None,
    given: Mapping[str, str | None] | None = None,
    data_through: str | None = None,
) -> int:
    """Rebuild the curated table from all facts of the run's fact table."""
    book = L.read_ledger(spark, layout.ledger)
    found = L.resolve_fact_run(book, workflow_run, given, data_through)
    through = iso_date("data_through", found[L.END_DATE]) if found[L.END_DATE] else None
    fact, _ = read_table(spark, found[L.FACT_URI])
    rows = with_audit(visitor_engagement(fact), through, refreshed_at, found[L.RUN_ID])
    root = layout.table("visitor_engagement")
    count = overwrite_table(rows, root)
    properties = L.table_properties("visitor_engagement", root, count, found[L.RUN_ID])
    _publish(spark, layout, workflow_run, "visitor_engagement", properties)
    return count


def run_once(
    spark: SparkSession,
    layout: Layout,
    events: DataFrame,
    media_ids: Sequence[str],
    extraction: Extraction,
    workflow_run: str,
    now: dt.datetime,
) -> int:
    """One incremental run over the extraction window; repeating it changes nothing."""
    land(spark, layout, events, media_ids, extraction, workflow_run)
    validate(spark, layout, now, workflow_run)
    refine(spark, layout, workflow_run)
    return curate(spark, layout, now, workflow_run)


def _publish(
    spark: SparkSession,
    layout: Layout,
    workflow_run: str | None,
    stage: str,
    properties: Mapping[str, str],
) -> None:
    if workflow_run:
        L.publish(spark, layout.ledger, workflow_run, stage, properties)
