import datetime as dt
import json

import pytest
from samples import line

from viewlake.errors import GateError, InputError
from viewlake.functions import contract as C
from viewlake.functions import rules
from viewlake.operators.lines import require_a_task_a_block
from viewlake.plans.refine import fact_media_engagement, staged_events
from viewlake.plans.runs import Layout, validate
from viewlake.plans.validate import addressed_and_checked, routed_lines
from viewlake.sources import storage
from viewlake.sources.landing import Extraction, landing_lines, read_manifest, write_landing, write_manifest
from viewlake.sources.reports import read_report

NOW = dt.datetime(2026, 6, 6, 2)
DAY = dt.date(2026, 6, 5)


def run(spark, folder, lines, run_id="r1"):
    layout = Layout(folder)
    extraction = Extraction(run_id, dt.datetime(2026, 6, 6, 1), DAY, DAY)
    rows = spark.createDataFrame([("m1", text) for text in lines], "media_id string, value string")
    results = write_landing(rows.coalesce(1), layout.landing, ["m1"], extraction)
    manifest = write_manifest(results, layout.manifests, extraction)
    return validate(spark, layout, NOW, manifest_uri=manifest)


def texts(spark, uri):
    return [row["value"] for row in spark.read.option("lineSep", "\n").text(uri).collect()]


def test_routing_and_report(spark, folder):
    odd = line(event_key="e2", new_field={"a": 1}).replace("0.5", "0.50")
    broken = line(country=None).replace("0.5", "0.500")
    report = run(spark, folder, [line(), odd + "\r", broken, "{malformed \\ \"x"])
    assert (report["total_record_count"], report["valid_record_count"]) == (4, 2)
    assert (report["quarantined_record_count"], report["malformed_record_count"]) == (2, 1)
    assert report["error_counts"] == {"malformed_json": 1, "null_required_field": 1}
    drift = spark.read.parquet(report["unknown_field_counts_uri"]).collect()
    assert [tuple(r) for r in drift] == [("new_field", 1)] and report["additive_drift_detected"]
    assert report["additive_drift_detected"]
    # Raw lines are the original text, without the line end.
    assert sorted(texts(spark, report["raw_s3_uri"])) == sorted([line(), odd])
    held = texts(spark, report["quarantine_s3_uri"])
    rows = {json.loads(text)["source_line_number"]: json.loads(text) for text in held}
    assert set(rows) == {3, 4}
    assert any('"percent_viewed": 0.500' in text for text in held)
    assert rows[3]["event"]["country"] is None and "original_line" not in rows[3]
    assert rows[4]["original_line"] == "{malformed \\ \"x" and "event" not in rows[4]
    assert rows[3]["errors"] == [
        {"code": "null_required_field", "field": "country",
         "message": "Required field cannot be null."}
    ]
    assert list(rows[3]) == [
        "contract_version", "errors", "event", "ingestion_run_id", "source_line_number",
        "source_s3_uri", "validated_at",
    ]
    assert rows[3]["validated_at"] == "2026-06-06T02:00:00Z"
    stored = read_report(spark, report["report_s3_uri"]).collect()[0]
    assert stored["error_counts"] == report["error_counts"]
    assert stored["input_s3_uris"] == report["input_s3_uris"]


def test_the_raw_layer_needs_no_exchange_and_numbers_are_true(spark, folder, settings):
    """Text in many blocks of several files; the number in a quarantined line is its place in its file."""
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    settings("spark.sql.files.maxPartitionBytes", "16k")
    layout = Layout(folder)
    extraction = Extraction("r1", dt.datetime(2026, 6, 6, 1), DAY, DAY)
    written = [line(event_key=f"k{i}") if i % 7 else f"broken {i}" + "x" * (i % 50) for i in range(2000)]
    rows = spark.createDataFrame([("m1", i, t) for i, t in enumerate(written)], "media_id string, i int, value string")
    results = write_landing(rows, layout.landing, ["m1"], extraction, order=["i"], compression="none")
    manifest = write_manifest(results, layout.manifests, extraction)
    lines = landing_lines(spark, read_manifest(spark, manifest).sources)
    assert "Exchange" not in routed_lines(addressed_and_checked(lines))._jdf.queryExecution().executedPlan().toString()
    report = validate(spark, layout, NOW, manifest_uri=manifest)
    held = [json.loads(t) for t in texts(spark, report["quarantine_s3_uri"])]
    assert len(held) == report["quarantined_record_count"] == 286
    files = {r["source_s3_uri"] for r in held}
    assert len(files) > 1 and max(r["source_line_number"] for r in held) > 200
    landed = {f: texts(spark, f) for f in files}
    assert all(landed[r["source_s3_uri"]][r["source_line_number"] - 1] == r["original_line"] for r in held)
    assert not storage.exists(spark, report["raw_s3_uri"].replace("layer=raw", "layer=held"))


def test_lines_of_one_compressed_file_are_checked_in_many_tasks(spark, folder, settings):
    """The file is read by one task, as it cannot be split; the lines are dealt out and keep their numbers."""
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    landed = [line(event_key=f"k{i}") if i % 5 else f"broken {i}" for i in range(4000)]
    report = run(spark, folder, landed)
    assert len(storage.matching(spark, f"{report['raw_s3_uri']}/part-*")) > 1
    assert sorted(texts(spark, report["raw_s3_uri"])) == sorted(t for t in landed if t.startswith("{"))
    held = [json.loads(t) for t in texts(spark, report["quarantine_s3_uri"])]
    assert len(held) == 800 and all(landed[r["source_line_number"] - 1] == r["original_line"] for r in held)
    assert len({r["source_s3_uri"] for r in held}) == 1


def test_a_record_without_an_integer_field_is_not_searched_for_it(spark):
    (width,) = [f for f in C.FIELDS if f.path == "thumbnail.width"]
    tag = rules._type_tag(width, "cast(raise_error('searched') as string)")
    rows = spark.range(1).selectExpr("if(id < 0, named_struct('width', parse_json('1')), null) as in_thumbnail")
    assert rows.selectExpr(tag).first()[0] is None


def test_several_blocks_a_task_are_not_numbered(spark):
    rows = spark.createDataFrame([("f", 0, 0), ("f", 9, 0)], "source_uri string, block_start int, task int")
    with pytest.raises(InputError, match="several blocks"):
        require_a_task_a_block(rows)


def test_a_required_field_that_no_record_has_stops_the_load(spark, folder):
    spark.createDataFrame([(line(country=...),), (line(country=None),)], "value string").write.text(f"{folder}/raw")
    with pytest.raises(GateError, match="country"):
        staged_events(spark, f"{folder}/raw", f"{folder}/events")


def test_valid_times_have_a_date(spark, folder):
    stamps = ["2026-06-05X12:30:00", "2026-06-05T12:30:00,5", "20260605T123000", "2026-W23-5", "2026-06-05T23:30-01:00"]
    report = run(spark, folder, [line(event_key=f"e{i}", received_at=s) for i, s in enumerate(stamps)])
    assert report["valid_record_count"] == len(stamps)
    events = staged_events(spark, report["raw_s3_uri"], f"{folder}/events")
    dates = [str(r["date"]) for r in fact_media_engagement(events).orderBy("event_id").collect()]
    assert dates == ["2026-06-05"] * 4 + ["2026-06-06"]


def test_no_quarantine_without_failures_even_after_a_bad_attempt(spark, folder):
    first = run(spark, folder, ["nonsense", line(new_field=1)])
    assert storage.exists(spark, first["quarantine_s3_uri"])
    report = run(spark, folder, [line()])
    assert report["quarantine_s3_uri"] is None
    assert not storage.exists(spark, first["quarantine_s3_uri"])
    assert spark.read.parquet(report["unknown_field_counts_uri"]).isEmpty() and not report["additive_drift_detected"]


def test_empty_input_still_writes_raw_and_report(spark, folder):
    report = run(spark, folder, [])
    assert report["total_record_count"] == 0 and report["error_counts"] == {}
    assert texts(spark, report["raw_s3_uri"]) == []


def test_every_issue_counts(spark, folder):
    report = run(spark, folder, [line(ip=..., country=...)] * 3)
    assert report["error_counts"] == {"missing_required_field": 6}
    assert report["quarantined_record_count"] == 3


def test_any_number_of_drift_paths_is_counted(spark, folder):
    report = run(spark, folder, [line(**{f"extra_{i}": 1 for i in range(10_001)}), line(extra_0=2)])
    counts = spark.read.parquet(report["unknown_field_counts_uri"])
    assert counts.count() == 10_001
    assert counts.filter("path = 'extra_0'").first()["record_count"] == 2
