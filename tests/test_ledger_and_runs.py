import datetime as dt
import json

import pytest

from viewlake.errors import GateError, InputError
from viewlake.plans import runs
from viewlake.plans.refine import DIM_MEDIA, FACT
from viewlake.plans.runs import Layout
from viewlake.sources import ledger as L
from viewlake.sources.landing import Extraction
from viewlake.sources import storage
from viewlake.sources.reports import read_report, validated_input
from viewlake.sources.tables import read_table
from viewlake.streaming.incremental import start_incremental

NOW = dt.datetime(2026, 6, 6, 2)
DAY = dt.date(2026, 6, 5)
FACT_KEYS = (L.RUN_ID, L.FACT_URI, L.FACT_RUN_ID)


def wire(spark, rows=40, share="(id % 10) / 10.0D", day="2026-06-05"):
    return spark.range(rows).selectExpr(
        "concat('e', id) event_key",
        f"timestamp_ntz'{day} 00:00:00' + make_interval(0, 0, 0, 0, 0, id) received_at",
        "concat('v', id % 7) visitor_key", "concat('m', id % 3) media_id",
        "concat('Film ', id % 3, ' Youtube') media_name", "'u' media_url",
        f"{share} percent_viewed", "'1.1.1.1' ip", "'Peru' country",
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ledger_resolution(spark, folder):
    L.publish(spark, folder, "w1", "land", {L.RUN_ID: "old", L.END_DATE: "2026-06-05"}, NOW)
    later = NOW + dt.timedelta(minutes=1)
    L.publish(spark, folder, "w1", "land", {L.RUN_ID: "r1"}, later)
    L.publish(spark, folder, "w2", "land", {L.RUN_ID: "r2"}, later)
    book = L.read_ledger(spark, folder)
    assert L.resolve(book, "w1", (L.RUN_ID,)) == {L.RUN_ID: "r1"}
    assert L.resolve(book, "w1", (L.RUN_ID,), {L.RUN_ID: "mine"}) == {L.RUN_ID: "mine"}
    pair = (L.RUN_ID, L.REPORT_URI)
    with pytest.raises(InputError):
        L.resolve(book, "w1", pair, {L.RUN_ID: "mine"})
    with pytest.raises(InputError):
        L.resolve(book, "w1", pair)
    with pytest.raises(InputError):
        L.resolve(book, None, pair)

    L.publish(spark, folder, "w1", "fact", {L.FACT_URI: "f", L.FACT_RUN_ID: "old"}, later)
    with pytest.raises(GateError):
        L.resolve_fact_run(L.read_ledger(spark, folder), "w1")
    L.publish(spark, folder, "w1", "fact", {L.FACT_RUN_ID: "r1"}, later + dt.timedelta(minutes=1))
    found = L.resolve_fact_run(L.read_ledger(spark, folder), "w1")
    assert (found[L.FACT_URI], found[L.END_DATE]) == ("f", "2026-06-05")
    with pytest.raises(InputError):
        L.resolve_fact_run(None, None, {L.RUN_ID: "r1"})


@pytest.mark.parametrize(
    "changes, error",
    [
        ({}, None),
        ({"valid_record_count": 0}, None),
        ({"ingestion_run_id": "r2"}, GateError),
        ({"raw_s3_uri": 5}, GateError),
        ({"valid_record_count": "2"}, GateError),
        ({"valid_record_count": True}, GateError),
        ({"valid_record_count": -1}, GateError),
        ({"valid_record_count": 2.5}, GateError),
    ],
)
def test_report_gates(spark, folder, changes, error):
    doc = {"ingestion_run_id": "r1", "raw_s3_uri": "raw", "valid_record_count": 2, **changes}
    spark.createDataFrame([(json.dumps(doc),)], "value string").write.text(folder)
    if error:
        with pytest.raises(error):
            validated_input(spark, folder, "r1")
    else:
        assert validated_input(spark, folder, "r1").valid_records == doc["valid_record_count"]


def test_runs_replay_correct_and_skip(spark, folder):
    layout = Layout(folder)
    media = ["m0", "m1", "m2"]

    def load(events, run_id, day=DAY):
        extraction = Extraction(run_id, NOW, day, day)
        runs.run_once(spark, layout, events, media, extraction, f"wf-{run_id}", NOW)
        fact, _ = read_table(spark, layout.table("fact_media_engagement"))
        curated, _ = read_table(spark, layout.table("visitor_engagement"))
        return rows(fact), rows(curated.drop("ingestion_run_id", "data_through_date"))

    first = load(wire(spark), "r1")
    assert len(first[0]) == 40 and sum(r[2] for r in first[1]) == 40
    assert load(wire(spark), "r1") == first

    corrected = load(wire(spark, share="0.25D"), "r2")
    assert {r[4] for r in corrected[0]} == {0.25}
    assert {r[3] for r in corrected[1]} == {0.25}

    # Nothing valid in the window: refined tables stay, the curated one is rebuilt.
    before = read_table(spark, layout.table("dim_media"))[1]
    nothing = load(wire(spark, share="7.0D"), "r3")
    assert nothing == corrected
    assert read_table(spark, layout.table("dim_media"))[1] == before
    book = L.read_ledger(spark, layout.ledger)
    found = L.run_properties(book, "wf-r3", ("DIM_MEDIA_ROW_COUNT", L.QUARANTINE_COUNT))
    assert found == {"DIM_MEDIA_ROW_COUNT": "0", L.QUARANTINE_COUNT: "40"}


def test_stream_loads_new_files_once(spark, folder):
    layout = Layout(folder)
    fact_root = layout.table("fact_media_engagement")

    def land(events, run_id, day):
        runs.land(spark, layout, events, ["m0", "m1", "m2"], Extraction(run_id, NOW, day, day))

    def stream():
        start_incremental(spark, layout, f"{folder}/cp", files_per_batch=2).awaitTermination()
        return rows(read_table(spark, fact_root)[0])

    land(wire(spark), "r1", DAY)
    batch = rows(FACT.build(wire(spark)))
    assert stream() == batch
    version = read_table(spark, fact_root)[1]
    assert version > 0  # several micro-batches
    assert stream() == batch
    assert read_table(spark, fact_root)[1] == version
    book = L.read_ledger(spark, layout.ledger)
    batches = [r[0] for r in book.select("workflow_run").distinct().collect()]
    assert len(batches) == version + 1
    reports = [L.run_properties(book, b, (L.REPORT_URI, L.VALID_COUNT)) for b in batches]
    assert sum(int(r[L.VALID_COUNT]) for r in reports) == 40
    files = [f for r in reports for f in read_report(spark, r[L.REPORT_URI]).first()["input_s3_uris"]]
    assert len(files) == len(set(files)) == 3

    # another checkpoint loads everything anew and overwrites nothing of the first query's
    before = storage.matching(spark, f"{layout.validated}/stream=*/*/layer=raw/part-*")
    start_incremental(spark, layout, f"{folder}/cp2").awaitTermination()
    after = storage.matching(spark, f"{layout.validated}/stream=*/*/layer=raw/part-*")
    assert set(before) < set(after) and rows(read_table(spark, fact_root)[0]) == batch
    late = DAY + dt.timedelta(days=1)
    land(wire(spark, 50, share="0.5D", day="2026-06-06"), "r2", late)
    found = stream()
    assert len(found) == 50 and {r[4] for r in found} == {0.5}
