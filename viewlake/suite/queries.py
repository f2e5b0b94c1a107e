"""One query per operator, over the driver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewlake.functions import contract as C
from viewlake.functions.media import channel_from_title
from viewlake.functions.rules import check_lines
from viewlake.operators import gates
from viewlake.operators.filters import by_date_overlap, by_membership
from viewlake.operators.latest import latest_per_key
from viewlake.operators.lines import a_task_a_block, number_lines
from viewlake.operators.upsert import repeated_keys, upsert
from viewlake.plans import refine, runs, serve
from viewlake.plans import validate as checks
from viewlake.plans.curate import visitor_engagement, with_audit
from viewlake.plans.dashboard import load_dashboard
from viewlake.plans.runs import Layout
from viewlake.session import configure, new_folder, stage
from viewlake.sources import ledger as L
from viewlake.sources.landing import (
    MANIFEST_MEMBERS,
    Extraction,
    extract_window,
    json_documents,
    landing_lines,
    manifest_sources,
    raw_events,
    read_manifest,
    read_request,
    write_landing,
    write_manifest,
)
from viewlake.sources.reports import REPORT_MEMBERS, read_report, report_values
from viewlake.sources.tables import overwrite_table, read_table, upsert_table
from viewlake.streaming.incremental import start_incremental
from viewlake.suite import binding as B

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Parameters of the queries: the window and media of the extract, the dashboard's
# choices, and the stamps of one run.
WANTED_TEXT = '["m3", " m0", "m3", "", "m7"]'
RUN_DAY = dt.date(2024, 2, 1)
EXTRACTED_AT = dt.datetime(2024, 2, 1, 6, 30)
CHOSEN_MEDIA = ["m0", "m1", "m2"]
CHOSEN_CHANNELS = ["Youtube"]
CHOSEN_COUNTRIES = [f"NATION_{n}" for n in range(15)]
OVERLAP = (dt.date(2024, 1, 10), dt.date(2024, 1, 12))
RUN_ID = "run-0001"


def query(function: Query, name: str | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _QUERIES[name or function.__name__] = run
    return function


def named(name: str) -> Callable[[Query], Query]:
    return lambda function: query(function, name)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Averages depend on the order of addition in their last digits.

    Nine digits: shares have four, so averages of a few of them never end in a tie there.
    """
    return df.withColumns({c: F.round(c, 9) for c in columns})


def _layout(spark: SparkSession, name: str) -> Layout:
    return Layout(new_folder(spark, name))


def _extraction(start: dt.date, end: dt.date, run_id: str = RUN_ID) -> Extraction:
    return Extraction(run_id, EXTRACTED_AT, start, end)


def _land_events(spark: SparkSession, sf_dir: str, name: str) -> tuple[Layout, str]:
    """Land every event of the table's media and days; return the folders and the manifest."""
    layout = _layout(spark, name)
    scope = B.scope(spark, sf_dir)
    events = B.plain_events(spark, sf_dir)
    return layout, runs.land(spark, layout, events, scope.media_ids, _extraction(scope.first, scope.last))


def _land_faulty(
    spark: SparkSession, sf_dir: str, name: str, order: tuple[str, ...] = ()
) -> tuple[Layout, str]:
    layout = _layout(spark, name)
    scope = B.scope(spark, sf_dir)
    period = _extraction(scope.first, scope.last)
    lines = B.faulty_lines(spark, sf_dir)
    results = write_landing(lines, layout.landing, scope.media_ids, period, order=order)
    return layout, write_manifest(results, layout.manifests, period)


def _validate_faulty(spark: SparkSession, sf_dir: str, name: str) -> dict:
    layout, manifest = _land_faulty(spark, sf_dir, name)
    return runs.validate(spark, layout, EXTRACTED_AT, manifest_uri=manifest)


# ---- sources and sinks ----------------------------------------------------------------


@query
def scan_landing_lines(spark, sf_dir):
    _, manifest = _land_events(spark, sf_dir, "scan")
    lines = landing_lines(spark, read_manifest(spark, manifest).sources)
    media = F.regexp_extract("source_uri", "media_id=([^/]+)/", 1)
    return lines.select(
        media.alias("media_id"), F.get_json_object("value", "$.event_key").alias("event_key")
    )


@query
def line_lineage(spark, sf_dir):
    _, manifest = _land_events(spark, sf_dir, "lineage")
    lines = landing_lines(spark, read_manifest(spark, manifest).sources)
    with a_task_a_block(spark):
        addressed = stage(lines.drop("value"), new_folder(spark, "lineage"))
    numbered = number_lines(addressed, new_folder(spark, "blocks"))
    files = numbered.groupBy("source_uri").agg(
        F.count("*").alias("line_count"),
        F.count_distinct("line_number").alias("distinct_numbers"),
        F.min("line_number").alias("first_line"),
        F.max("line_number").alias("last_line"),
    )
    media = F.regexp_extract("source_uri", "media_id=([^/]+)/", 1).alias("media_id")
    return files.groupBy(media).agg(
        F.sum("line_count").alias("line_count"),
        F.sum("distinct_numbers").alias("distinct_numbers"),
        F.min("first_line").alias("first_line"),
        F.sum("last_line").alias("numbered_lines"),
    )


@query
def scan_raw_events(spark, sf_dir):
    layout, manifest = _land_events(spark, sf_dir, "raw")
    report = runs.validate(spark, layout, EXTRACTED_AT, manifest_uri=manifest)
    raw = raw_events(spark, report["raw_s3_uri"])
    return raw.select(*[f.name for f in C.REQUIRED])


@named("require_columns")
def columns_in_lines(spark, sf_dir):
    """Which declared columns occur in at least one line."""
    lines = B.faulty_lines(spark, sf_dir)
    present = gates.fields_in_lines(lines).withColumn("present", F.lit(True))
    names = C.known_names(None) + ["new_field"]
    declared = spark.createDataFrame([(n,) for n in names], "field string")
    return declared.join(present, "field", "left").na.fill(False, subset=["present"])


@query
def read_table_version(spark, sf_dir):
    root = _layout(spark, "version").table("fact")
    events = B.valid_events(spark, sf_dir)
    fact = refine.FACT
    upsert_table(fact.build(B.first_load(events)), root, fact.keys)
    upsert_table(fact.build(B.correction(events)), root, fact.keys)
    rows, version = read_table(spark, root)
    return rows.agg(F.count("*").alias("row_count")).withColumn("version", F.lit(version))


@named("extract_window")
def extracted_events(spark, sf_dir):
    """Media and window come as text, as a run is given them."""
    request = read_request(spark, WANTED_TEXT, RUN_DAY, "2024-01-08", "20240114")
    events = B.plain_events(spark, sf_dir)
    chosen = extract_window(events, request.media_ids, request.first, request.last)
    return chosen.select("event_key", "media_id", "received_at", "visitor_key", "percent_viewed")


@query
def run_manifest(spark, sf_dir):
    layout = _layout(spark, "manifest")
    request = read_request(spark, WANTED_TEXT, RUN_DAY, "2024-01-08", "2024-W02-7")
    period = _extraction(request.first, request.last)
    manifest = runs.land(spark, layout, B.plain_events(spark, sf_dir), request.media_ids, period)
    doc = spark.read.schema(
        "run_id string, start_date string, end_date string, media_count bigint,"
        " total_event_count bigint, results array<struct<media_id string,"
        " event_count bigint, page_count bigint, status string>>"
    ).json(manifest)
    return doc.select("*", F.posexplode("results").alias("position", "result")).select(
        "run_id", "start_date", "end_date", "media_count", "total_event_count", "position",
        "result.*",
    )


@named("manifest_sources")
def _manifest_sources(spark, sf_dir):
    """One manifest document a day, with a result for each event type of the day, some of them broken."""
    kind = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    kinds = B.table(spark, sf_dir, "events").groupBy(day, "event_type").agg(F.count("*").alias("n"))
    uri = (
        F.when(kind == "purchase", F.col("n").cast("string"))
        .when(kind == "error", "null")
        .otherwise(F.concat(F.lit('"s3://lake/'), "day", F.lit("/"), kind, F.lit('"')))
    )
    entry = F.concat(F.lit('{"s3_uri":'), uri, F.lit("}"))
    days = kinds.groupBy("day").agg(F.sort_array(F.collect_list(F.struct("event_type", entry.alias("text")))).alias("e"))
    text = F.concat(F.lit('{"results":['), F.array_join(F.col("e")["text"], ","), F.lit("]}"))
    return manifest_sources(json_documents(days.select("day", text.alias("value")), MANIFEST_MEMBERS, "day"), "day")


@query
def route_valid(spark, sf_dir):
    report = _validate_faulty(spark, sf_dir, "valid")
    raw = raw_events(spark, report["raw_s3_uri"])
    return raw.select("event_key", "media_id", "percent_viewed", "country")


@query
def route_quarantine(spark, sf_dir):
    """With the line number a line has among its media's, as the lines were landed by event."""
    layout, manifest = _land_faulty(spark, sf_dir, "quarantine", order=("event_id",))
    files = landing_lines(spark, read_manifest(spark, manifest).sources).groupBy("source_uri").agg(F.count("*").alias("n"))
    media = F.regexp_extract("source_uri", "media_id=([^/]+)/", 1)
    earlier = Window.partitionBy(media).orderBy("source_uri").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("source_uri", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    report = runs.validate(spark, layout, EXTRACTED_AT, manifest_uri=manifest)
    rows = spark.read.text(report["quarantine_s3_uri"]).select(
        F.from_json(
            "value",
            "contract_version string, errors array<struct<code string, field string>>,"
            " original_line string, ingestion_run_id string, source_line_number bigint,"
            " source_s3_uri string",
        ).alias("row"),
        F.col("value").contains('"event":').alias("has_event"),
    )
    labels = F.transform("row.errors", lambda e: F.concat_ws(":", e["code"], e["field"]))
    return rows.join(before, F.col("row.source_s3_uri") == F.col("source_uri"), "left").select(
        "row.contract_version",
        "row.ingestion_run_id",
        F.regexp_extract("row.source_s3_uri", "media_id=([^/]+)/", 1).alias("media_id"),
        F.array_join(labels, ",").alias("errors"),
        "has_event",
        F.col("row.original_line").isNotNull().alias("has_line"),
        (F.col("before") + F.col("row.source_line_number")).alias("line_number"),
    )


@query
def validation_report(spark, sf_dir):
    report = _validate_faulty(spark, sf_dir, "report")
    doc = read_report(spark, report["report_s3_uri"])
    totals = F.create_map(
        *[
            part
            for name in ("total", "valid", "quarantined", "malformed")
            for part in (F.lit(name), F.col(f"{name}_record_count"))
        ]
    )
    sections = {
        "records": totals,
        "errors": F.col("error_counts"),
    }
    drift = spark.read.parquet(report["unknown_field_counts_uri"])
    parts = [
        doc.select(F.lit(name).alias("section"), F.explode(m).alias("name", "records"))
        for name, m in sections.items()
    ]
    named = drift.select(F.lit("drift").alias("section"), F.col("path").alias("name"), F.col("record_count").alias("records"))
    return parts[0].unionByName(parts[1]).unionByName(named)


def _upserted(spark, sf_dir, build, keys):
    events = B.valid_events(spark, sf_dir)
    return upsert(build(B.first_load(events)), build(B.correction(events)), keys)


@query
def upsert_fact(spark, sf_dir):
    return _upserted(spark, sf_dir, refine.fact_media_engagement, ["event_id"])


@query
def upsert_dim_media(spark, sf_dir):
    return _upserted(spark, sf_dir, refine.dim_media, ["media_id"])


@query
def upsert_dim_visitors(spark, sf_dir):
    return _upserted(spark, sf_dir, refine.dim_visitors, ["visitor_id"])


@query
def overwrite_curated(spark, sf_dir):
    """A second build with more columns replaces the first."""
    root = _layout(spark, "curated").table("visitor_engagement")
    fact = refine.fact_media_engagement(B.valid_events(spark, sf_dir))
    overwrite_table(fact.groupBy("visitor_id").agg(F.count("*").alias("views")), root)
    overwrite_table(visitor_engagement(fact), root)
    return rounded(read_table(spark, root)[0], "avg_pct_viewed")


@query
def export_detail_csv(spark, sf_dir):
    path = new_folder(spark, "csv")
    rows = serve.detail(B.model(spark, sf_dir).enriched())
    serve.export_csv(rows, path)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rounded(spark.read.schema(kinds).option("header", "true").csv(path), "avg_pct_viewed")


# ---- projections and gates -------------------------------------------------------------


@query
def project_media(spark, sf_dir):
    return refine.project_media(B.valid_events(spark, sf_dir))


@query
def project_visitors(spark, sf_dir):
    return refine.project_visitors(B.valid_events(spark, sf_dir))


@query
def project_fact(spark, sf_dir):
    return refine.project_fact(B.valid_events(spark, sf_dir))


def _titled_events(spark, sf_dir):
    """Events whose title names one, both or no channel, or is missing."""
    kind = F.col("event_type")
    title = (
        F.when(kind == "view", "Spring youtube cut")
        .when(kind == "click", "Spring FaceBook cut")
        .when(kind == "purchase", "YouTube and facebook")
        .when(kind == "signup", "Spring cut")
    )
    media = F.concat(F.lit("m"), (B.content_key() % 5).cast("string")).alias("media_id")
    return B.table(spark, sf_dir, "events").select("event_id", media, title.alias("title"))


@query
def channel_classify(spark, sf_dir):
    titled = _titled_events(spark, sf_dir)
    return titled.select("event_id", channel_from_title(F.col("title")).alias("channel"))


@query
def channel_violations(spark, sf_dir):
    titled = _titled_events(spark, sf_dir)
    found = gates.channel_violations(
        titled.withColumn("channel", channel_from_title(F.col("title")))
    )
    return found.groupBy("media_id", "title").agg(F.count("*").alias("row_count"))


@query
def channel_examples(spark, sf_dir):
    """What the message of the channel gate shows."""
    titled = _titled_events(spark, sf_dir)
    return gates.channel_examples(titled.withColumn("channel", channel_from_title(F.col("title"))))


@query
def curated_audit(spark, sf_dir):
    audited = with_audit(
        B.model(spark, sf_dir).engagement, B.LAST_DAY, EXTRACTED_AT, RUN_ID
    )
    refreshed = F.date_format("pipeline_refreshed_at", "yyyy-MM-dd HH:mm:ss")
    return rounded(audited.withColumn("pipeline_refreshed_at", refreshed), "avg_pct_viewed")


@query
def enrich_dashboard(spark, sf_dir):
    return rounded(B.model(spark, sf_dir).enriched(), "avg_pct_viewed")


@query
def enrich_without_dims(spark, sf_dir):
    return rounded(serve.enrich(B.model(spark, sf_dir).engagement), "avg_pct_viewed")


@query
def engagement_bands(spark, sf_dir):
    return serve.engagement_bands(serve.normalized_engagement(B.model(spark, sf_dir).engagement))


@query
def visitor_media_detail(spark, sf_dir):
    return rounded(serve.detail(B.model(spark, sf_dir).enriched()), "avg_pct_viewed")


@query
def filter_membership(spark, sf_dir):
    rows = by_membership(
        B.model(spark, sf_dir).enriched(), CHOSEN_MEDIA, CHOSEN_CHANNELS, CHOSEN_COUNTRIES
    )
    return rows.select("visitor_id", "media_id", "channel", "country", "total_views")


@query
def filter_date_overlap(spark, sf_dir):
    rows = by_date_overlap(B.model(spark, sf_dir).enriched(), *OVERLAP)
    return rows.select("visitor_id", "media_id", "first_date_watched", "last_date_watched")


@query
def watch_date_violations(spark, sf_dir):
    """Dates as text: one media has a broken first date, long watchers lack the last."""
    rows = B.model(spark, sf_dir).engagement
    first = F.when(F.col("media_id") == "m3", "01/02/24").otherwise(
        F.col("first_date_watched").cast("string")
    )
    last = F.when(F.col("max_pct_viewed") <= 0.9, F.col("last_date_watched").cast("string"))
    broken = gates.watch_date_violations(
        rows.withColumns({"first_date_watched": first, "last_date_watched": last})
    )
    return broken.select("visitor_id", "media_id", "first_date_watched", "last_date_watched")


def _event_ledger(spark, sf_dir):
    """Every event as a ledger entry: one workflow run per day, one key per event type."""
    kind = F.col("event_type")
    key = (
        F.when(kind == "view", L.RUN_ID)
        .when(kind == "click", L.FACT_RUN_ID)
        .when(kind == "purchase", L.FACT_URI)
        .when(kind == "signup", L.END_DATE)
        .otherwise(L.REPORT_URI)
    )
    value = (
        F.when(kind.isin("view", "click"), F.concat(F.lit("run-"), (F.col("user_id") % 2)))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("s3://lake/"), F.col("user_id")))
    )
    return B.table(spark, sf_dir, "events").select(
        F.concat(F.lit("wf-"), F.date_format("ts", "yyyy-MM-dd")).alias("workflow_run"),
        kind.alias("stage"),
        key.alias("key"),
        value.alias("value"),
        F.col("ts").alias("logged_at"),
    )


@query
def run_ledger_latest(spark, sf_dir):
    return L.latest_properties(_event_ledger(spark, sf_dir))


@query
def fact_run_gate(spark, sf_dir):
    """Workflow runs whose fact table is of another ingestion run."""
    return L.lineage_mismatches(_event_ledger(spark, sf_dir), L.RUN_ID, L.FACT_RUN_ID)


@query
def resolve_run_input(spark, sf_dir):
    """Inputs of the newest workflow run in a stored ledger."""
    root = _layout(spark, "ledger").ledger
    entries = _event_ledger(spark, sf_dir)
    entries = entries.withColumn("logged_at", F.col("logged_at").cast("timestamp"))
    entries.hint("rebalance", "workflow_run").write.partitionBy("workflow_run").parquet(root)
    ledger = L.read_ledger(spark, root)
    newest = ledger.agg(F.max("workflow_run")).collect()[0][0]
    found = L.resolve(ledger, newest, (L.RUN_ID, L.REPORT_URI))
    rows = [(newest, key, value) for key, value in found.items()]
    return spark.createDataFrame(rows, "workflow_run string, key string, value string")


@query
def lineage_gate(spark, sf_dir):
    """One report document per day and event type, checked against the day's run."""
    kind = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    batches = B.table(spark, sf_dir, "events").groupBy(day, "event_type").agg(
        F.count("*").alias("records")
    )
    run = F.concat(F.lit("run-"), F.when(kind == "click", "other").otherwise(F.col("day")))
    uri = F.when(kind == "purchase", "7").otherwise('"s3://lake/raw"')
    count = (
        F.when(kind == "signup", F.concat(F.lit('"'), "records", F.lit('"')))
        .when(kind == "error", F.concat(F.lit("-"), "records"))
        .otherwise(F.col("records").cast("string"))
    )
    text = F.concat(
        F.lit('{"ingestion_run_id":"'), run, F.lit('","raw_s3_uri":'), uri,
        F.lit(',"valid_record_count":'), count, F.lit("}"),
    )
    docs = json_documents(batches.select("day", "event_type", text.alias("value")), REPORT_MEMBERS, "day", "event_type")
    values = report_values(docs, "day", "event_type")
    expected = F.concat(F.lit("run-"), "day")
    verdict = (
        F.when(~F.equal_null(F.col("run_id"), expected), "wrong run")
        .when(F.col("raw_uri").isNull(), "no raw uri")
        .when(F.col("valid_records").isNull(), "bad count")
        .otherwise("ok")
    )
    return values.select("day", "event_type", "valid_records", verdict.alias("verdict"))


@named("load_dashboard")
def loaded_dashboard(spark, sf_dir):
    """Tables stored, then read back, gated and enriched, with their newest audit values."""
    layout = _layout(spark, "dashboard")
    tables = B.model(spark, sf_dir)
    audited = with_audit(tables.engagement, B.LAST_DAY, EXTRACTED_AT, RUN_ID)
    overwrite_table(audited, layout.table("visitor_engagement"))
    upsert_table(tables.media, layout.table("dim_media"), refine.DIM_MEDIA.keys)
    upsert_table(tables.visitors, layout.table("dim_visitors"), refine.DIM_VISITORS.keys)
    board = load_dashboard(
        spark,
        layout.table("visitor_engagement"),
        layout.table("dim_media"),
        layout.table("dim_visitors"),
    )
    fresh = board.freshness.select(F.col("ingestion_run_id").alias("newest_run"))
    rows = board.enriched.drop("data_through_date", "pipeline_refreshed_at", "ingestion_run_id")
    newest = fresh.collect()[0]["newest_run"]
    stamped = rows.withColumns(
        {"newest_run": F.lit(newest), "version": F.lit(board.curated_version)}
    )
    return rounded(stamped, "avg_pct_viewed")


@query
def zero_valid_noop(spark, sf_dir):
    """An empty batch leaves table and version as they are."""
    root = _layout(spark, "noop").table("fact")
    fact = refine.FACT
    rows = fact.build(B.valid_events(spark, sf_dir))
    loaded = upsert_table(rows, root, fact.keys)
    table, before = read_table(spark, root)
    empty = upsert_table(table.filter(F.col("watched_percent") > 1), root, fact.keys)
    table, after = read_table(spark, root)
    return table.agg(F.count("*").alias("row_count")).select(
        F.lit(loaded).cast("bigint").alias("loaded"),
        F.lit(empty).cast("bigint").alias("added"),
        "row_count",
        F.lit(before == after).alias("same_version"),
    )


# ---- record validation ------------------------------------------------------------------


def _checked(spark, sf_dir):
    lines = B.faulty_lines(spark, sf_dir)
    # the events are one file: deal its lines out before the checks
    return check_lines(lines.repartition(spark.sparkContext.defaultParallelism))


def _issues(spark, sf_dir, code, *fields):
    found = _checked(spark, sf_dir).select("event_id", F.inline("issues"))
    found = found.filter(F.col("code") == code)
    if fields:
        found = found.filter(F.col("field").isin(*fields))
    return found.select("event_id", "field", "message")


@query
def dq_malformed(spark, sf_dir):
    return _issues(spark, sf_dir, C.MALFORMED).select("event_id", "field")


@query
def dq_record_type(spark, sf_dir):
    return _issues(spark, sf_dir, C.NOT_AN_OBJECT)


@query
def dq_missing(spark, sf_dir):
    return _issues(spark, sf_dir, C.MISSING)


@query
def dq_null(spark, sf_dir):
    return _issues(spark, sf_dir, C.NULL)


@query
def dq_type(spark, sf_dir):
    return _issues(spark, sf_dir, C.WRONG_TYPE, "event_key", "lat", "percent_viewed")


@query
def dq_timestamp(spark, sf_dir):
    return _issues(spark, sf_dir, C.WRONG_TYPE, "received_at")


@query
def dq_union_type(spark, sf_dir):
    return _issues(spark, sf_dir, C.WRONG_TYPE, "conversion_type")


@query
def dq_nested(spark, sf_dir):
    return _issues(
        spark, sf_dir, C.WRONG_TYPE, "thumbnail", "thumbnail.width", "user_agent_details.mobile"
    )


@query
def dq_range(spark, sf_dir):
    return _issues(spark, sf_dir, C.OUT_OF_RANGE)


@query
def dq_issues(spark, sf_dir):
    labels = F.transform("issues", lambda i: F.concat_ws(":", i["code"], i["field"]))
    return _checked(spark, sf_dir).select(
        "event_id", "is_valid", F.array_join(labels, ",").alias("issues")
    )


@query
def dq_drift(spark, sf_dir):
    return _checked(spark, sf_dir).select("event_id", F.explode("unknown_fields").alias("path"))


# ---- aggregates -------------------------------------------------------------------------


@named("visitor_engagement")
def curated_engagement(spark, sf_dir):
    return rounded(B.model(spark, sf_dir).engagement, "avg_pct_viewed")


@query
def kpis(spark, sf_dir):
    return rounded(serve.kpis(serve.normalized_engagement(B.model(spark, sf_dir).engagement)), "weighted_average")


@query
def kpis_filtered(spark, sf_dir):
    enriched = B.model(spark, sf_dir).enriched()
    chosen = by_membership(enriched, CHOSEN_MEDIA, CHOSEN_CHANNELS, CHOSEN_COUNTRIES)
    return rounded(serve.kpis(by_date_overlap(chosen, *OVERLAP)), "weighted_average")


@query
def media_summary(spark, sf_dir):
    return rounded(serve.media_summary(B.model(spark, sf_dir).enriched()), "avg_pct_viewed")


@query
def top_countries(spark, sf_dir):
    return serve.top_countries(B.model(spark, sf_dir).enriched())


@query
def top_visitors(spark, sf_dir):
    return serve.top_visitors(B.model(spark, sf_dir).enriched())


@query
def validation_counts(spark, sf_dir):
    return _checked(spark, sf_dir).agg(*checks.count_columns())


@query
def error_counts(spark, sf_dir):
    return checks.error_counts(_checked(spark, sf_dir))


@query
def unknown_field_counts(spark, sf_dir):
    return checks.unknown_field_counts(_checked(spark, sf_dir))


@query
def pipeline_freshness(spark, sf_dir):
    """Audit columns that differ from row to row, each of them missing in some."""
    kind = F.col("event_type")
    rows = B.table(spark, sf_dir, "events").select(
        F.when(kind != "view", F.to_date("ts")).alias("data_through_date"),
        F.when(kind != "click", F.col("ts") + F.expr("interval 390 minutes")).alias("pipeline_refreshed_at"),
        F.when(kind != "error", F.concat(F.lit("run-"), F.date_format("ts", "yyyyMMdd"))).alias("ingestion_run_id"),
    )
    found = serve.pipeline_freshness(rows)
    refreshed = F.date_format("pipeline_refreshed_at", "yyyy-MM-dd HH:mm:ss")
    return found.withColumn("pipeline_refreshed_at", refreshed)


@query
def upsert_duplicate_gate(spark, sf_dir):
    """The keys that would refuse an upsert of the raw line items."""
    return repeated_keys(B.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def table_row_counts(spark, sf_dir):
    layout = _layout(spark, "counts")
    events = B.valid_events(spark, sf_dir)
    counts = {
        t.name: runs.load_table(refine.build_table(events, t), layout, t) for t in refine.REFINED
    }
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


@query
def filter_domains(spark, sf_dir):
    return serve.filter_domains(B.model(spark, sf_dir).enriched())


@query
def date_extent(spark, sf_dir):
    return serve.date_extent(B.model(spark, sf_dir).enriched())


@query
def media_labels(spark, sf_dir):
    return serve.media_labels(B.model(spark, sf_dir).enriched())


# ---- newest row per key -------------------------------------------------------------------


@query
def dim_media(spark, sf_dir):
    return refine.dim_media(B.valid_events(spark, sf_dir))


@query
def dim_visitors(spark, sf_dir):
    return refine.dim_visitors(B.valid_events(spark, sf_dir))


@query
def fact_media_engagement(spark, sf_dir):
    return refine.fact_media_engagement(B.valid_events(spark, sf_dir))


@query
def dedup_latest_lineitem(spark, sf_dir):
    lines = B.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    others = ["l_shipdate"] + [c for c in lines.columns if c not in (*keys, "l_shipdate")]
    newest = latest_per_key(lines, keys, others)
    return newest.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


# ---- runs ---------------------------------------------------------------------------------


@query
def replay_idempotent(spark, sf_dir):
    """The same run twice, from landing to the curated table."""
    layout = _layout(spark, "replay")
    scope = B.scope(spark, sf_dir)
    period = _extraction(scope.first, scope.last)
    for _ in range(2):
        runs.run_once(
            spark, layout, B.plain_events(spark, sf_dir), scope.media_ids, period, "wf-1", EXTRACTED_AT
        )
    rows, _ = read_table(spark, layout.table("visitor_engagement"))
    return rounded(rows.drop("pipeline_refreshed_at"), "avg_pct_viewed")


@query
def backfill_recompute(spark, sf_dir):
    """A correction replaces facts by key; the curated table follows."""
    layout = _layout(spark, "backfill")
    events = B.valid_events(spark, sf_dir)
    fact = refine.FACT
    for load in (B.first_load(events), B.correction(events)):
        runs.load_table(fact.build(load), layout, fact)
    rows, _ = read_table(spark, layout.table(fact.name))
    return rounded(visitor_engagement(rows), "avg_pct_viewed")


@query
def stream_incremental(spark, sf_dir):
    """Landed files loaded by a stream give the facts of the batch build."""
    layout, _ = _land_events(spark, sf_dir, "stream")
    start_incremental(spark, layout, f"{layout.root}/checkpoint").awaitTermination()
    return read_table(spark, layout.table(refine.FACT.name))[0]


@query
def stream_reports(spark, sf_dir):
    """What the reports and the ledger of a stream over faulty lines say, and whether they name each file once."""
    layout, manifest = _land_faulty(spark, sf_dir, "stream_reports")
    landed = landing_lines(spark, read_manifest(spark, manifest).sources).agg(
        F.count_distinct("source_uri").alias("files")
    )
    start_incremental(spark, layout, f"{layout.root}/checkpoint", files_per_batch=3).awaitTermination()
    reports = read_report(spark, f"{layout.validated}_reports/*/*")
    counted = ["total", "valid", "quarantined", "malformed"]
    totals = reports.agg(
        *[F.sum(f"{name}_record_count").alias(name) for name in counted],
        F.sum(F.size("input_s3_uris")).alias("named"),
        F.count_distinct("ingestion_run_id").alias("runs"),
        F.count("*").alias("reports"),
    )
    ledger = L.read_ledger(spark, layout.ledger)
    published = L.latest_properties(ledger).groupBy("key").agg(F.sum(F.col("value").try_cast("bigint")).alias("n"))
    found = published.filter(F.col("key").isin(L.VALID_COUNT, L.QUARANTINE_COUNT)).agg(
        F.sum("n").alias("published"), F.count("*").alias("keys")
    )
    parts = totals.unionByName(landed, allowMissingColumns=True).unionByName(found, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns]).select(
        *counted, "published", (F.col("named") == F.col("files")).alias("each_file_once"),
        ((F.col("runs") == F.col("reports")) & (F.col("keys") == 2)).alias("each_run_once"),
    )
