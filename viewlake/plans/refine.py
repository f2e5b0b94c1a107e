"""Refined tables: media and visitor dimensions and the engagement fact."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewlake.functions.iso_time import iso_timestamp
from viewlake.functions.media import channel_from_title
from viewlake.operators.gates import require_channels, require_columns
from viewlake.operators.latest import latest_per_key
from viewlake.session import stage
from viewlake.sources.landing import raw_events

_USED = [
    "event_key", "received_at", "visitor_key", "media_id", "media_name", "media_url",
    "percent_viewed", "ip", "country",
]


def typed_events(raw: DataFrame) -> DataFrame:
    """The required fields of raw events, with the arrival time as a timestamp."""
    require_columns(raw.columns, _USED, "Raw input")
    # Text is read by the grammar of the contract's rule; a source that already has timestamps keeps them.
    if dict(raw.dtypes)["received_at"] == "string":
        raw = raw.withColumn("received_at", F.expr(iso_timestamp("received_at")))
    return raw.select(*_USED)


def project_media(events: DataFrame) -> DataFrame:
    require_columns(
        events.columns, ("media_id", "media_name", "media_url", "received_at"), "Raw input"
    )
    return events.select(
        "media_id",
        F.col("media_name").alias("title"),
        F.col("media_url").alias("url"),
        "received_at",
        channel_from_title(F.col("media_name")).alias("channel"),
    )


def project_visitors(events: DataFrame) -> DataFrame:
    require_columns(events.columns, ("visitor_key", "ip", "country", "received_at"), "Raw input")
    return events.select(
        F.col("visitor_key").alias("visitor_id"),
        F.col("ip").alias("ip_address"),
        "country",
        "received_at",
    )


def project_fact(events: DataFrame) -> DataFrame:
    require_columns(
        events.columns,
        ("event_key", "visitor_key", "media_id", "received_at", "percent_viewed"),
        "Raw input",
    )
    return events.select(
        F.col("event_key").alias("event_id"),
        F.col("visitor_key").alias("visitor_id"),
        "media_id",
        "received_at",
        F.col("percent_viewed").cast("double").alias("watched_percent"),
    )


def dim_media(events: DataFrame) -> DataFrame:
    """Newest title, url and channel per media. Run ``require_channels`` first.

    The channel follows from the title, so only the rows that stay are classified.
    """
    candidates = project_media(events).drop("channel")
    newest = latest_per_key(candidates, ["media_id"], ["received_at", "title", "url"])
    channel = channel_from_title(F.col("title")).alias("channel")
    return newest.select("media_id", "title", "url", channel)


def dim_visitors(events: DataFrame) -> DataFrame:
    """Newest address and country per visitor."""
    newest = latest_per_key(
        project_visitors(events), ["visitor_id"], ["received_at", "ip_address", "country"]
    )
    return newest.select("visitor_id", "ip_address", "country")


def fact_media_engagement(events: DataFrame) -> DataFrame:
    """Newest copy of every event; its date is taken after the copies are gone."""
    newest = latest_per_key(
        project_fact(events),
        ["event_id"],
        ["received_at", "visitor_id", "media_id", "watched_percent"],
    )
    return newest.select(
        "event_id",
        "visitor_id",
        "media_id",
        F.to_date("received_at").alias("date"),
        "watched_percent",
    )


@dataclass(frozen=True)
class RefinedTable:
    name: str
    keys: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]


DIM_MEDIA = RefinedTable("dim_media", ("media_id",), dim_media)
DIM_VISITORS = RefinedTable("dim_visitors", ("visitor_id",), dim_visitors)
FACT = RefinedTable("fact_media_engagement", ("event_id",), fact_media_engagement)
REFINED = (DIM_MEDIA, DIM_VISITORS, FACT)


def staged_events(spark: SparkSession, raw_uri: str, path: str) -> DataFrame:
    """Raw lines parsed once into Parquet: three builds and a gate read columns of it.

    Raw lines are read with a declared schema, in which no column is ever missing. So the values of each required field
    are counted as they are written, and a field that no record has stops the stage.
    """
    seen = Observation()
    events = typed_events(raw_events(spark, raw_uri))
    observed = events.observe(seen, F.count("*").alias("records"), *[F.count(c).alias(c) for c in _USED])
    staged = stage(observed, path)
    counts = seen.get
    if counts.get("records"):
        require_columns([c for c in _USED if counts[c]], _USED, "Raw input")
    return staged


def build_table(events: DataFrame, table: RefinedTable) -> DataFrame:
    if table is DIM_MEDIA:
        require_channels(project_media(events))
    return table.build(events)
