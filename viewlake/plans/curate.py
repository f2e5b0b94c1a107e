"""Curated table: one row per visitor and media, rebuilt from all facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlake.operators.gates import require_columns
from viewlake.sources.landing import utc_text


def visitor_engagement(fact: DataFrame) -> DataFrame:
    """Views, shares and watch dates per visitor and media.

    Every measure combines partially, so a hot pair shrinks to one row per task before
    the only shuffle.
    """
    require_columns(
        fact.columns, ("event_id", "visitor_id", "media_id", "date", "watched_percent"), "Fact table"
    )
    return fact.groupBy("visitor_id", "media_id").agg(
        F.count("event_id").alias("total_views"),
        F.avg("watched_percent").alias("avg_pct_viewed"),
        F.max("watched_percent").alias("max_pct_viewed"),
        F.min("date").alias("first_date_watched"),
        F.max("date").alias("last_date_watched"),
    )


def with_audit(
    engagement: DataFrame,
    data_through: dt.date | str | None,
    refreshed_at: dt.datetime | str,
    run_id: str,
) -> DataFrame:
    """Stamp freshness and lineage on every row. A naive moment counts as UTC."""
    if isinstance(refreshed_at, dt.datetime):
        refreshed_at = utc_text(refreshed_at)
    return engagement.select(
        "*",
        F.lit(data_through).cast("date").alias("data_through_date"),
        F.lit(refreshed_at).cast("timestamp").alias("pipeline_refreshed_at"),
        F.lit(run_id).alias("ingestion_run_id"),
    )
