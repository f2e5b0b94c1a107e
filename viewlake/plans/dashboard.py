"""Everything the dashboard reads, from the stored tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from viewlake.operators.gates import require_watch_dates
from viewlake.plans.serve import enrich, media_labels, pipeline_freshness
from viewlake.sources.tables import read_table


@dataclass(frozen=True)
class Dashboard:
    """The enriched rows every mart starts from, and what describes them."""

    enriched: DataFrame
    labels: DataFrame
    freshness: DataFrame
    curated_version: int
    loaded_at: str


def load_dashboard(
    spark: SparkSession,
    curated_root: str,
    media_root: str | None = None,
    visitors_root: str | None = None,
) -> Dashboard:
    """Read the curated table and the dimensions that exist; broken watch dates fail."""
    engagement, version = read_table(spark, curated_root)
    require_watch_dates(engagement)
    media = read_table(spark, media_root)[0] if media_root else None
    visitors = read_table(spark, visitors_root)[0] if visitors_root else None
    enriched = enrich(engagement, media, visitors, unique=True)
    return Dashboard(
        enriched,
        media_labels(enriched),
        pipeline_freshness(engagement),
        version,
        f"{dt.datetime.now(dt.timezone.utc):%Y-%m-%d %H:%M} UTC",
    )
