"""Dashboard marts over the curated table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewlake.functions.engagement import HIGH_INTENT, completion_band
from viewlake.operators.gates import require_columns
from viewlake.operators.latest import latest_per_key

UNKNOWN = "Unknown"  # fixed value
TOP_COUNTRIES = 10  # fixed value
TOP_VISITORS = 15  # fixed value

_ENGAGEMENT = (
    "visitor_id", "media_id", "total_views", "avg_pct_viewed", "max_pct_viewed",
    "first_date_watched", "last_date_watched",
)


def normalized_engagement(engagement: DataFrame) -> DataFrame:
    """Watch dates as dates; NaN shares count as missing. See ``require_watch_dates``."""
    require_columns(engagement.columns, _ENGAGEMENT, "visitor_engagement")

    def date(name: str):
        return F.to_date(F.try_to_timestamp(F.col(name).cast("string")))

    def share(name: str):
        return F.when(~F.isnan(name), F.col(name))

    kinds = dict(engagement.dtypes)
    changes = {c: date(c) for c in ("first_date_watched", "last_date_watched") if kinds[c] != "date"}
    changes |= {c: share(c) for c in ("avg_pct_viewed", "max_pct_viewed")}
    return engagement.withColumns(changes)


def _look_up(
    rows: DataFrame, dimension: DataFrame, key: str, columns: list[str], unique: bool, hot: bool
) -> DataFrame:
    """Left-join one dimension row per key.

    Nothing is hinted: Spark broadcasts the dimension only while its measured size is below the threshold, and otherwise
    shuffles both sides. A dimension that is unique by construction joins as it lies, so its side has one exchange
    at most. Adaptive execution splits a hot key only between two plain shuffles, so a dimension whose keys are hot in
    ``rows`` is joined by a computed key: without it the join would reuse the partitions that made the dimension unique
    and a hot key would stay in one task.
    """
    others = [c for c in columns if c != key]
    dimension = dimension.select(*columns)
    if unique and not hot:
        return rows.join(dimension, key, "left").select(*rows.columns, *others)
    unique = dimension if unique else latest_per_key(dimension, [key], others)
    unique = unique.select(F.concat(F.col(key).cast("string"), F.lit("")).alias("_key"), *others)
    return rows.join(unique, rows[key] == unique["_key"], "left").drop("_key")


def enrich(
    engagement: DataFrame,
    media: DataFrame | None = None,
    visitors: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """Left-join the dimensions that exist; name what is missing "Unknown".

    ``unique`` says that each dimension has a key once, as those have that this package builds or stores.
    """
    enriched = normalized_engagement(engagement)
    if media is not None:
        require_columns(media.columns, ("media_id", "title", "channel"), "dim_media")
        columns = ["media_id", "title", "channel"] + (["url"] if "url" in media.columns else [])
        enriched = _look_up(enriched, media, "media_id", columns, unique, hot=True)
    else:
        enriched = enriched.withColumns({"title": F.col("media_id"), "channel": F.lit(UNKNOWN)})
    if visitors is not None:
        columns = ["visitor_id", "ip_address", "country"]
        require_columns(visitors.columns, columns, "dim_visitors")
        enriched = _look_up(enriched, visitors, "visitor_id", columns, unique, hot=False)
    else:
        enriched = enriched.withColumns({"ip_address": F.lit(UNKNOWN), "country": F.lit(UNKNOWN)})
    return enriched.na.fill(UNKNOWN, subset=["title", "channel", "country", "ip_address"])


def kpis(filtered: DataFrame) -> DataFrame:
    """Audience totals. Visitors are collapsed first: one shuffle, no row expansion.

    They need no dimension; without a filter on one, give them ``normalized_engagement``.
    """
    per_visitor = filtered.groupBy("visitor_id").agg(
        F.sum("total_views").alias("views"),
        F.sum(F.col("avg_pct_viewed") * F.col("total_views")).alias("weighted"),
        F.max("max_pct_viewed").alias("best"),
    )
    total = F.coalesce(F.sum("views"), F.lit(0))
    return per_visitor.agg(
        F.count("visitor_id").alias("unique_visitors"),
        total.alias("total_views"),
        F.coalesce(
            F.try_divide(F.coalesce(F.sum("weighted"), F.lit(0.0)), F.sum("views")), F.lit(0.0)
        ).alias("weighted_average"),
        F.count_if((F.col("best") >= HIGH_INTENT) & F.col("visitor_id").isNotNull()).alias(
            "high_intent_visitors"
        ),
    )


def media_summary(filtered: DataFrame) -> DataFrame:
    """Views, visitors and view-weighted share per media, most viewed first."""
    per_visitor = (
        filtered.filter(F.col("media_id").isNotNull())
        .groupBy("media_id", "title", "channel", "visitor_id")
        .agg(
            F.sum("total_views").alias("views"),
            F.sum(F.col("avg_pct_viewed") * F.col("total_views")).alias("weighted"),
        )
    )
    # Visitors are unique here, so counting them needs no distinct; the hot media is
    # combined partially before its second, tiny shuffle.
    summary = per_visitor.groupBy("media_id", "title", "channel").agg(
        F.sum("views").alias("total_views"),
        F.count("visitor_id").alias("unique_visitors"),
        F.coalesce(F.sum("weighted"), F.lit(0.0)).alias("weighted"),
    )
    # The share belongs to the media, whatever titles it has.
    media = Window.partitionBy("media_id")
    share = F.try_divide(F.sum("weighted").over(media), F.sum("total_views").over(media))
    return summary.select(
        "media_id", "title", "channel", "total_views", "unique_visitors",
        share.alias("avg_pct_viewed"),
    ).orderBy(F.desc("total_views"), "media_id")


def top_countries(filtered: DataFrame, count: int = TOP_COUNTRIES) -> DataFrame:
    views = (
        filtered.filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.sum("total_views").alias("total_views"))
    )
    return views.orderBy(F.desc("total_views"), "country").limit(count)


def engagement_bands(filtered: DataFrame) -> DataFrame:
    """Visitor-media pairs per completion band; only bands that occur."""
    band = completion_band(F.col("avg_pct_viewed")).alias("engagement_band")
    counted = filtered.select(band).groupBy("engagement_band")
    return counted.agg(F.count("*").alias("visitor_media_pairs")).filter(
        F.col("engagement_band").isNotNull()
    )


def top_visitors(filtered: DataFrame, count: int = TOP_VISITORS) -> DataFrame:
    """Visitors by views, then by their best share."""
    ranked = (
        filtered.filter(F.col("visitor_id").isNotNull() & F.col("country").isNotNull())
        .groupBy("visitor_id", "country")
        .agg(
            F.sum("total_views").alias("total_views"),
            F.count_distinct("media_id").alias("media_watched"),
            F.max("max_pct_viewed").alias("max_pct_viewed"),
            F.max("last_date_watched").alias("last_date_watched"),
        )
    )
    order = [F.desc("total_views"), F.desc_nulls_last("max_pct_viewed"), "visitor_id", "country"]
    return ranked.orderBy(*order).limit(count)


def detail(filtered: DataFrame) -> DataFrame:
    """Visitor-media detail, most viewed first."""
    return filtered.select(
        "visitor_id", "media_id", "title", "channel", "country", "ip_address", "total_views",
        "avg_pct_viewed", "max_pct_viewed", "first_date_watched", "last_date_watched",
    ).orderBy(
        F.desc("total_views"), F.desc_nulls_last("avg_pct_viewed"), "visitor_id", "media_id"
    )


def export_csv(detail_rows: DataFrame, path: str) -> None:
    detail_rows.write.mode("overwrite").option("header", "true").csv(path)


def filter_domains(enriched: DataFrame) -> DataFrame:
    """Distinct choices of each filter, from one scan."""
    columns = {"media": "media_id", "channel": "channel", "country": "country"}
    choices = F.array(
        *[
            F.struct(F.lit(kind).alias("filter"), F.col(column).alias("choice"))
            for kind, column in columns.items()
        ]
    )
    found = enriched.select(F.inline(choices)).filter(F.col("choice").isNotNull()).distinct()
    return found.orderBy("filter", "choice")


def date_extent(enriched: DataFrame) -> DataFrame:
    return enriched.agg(
        F.min("first_date_watched").alias("min_date"), F.max("last_date_watched").alias("max_date")
    )


def media_labels(enriched: DataFrame) -> DataFrame:
    """One title per media. Distinct pairs are few, so the hot media costs nothing."""
    pairs = enriched.select("media_id", "title").distinct()
    return pairs.groupBy("media_id").agg(F.min("title").alias("title"))


def pipeline_freshness(engagement: DataFrame) -> DataFrame:
    """Newest audit values; columns that do not exist yet are NULL."""
    kinds = {
        "data_through_date": "date",
        "pipeline_refreshed_at": "timestamp",
        "ingestion_run_id": "string",
    }
    missing = {c: F.lit(None).cast(k) for c, k in kinds.items() if c not in engagement.columns}
    rows = engagement.withColumns(missing) if missing else engagement
    known_run = F.col("ingestion_run_id").isNotNull()
    refreshed = F.try_to_timestamp(F.col("pipeline_refreshed_at").cast("string"))
    order = F.when(known_run, F.struct(refreshed, F.col("ingestion_run_id")))
    return rows.agg(
        F.max(F.to_date(F.try_to_timestamp(F.col("data_through_date").cast("string")))).alias(
            "data_through_date"
        ),
        F.max(refreshed).alias("pipeline_refreshed_at"),
        F.max_by("ingestion_run_id", order).alias("ingestion_run_id"),
    )
