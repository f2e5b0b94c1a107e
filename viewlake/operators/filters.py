"""Dashboard filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _chosen(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isin(list(values)) if values else F.lit(False)


def by_membership(
    df: DataFrame, media_ids: Sequence[str], channels: Sequence[str], countries: Sequence[str]
) -> DataFrame:
    """Rows whose media, channel and country are all chosen; no choice, no rows."""
    return df.filter(
        _chosen("media_id", media_ids)
        & _chosen("channel", channels)
        & _chosen("country", countries)
    )


def by_date_overlap(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Rows whose watch period touches the closed interval [start, end]."""
    return df.filter(
        (F.col("last_date_watched") >= F.lit(start)) & (F.col("first_date_watched") <= F.lit(end))
    )
