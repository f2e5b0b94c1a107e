"""Keyed upsert as a DataFrame operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlake.errors import GateError


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` plus the rows of ``target`` whose key it does not hold.

    NULL keys never match. The keys of both sides are unique, so no key is hot; Spark
    broadcasts the source keys while they are small and shuffles both sides otherwise.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*source.columns).unionByName(source)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, count)`` of the non-null keys that occur more than once."""
    return df.select(*keys).na.drop("any").groupBy(*keys).count().filter(F.col("count") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Fail when a non-null key occurs twice, as a merge into a table would."""
    repeated = repeated_keys(df, keys).limit(1).collect()
    if repeated:
        example = ", ".join(f"{k}={repeated[0][k]!r}" for k in keys)
        raise GateError(f"{name} has several rows for {example}.")
