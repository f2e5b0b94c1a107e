"""Keep the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, each column descending, nulls last.

    Spark cuts every key down to one row per task before the shuffle (window group
    limit), so a key that holds a large part of all rows stays harmless.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
