"""Measures of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (inclusive) and labels of the completion bands, the open
# lower bound of the first band, and the share from which a viewer counts as engaged.
BANDS = ((0.25, "0–25%"), (0.5, "25–50%"), (0.75, "50–75%"), (1.0, "75–100%"))
LOWEST = -0.001
HIGH_INTENT = 0.75


def completion_band(share: Column) -> Column:
    """Label of the band that holds ``share``; NULL outside all bands."""
    band = F.when(share <= LOWEST, F.lit(None).cast("string"))
    for upper, label in BANDS:
        band = band.when(share <= upper, F.lit(label))
    return band
