"""Channel of a media, derived from its title."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word looked for (any case) and the channel it stands for.
CHANNEL_WORDS = (("youtube", "Youtube"), ("facebook", "Facebook"))


def channel_from_title(
    title: Column, words: tuple[tuple[str, str], ...] = CHANNEL_WORDS
) -> Column:
    """The one channel whose word occurs in the title; NULL for none or several."""
    lowered = F.lower(title)
    found = [F.contains(lowered, F.lit(word)) for word, _ in words]
    hits = reduce(lambda a, b: a + b, (hit.cast("int") for hit in found))
    channels = [F.when(hit, channel) for hit, (_, channel) in zip(found, words)]
    return F.when(hits == 1, F.coalesce(*channels))
