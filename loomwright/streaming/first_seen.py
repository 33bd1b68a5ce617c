"""Streaming twins of the stateful batch operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(stream: DataFrame, keys: Sequence[str], at: str, late: str = "1 day") -> DataFrame:
    """Each key with the time it was first seen, once; rows later than the watermark are left out."""
    watched = stream.withWatermark(at, late)
    return watched.dropDuplicatesWithinWatermark(list(keys)).select(*keys, F.col(at).alias("since"))


def windowed_counts(stream: DataFrame, at: str, key: str, width: str, late: str) -> DataFrame:
    """Rows by key and tumbling window, emitted when the watermark passes the window's end."""
    counts = stream.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n")
