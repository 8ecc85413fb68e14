"""Structured Streaming forms of the keyed state operators.

These are additions: the batch operators they follow count per fixed window and
drop repeated keys of active work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(events: DataFrame, user: str, ts: str, length: str, limit: int) -> DataFrame:
    """Events per user and fixed window with a flag beyond the limit; batch or stream."""
    return (
        events.groupBy(F.col(user), F.window(ts, length).alias("w"))
        .agg(F.count("*").alias("n"))
        .select(user, F.col("w.start").alias("window_start"), "n", (F.col("n") > limit).alias("over_limit"))
    )


def streaming_window_counts(events: DataFrame, user: str, ts: str, length: str, limit: int, lateness: str) -> DataFrame:
    """As ``window_counts`` with bounded state: a window is final once the watermark passes it."""
    return window_counts(events.withWatermark(ts, lateness), user, ts, length, limit)


def streaming_dedupe(events: DataFrame, keys: list[str], ts: str, lateness: str) -> DataFrame:
    """The first event of each key within the watermark's delay."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)
