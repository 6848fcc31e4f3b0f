"""De-duplication and outcome counters over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.operators.joins import needs_work

# Fixed value: how long a seen key is remembered.
DEFAULT_TTL = "24 hours"


def dedup_stream(df: DataFrame, key: str | list[str], time_col: str, ttl: str = DEFAULT_TTL) -> DataFrame:
    """The first row of every key; a key is forgotten ``ttl`` after its event time.

    State is hashed by key, so one key repeated without end occupies one entry.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.withWatermark(time_col, ttl).dropDuplicatesWithinWatermark(keys)


def unseen_refs(refs: DataFrame, contests: DataFrame) -> DataFrame:
    """Streamed references that the stored table does not hold in parsed form (stream-static join)."""
    return needs_work(refs, contests)


def outcome_windows(df: DataFrame, time_col: str = "at", width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Outcomes per stage and kind in tumbling windows; rows later than ``late`` are dropped."""
    counted = df.withWatermark(time_col, late).groupBy(F.window(time_col, width), "stage", "kind").agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select(F.unix_seconds("window.start").alias("window_start"), "stage", "kind", "n")
