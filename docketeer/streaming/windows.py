"""Windows over the access stream: sessions an hour, requests a minute, each with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.operators.quota import REQUESTS_PER_MINUTE, SESSIONS_PER_HOUR


def over_limit(events: DataFrame, key: str, ts: str, width: str, limit: int, lateness: str = "10 minutes") -> DataFrame:
    counted = events.withWatermark(ts, lateness).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > limit).select(key, F.col("window.start").alias("window_start"), "n")


def flood_guard(events: DataFrame, key: str = "address", ts: str = "ts") -> DataFrame:
    return over_limit(events, key, ts, "60 seconds", REQUESTS_PER_MINUTE)


def session_cap(events: DataFrame, key: str = "address", ts: str = "ts") -> DataFrame:
    return over_limit(events, key, ts, "1 hour", SESSIONS_PER_HOUR)


def new_versions(captures: DataFrame, url: str, content_key: str, ts: str, lateness: str = "2 days") -> DataFrame:
    """The first capture of each version of an address; captures later than the watermark are ignored."""
    return captures.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([url, content_key])
