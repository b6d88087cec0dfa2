"""Queries that run a stream over finished files to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.operators.quota import micros
from docketeer.plans.registry import Tables, query
from docketeer.sources.shared import shared_path
from docketeer.streaming import ingest, quota


@query("SELECT user_id, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def stream_ingest_idempotent(t: Tables) -> DataFrame:
    """Events ingested as a stream, then once more by a second stream without the first one's progress: no row twice."""
    target = shared_path(t.spark, "ingested")
    for run in range(2):
        ingest.ingest(t.spark, f"{t.folder}/events[.]parquet", t.events.schema, target, "event_id", shared_path(t.spark, f"progress{run}")).awaitTermination()
    return t.spark.read.parquet(target).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


def access_events(events: DataFrame) -> DataFrame:
    """Events as document requests, a browser a user and an address a group of users, squeezed in time so that limits are
    met."""
    return events.select(
        F.concat(F.lit("b"), F.col("user_id")).alias("browser_id"),
        F.concat(F.lit("a"), F.col("user_id") % 7).alias("address"),
        F.concat(F.lit("s"), F.col("event_id") % 3).alias("session_id"),
        F.concat(F.lit("d"), F.col("event_id") % 211).alias("doc_key"),
        F.floor(micros("ts") / 60_000).cast("long").alias("ts_ms"),
        F.col("event_id").alias("seq"),
    )


#: Limits low enough for the test tables.
SMALL = quota.Limits(per_minute=4, per_check=30, per_day=20, per_week=60, pause_s=600, per_address=40)


@query()
def stream_quota(t: Tables) -> DataFrame:
    """What the quota decides on each request."""
    target = shared_path(t.spark, "quota")
    events = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events[.]parquet")
    quota.charge(access_events(events), target, shared_path(t.spark, "progress"), SMALL).awaitTermination()
    return quota.decisions(t.spark, target)
