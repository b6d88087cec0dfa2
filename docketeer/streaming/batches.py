"""Appends in batches of a size: rows wait until there are enough, then become one part of a log, and callers are told.

A micro-batch is written under its number, so that one that runs again writes over itself.  When what waits holds `size`
rows or more, it is written as one part of the log under the newest number, the callback is called with the part, and a
mark is left; a restart finds the mark and neither writes nor calls again.  A run that ends between call and mark calls
once more: callbacks get the part's number, by which they can tell.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from docketeer.sources import files

Callback = Callable[[DataFrame, int], None]


def _numbers(spark: SparkSession, path: str, start: str) -> list[int]:
    return sorted(int(name.removeprefix(start)) for name in files.folders(spark, path) if name.startswith(start))


def _marked(spark: SparkSession, path: str) -> int:
    return max((int(name) for name in files.sizes(spark, f"{path}/marks")), default=-1)


def flush(spark: SparkSession, path: str, after: Callback | None = None, least: int = 1) -> int | None:
    """Make what waits a part of the log, if it has at least so many rows: the part's number."""
    done = _marked(spark, path)
    waiting = [n for n in _numbers(spark, f"{path}/waiting", "batch-") if n > done]
    if not waiting:
        return None
    rows = spark.read.parquet(*(f"{path}/waiting/batch-{n}" for n in waiting))
    if rows.limit(least).count() < least:
        return None
    part = f"{path}/log/part-{waiting[-1]}"
    rows.write.mode("overwrite").parquet(part)
    if after:
        after(spark.read.parquet(part), waiting[-1])
    files.mark(spark, f"{path}/marks/{waiting[-1]}")
    return waiting[-1]


def append(stream: DataFrame, path: str, checkpoint: str, size: int, after: Callback | None = None) -> StreamingQuery:
    """Start appending the stream's rows, all that are there now."""

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number <= _marked(spark, path):  # it ran before, and its part is in the log
            return
        batch.write.mode("overwrite").parquet(f"{path}/waiting/batch-{number}")
        flush(spark, path, after, size)

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def log(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all parts that are marked."""
    done = _marked(spark, path)
    return spark.read.parquet(*(f"{path}/log/part-{n}" for n in _numbers(spark, f"{path}/log", "part-") if n <= done))
