"""Incremental ingest as a stream of files: each batch adds what the target lacks, so a repeated batch adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docketeer.sources import files


def append_new(batch: DataFrame, target: str, key: str) -> None:
    """Append one row of each key of the batch that target lacks.  A target that can't be read ends the batch.

    Of the target only the keys that the batch has are kept: where the batch is small Spark sends its keys to the
    target's scan, and the target isn't moved.
    """
    rows = batch.dropDuplicates([key])
    if files.exists(batch.sparkSession, target):
        known = batch.sparkSession.read.parquet(target).select(key).join(rows.select(key), key, "left_semi")
        rows = rows.join(known, key, "left_anti")
    rows.write.mode("append").parquet(target)


def ingest(spark: SparkSession, source: str, schema: StructType, target: str, key: str, checkpoint: str, glob: str = "*.parquet", per_batch: int = 1000) -> StreamingQuery:
    """Process all files that are new since the last run, then stop; an outer scheduler sets the rhythm."""
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).option("pathGlobFilter", glob).parquet(source)
    return files.writeStream.foreachBatch(lambda batch, _: append_new(batch, target, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
