"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a new folder in local mode where that is unset."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="docketeer-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, *partitions: str, **options) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, and losing executors costs nothing."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.options(**options).partitionBy(*partitions).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
