"""Folders of whatever file system a path names, by Hadoop's own client: existence, sizes, a whole folder put in place."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _client(spark: SparkSession, path: str):
    """(file system, path) objects."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    client, place = _client(spark, path)
    return client.exists(place)


def sizes(spark: SparkSession, path: str, suffix: str = "") -> dict[str, int]:
    """Name and bytes of each file right in the folder, if its name ends in suffix."""
    client, place = _client(spark, path)
    if not client.exists(place):
        return {}
    return {s.getPath().getName(): s.getLen() for s in client.listStatus(place) if s.isFile() and s.getPath().getName().endswith(suffix)}


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right in the folder, sorted."""
    client, place = _client(spark, path)
    return sorted(s.getPath().getName() for s in client.listStatus(place) if s.isDirectory()) if client.exists(place) else []


def beside(path: str, label: str) -> str:
    return f"{path.rstrip('/')}.{label}-{uuid.uuid4().hex[:8]}"


def put_in_place(spark: SparkSession, new: str, path: str) -> None:
    """Rename new to path.  What was there is first set aside as path.old, from where recover() brings it back."""
    client, place = _client(spark, path)
    old, fresh = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path.rstrip('/')}.old", new))
    if client.exists(place):
        client.delete(old, True)
        if not client.rename(place, old):
            raise OSError(f"{path} can't be set aside")
    if not client.rename(fresh, place):
        recover(spark, path)
        raise OSError(f"{new} can't be renamed to {path}")
    client.delete(old, True)


def recover(spark: SparkSession, path: str) -> None:
    """Bring back what put_in_place() had set aside when it was cut off before the new folder was there."""
    client, place = _client(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old")
    if client.exists(old) and not client.exists(place):
        client.rename(old, place)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file; one that is there stays."""
    client, place = _client(spark, path)
    client.createNewFile(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that it holds."""
    client, place = _client(spark, path)
    client.delete(place, True)
