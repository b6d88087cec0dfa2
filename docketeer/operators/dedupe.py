"""Row identity across sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.sources.shared import written


def digest(key: Column) -> Column:
    """A digest of a key; null has its own."""
    return F.sha2(F.concat(F.when(key.isNull(), "n").otherwise("v"), F.coalesce(key.cast("string"), F.lit(""))), 256)


def first_source_wins(rows: DataFrame, key: Column, source_order: str) -> DataFrame:
    """Rows of each key's first source, all of them: repeats inside one source stay, later sources lose theirs.

    The first source of a key comes from an aggregation that combines before the shuffle, so that a key of many rows is
    one row there.  It is written before it is joined back: only where both sides are plain shuffles does Spark split a
    key that holds many rows.  Digests are compared, and texts move once.  The key is made twice: one that is costly
    should be a column of a written table.
    """
    keyed = rows.withColumn("__key", digest(key))
    first = written(keyed.groupBy("__key").agg(F.min(source_order).alias("__first")), "first-sources")
    return keyed.join(first, "__key").where(F.col(source_order) == F.col("__first")).select(rows.columns)


def new_rows(rows: DataFrame, existing: DataFrame, key: Column, existing_key: Column, ruling_id: str = "ruling_id") -> DataFrame:
    """Rows whose id and key the warehouse lacks."""
    digest = lambda k: F.sha2(F.to_json(F.struct(k.alias("k"))), 256)
    known = existing.select(digest(existing_key).alias("__key")).distinct()
    fresh = rows.withColumn("__key", digest(key)).join(known, "__key", "left_anti")
    return fresh.join(existing.select(ruling_id).distinct(), ruling_id, "left_anti").select(rows.columns)


def key_groups(rows: DataFrame, key: Column, ident: str) -> DataFrame:
    """Each key's smallest id and number of rows."""
    return rows.groupBy(key.alias("key")).agg(F.min(ident).alias("first_id"), F.count("*").alias("n_rows"))


def id_conflicts(rows: DataFrame, ident: str, *text: str) -> DataFrame:
    """Ids whose rows differ in text."""
    hashed = rows.select(ident, F.sha2(F.to_json(F.struct(*text)), 256).alias("h"))
    return hashed.groupBy(ident).agg(F.min("h").alias("a"), F.max("h").alias("b"), F.count("*").alias("n_rows")).where("a <> b").select(ident, "n_rows")
