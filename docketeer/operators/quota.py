"""Access limits over finished logs, as windows (the streaming form is docketeer.streaming.quota)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Documents a minute, a batch, a day and a week; an address's a day; sessions an hour; trips a day; requests a minute.
PER_MINUTE, PER_CHECK, PER_DAY, PER_WEEK, PER_ADDRESS_DAY, SESSIONS_PER_HOUR, TRIPS, REQUESTS_PER_MINUTE = 50, 100, 500, 1000, 2000, 30, 3, 300
PAUSE_SECONDS = 600


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a column without time zone (or in the session's)."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({ts} as timestamp_ntz))")


def trailing_count(events: DataFrame, key: str, ts: str, seconds: int, name: str = "n") -> DataFrame:
    """Events of the key in the seconds up to each one; the lower bound is exclusive."""
    frame = Window.partitionBy(key).orderBy(micros(ts)).rangeBetween(-(seconds * 1_000_000 - 1), 0)
    return events.withColumn(name, F.count("*").over(frame))


def first_opens(events: DataFrame, key: str, document: Column, ts: str, ident: str) -> DataFrame:
    """events plus day and charged: whether it is the key's first opening of the document that UTC day."""
    dated = events.withColumn("day", F.to_date(ts)).withColumn("__doc", document)
    place = Window.partitionBy(key, "day", "__doc").orderBy(ts, ident)
    return dated.withColumn("charged", F.row_number().over(place) == 1).drop("__doc")


def rolling_days(daily: DataFrame, key: str, day: str, n: str, days: int = 7, name: str = "n_week") -> DataFrame:
    """Sums over the days up to each one, itself included."""
    frame = Window.partitionBy(key).orderBy(F.unix_date(day)).rangeBetween(-(days - 1), 0)
    return daily.withColumn(name, F.sum(n).over(frame))


def retry_after_days(daily: DataFrame, key: str, day: str, n: str, limit: int, days: int = 7) -> DataFrame:
    """Of each key and day how many days later the rolling sum, without new opens, is below the limit."""
    later = daily.select(key, day, F.explode(F.sequence(F.lit(1), F.lit(days))).alias("k"))
    sums = later.alias("l").join(daily.select(F.col(key).alias("__key"), F.col(day).alias("__day"), F.col(n).alias("__n")).alias("d"), (F.col(f"l.{key}") == F.col("__key")) & (F.col("__day") <= F.col(f"l.{day}")) & (F.col("__day") > F.date_add(F.col(f"l.{day}"), F.col("k") - days)), "left")
    per = sums.groupBy(key, day, "k").agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("left"))
    return per.where(F.col("left") < limit).groupBy(key, day).agg(F.min("k").alias("days_to_wait"))


def tumbling_over(events: DataFrame, key: str, ts: str, width: str, limit: int) -> DataFrame:
    """Windows of a key with more than limit events."""
    counted = events.groupBy(key, F.window(ts, width).alias("w")).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > limit).select(key, F.col("w.start").alias("window_start"), "n")
