"""The status of harvest runs: a keyed snapshot that a log of commands moves on, with checked transitions.

A run starts, captures, and is parsed.  start is always allowed and begins a run; capture only counts as the first after
a start; parse only as the first after such a capture.  Other commands change nothing and are reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketeer.functions.text import blank
from docketeer.sources.shared import written


def judged(events: DataFrame, key: str, order: str, command: str = "command") -> DataFrame:
    """events plus run (number of starts of the key so far) and problem: why a command doesn't count, else null.

    One window over a key's events; what a command may do depends on counts since the last start alone, so no row
    waits for another's verdict."""
    by_key = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    by_run = Window.partitionBy(key, "run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    is_ = lambda name: F.count_if(F.col(command) == name)
    counted = events.withColumn("run", is_("start").over(by_key)).withColumn("__captures", is_("capture").over(by_run))
    after = F.count_if((F.col(command) == "parse") & (F.col("__captures") > 0)).over(by_run)
    marked = counted.withColumn("__parses", after)
    problem = (
        F.when(~F.coalesce(F.col(command).isin("start", "capture", "parse"), F.lit(False)), "unknown command")
        .when(F.col("run") == 0, "not started")
        .when((F.col(command) == "capture") & (F.col("__captures") > 1), "captured already")
        .when((F.col(command) == "parse") & (F.col("__captures") == 0), "not captured")
        .when((F.col(command) == "parse") & (F.col("__parses") > 1), "parsed already")
    )
    return marked.withColumn("problem", problem).drop("__captures", "__parses")


def snapshot(events: DataFrame, key: str, order: str, command: str = "command", ok: str = "ok", at: str = "at") -> DataFrame:
    """(key, run, stage, capture, parse, started_at, captured_at, finished_at, n_rejected): each key's last run.

    ok tells whether a capture or parse went well; n_rejected counts commands since the first start that didn't count.
    Keys that never started have no snapshot."""
    rows = judged(events, key, order, command)
    good = F.col("problem").isNull()
    when = lambda name, c: F.max(F.when(good & (F.col(command) == name), F.col(c)))
    runs = rows.groupBy(key, "run").agg(
        when("start", at).alias("started_at"), when("capture", at).alias("captured_at"), when("parse", at).alias("finished_at"),
        when("capture", ok).alias("__captured"), when("parse", ok).alias("__parsed"), F.count_if(~good).alias("n_rejected"))
    last = runs.groupBy(key).agg(F.max_by(F.struct(*(c for c in runs.columns if c != key)), "run").alias("r"), F.sum(F.when(F.col("run") > 0, F.col("n_rejected")).otherwise(0)).alias("n_rejected"))
    word = lambda c, none: F.when(F.col(c).isNull(), none).when(F.col(c), "ok").otherwise("failed")
    stage = F.when(F.col("r.__parsed").isNotNull(), "done").when(F.col("r.__captured").isNull(), "capturing").when(F.col("r.__captured"), "captured").otherwise("failed")
    return last.where("r.run > 0").select(key, "r.run", stage.alias("stage"), word("r.__captured", "running").alias("capture"), word("r.__parsed", "pending").alias("parse"), "r.started_at", "r.captured_at", "r.finished_at", "n_rejected")


def upserted(status: DataFrame | None, events: DataFrame, key: str, order: str, **names: str) -> DataFrame:
    """The status table after more events: keys that start again are replaced, others go on where they were.

    A run that goes on is replayed from what the table holds of it, so that batches give what the whole log gives."""
    if status is None:
        return snapshot(events, key, order, **names)
    command, ok, at = (names.get(n, n) for n in ("command", "ok", "at"))
    told = F.array(
        F.struct(F.lit("start").alias("c"), F.lit(None).cast("boolean").alias("ok"), F.col("started_at").alias("at"), F.lit(-3).alias("o")),
        F.struct(F.lit("capture").alias("c"), (F.col("capture") == "ok").alias("ok"), F.col("captured_at").alias("at"), F.lit(-2).alias("o")),
        F.struct(F.lit("parse").alias("c"), (F.col("parse") == "ok").alias("ok"), F.col("finished_at").alias("at"), F.lit(-1).alias("o")),
    )
    known = F.filter(told, lambda x: (x["c"] == "start") | ((x["c"] == "capture") & (F.col("capture") != "running")) | ((x["c"] == "parse") & (F.col("parse") != "pending")))
    before = status.select(key, F.explode(known).alias("e")).select(key, F.col("e.c").alias(command), F.col("e.ok").alias(ok), F.col("e.at").alias(at), F.struct(F.lit(0).alias("part"), F.col("e.o").cast("long").alias("o")).alias("__order"))
    more = events.select(key, command, ok, at, F.struct(F.lit(1).alias("part"), F.col(order).cast("long").alias("o")).alias("__order"))
    moved = snapshot(before.unionByName(more), key, "__order", command, ok, at)
    base = status.select(key, (F.col("run") - 1).alias("__runs"), F.col("n_rejected").alias("__rejected"))
    joined = moved.join(base, key, "left").withColumn("run", F.col("run") + F.coalesce("__runs", F.lit(0))).withColumn("n_rejected", F.col("n_rejected") + F.coalesce("__rejected", F.lit(0)))
    return written(joined.select(moved.columns), "status")


def productive(results: DataFrame, key: str, day: str, refs: str = "refs", pages: str = "pages") -> DataFrame:
    """results plus last_productive: the last day up to each row's own on which the key had references or pages; and
    before: that of the row before."""
    found = (F.coalesce(F.col(refs), F.lit(0)) > 0) | (F.coalesce(F.col(pages), F.lit(0)) > 0)
    order = Window.partitionBy(key).orderBy(day)
    out = results.withColumn("last_productive", F.last(F.when(found, F.col(day)), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("before", F.lag("last_productive").over(order))


# Statuses of files that are gone for good.
GONE = (404, 410)


def recheck(skipped: Column, exception: Column, failures: Column, refs: Column, pages: Column, before: Column, today: Column, days: int = 14) -> Column:
    """Why a county should be tried again, or null: an exception; a failed discovery; the first failed fetch that isn't
    of a file gone for good; nothing captured though it was productive at most `days` ago.

    failures: lines of the run's log, of which those that start with ERROR count."""
    errors = F.filter(F.coalesce(failures, F.array().cast("array<string>")), lambda x: F.startswith(x, F.lit("ERROR")))
    discovery = F.get(F.filter(errors, lambda x: F.contains(x, F.lit("discovery"))), F.lit(0))
    gone = lambda x: F.coalesce(F.regexp_extract(x, r"\b([1-5][0-9]{2}) (?:Client|Server) Error", 1).isin(*map(str, GONE)), F.lit(False))
    fetch = F.get(F.filter(errors, lambda x: ~gone(x)), F.lit(0))
    nothing = (F.coalesce(refs, F.lit(0)) == 0) & (F.coalesce(pages, F.lit(0)) == 0)
    return (
        F.when(blank(skipped) != "", F.lit(None).cast("string"))
        .when(exception.isNotNull(), F.concat(F.lit("error: "), F.left(exception, F.lit(200))))
        .when(discovery.isNotNull(), F.concat(F.lit("discovery: "), F.left(discovery, F.lit(200))))
        .when(fetch.isNotNull(), F.concat(F.lit("fetch: "), F.left(fetch, F.lit(200))))
        .when(nothing & (F.datediff(today, before) <= days), F.concat(F.lit("captured nothing; last captured "), F.date_format(before, "yyyy-MM-dd")))
    )
