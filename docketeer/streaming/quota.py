"""Document quotas as a keyed state machine over the access stream.

Every browser has one state; events of a browser are taken in order of time.  Each event is refused or passed in this
order: paused, session ended, too fast (more than 50 different documents in the trailing 60 s: the window is emptied,
access pauses and the session ends), already opened that day (passes without charge), daily limit, weekly limit,
batch limit, else it is charged.  An event without a document registers its session: refused while access pauses, and
while a visible check is owed that it doesn't bring (column visible); else all earlier sessions of the browser end, and
a visible check clears the batch.  A browser that never registered may use several sessions.  A day is a UTC day; a week
is seven days with today.

What a browser is charged is put to its address, which opens so many different documents a day; a document that it
refuses is refunded: the browser's day, batch and opened documents are as if it had not been charged.  Events without an
address have no such limit.

The stream runs in micro-batches.  Of each, Spark deals events to tasks by browser and sorts them there by time, the
browser's state before them, so that a task holds one state at a time.  An address takes the first documents put to it,
so what it refuses is known once all its browsers' charges are; as refunds let browsers be charged for more later, both
sides are worked out in turns, from the same states, until the documents that addresses take stay the same.  Each turn
settles all events up to the first that the last one had wrong, so the end is what one event after the other gives; most
batches take two or three turns.  States and decisions are written under the batch's number: a batch that runs again
starts from the same states and writes over itself.

Between micro-batches events are taken as they come.  Browsers idle for IDLE_DAYS of event time, and documents that
addresses opened over ADDRESS_DAYS ago, are forgotten.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from docketeer.operators import quota as limits
from docketeer.sources import files
from docketeer.sources.shared import written

DAY_MS = 86_400_000
#: Days of event time after which idle browsers and addresses are forgotten.
IDLE_DAYS, ADDRESS_DAYS = 8, 2
#: Decisions that a task hands on at once, and rounds after which a batch counts as stuck.
SLICE, MAX_ROUNDS = 10_000, 1000
OUTPUT = "browser_id string, doc_key string, ts_ms long, address string, passed boolean, charged boolean, why string, retry_after long"


@dataclass(frozen=True)
class Limits:
    per_minute: int = limits.PER_MINUTE
    per_check: int = limits.PER_CHECK
    per_day: int = limits.PER_DAY
    per_week: int = limits.PER_WEEK
    per_address: int = limits.PER_ADDRESS_DAY
    pause_s: int = limits.PAUSE_SECONDS


def fresh() -> dict:
    return {"day": -1, "seen": [], "days": {}, "batch": 0, "paused": 0, "window": {}, "ended": [], "visible": False, "current": None}


def step(state: dict, doc: str, session: str, now: int, lim: Limits = Limits()) -> tuple[bool, bool, str, int]:
    """One event: (passed, charged, why, seconds until a retry may pass).  Changes state."""
    day = now // DAY_MS
    if state["day"] != day:
        state["day"], state["seen"] = day, []
    midnight = (day + 1) * DAY_MS
    if state["paused"] > now:
        return False, False, "paused", -(-(state["paused"] - now) // 1000)
    if session in state["ended"] or state.get("current") not in (None, session):
        return False, False, "ended", 0
    window = {k: t for k, t in state["window"].items() if t > now - 60_000}
    window.setdefault(doc, now)
    state["window"] = window
    if len(window) > lim.per_minute:
        state |= {"paused": now + lim.pause_s * 1000, "window": {}, "visible": True}
        state["ended"].append(session)
        return False, False, "fast", lim.pause_s
    if doc in state["seen"]:
        return True, False, "seen", 0
    days = {d: n for d, n in state["days"].items() if int(d) > day - 7 and n > 0}
    state["days"] = days
    if days.get(str(day), 0) >= lim.per_day:
        return False, False, "daily", -(-(midnight - now) // 1000)
    if sum(days.values()) >= lim.per_week:
        wait = next((k for k in range(1, 8) if sum(n for d, n in days.items() if int(d) > day + k - 7) < lim.per_week), 7)
        return False, False, "weekly", -(-(midnight - now) // 1000) + (wait - 1) * 86_400
    if state["batch"] >= lim.per_check:
        state["visible"] = True
        return False, False, "check", 0
    state["batch"] += 1
    state["visible"] = state["visible"] or state["batch"] >= lim.per_check
    days[str(day)] = days.get(str(day), 0) + 1
    state["seen"].append(doc)
    return True, True, "charged", 0


def register(state: dict, session: str, now: int, visible: bool, lim: Limits = Limits()) -> tuple[bool, bool, str, int]:
    """A session's registration: (passed, False, why, seconds until a retry may pass).  Changes state."""
    if state["paused"] > now:
        return False, False, "paused", -(-(state["paused"] - now) // 1000)
    if (state["visible"] or state["batch"] >= lim.per_check) and not visible:
        return False, False, "check", 0
    renew(state, session, visible)
    return True, False, "registered", 0


def renew(state: dict, session: str, visible: bool) -> None:
    """A new session: earlier ones end, and a visible check clears the batch."""
    state["ended"], state["current"] = [s for s in state["ended"] if s != session], session
    if visible:
        state |= {"visible": False, "batch": 0}


def refund(state: dict, doc: str, now: int) -> None:
    """Takes back a charge of the same day."""
    day = now // DAY_MS
    if state["day"] != day or doc not in state["seen"]:
        return
    state["seen"].remove(doc)
    if state["days"].get(str(day)):
        state["days"][str(day)] -= 1
    if state["batch"]:
        state["batch"] -= 1


#: The order of events: by time, then document and the rest, so that no two orders are possible but of equal rows.
ORDER = ("ts_ms", "doc_key", "browser_id", "session_id", "seq")
_MADE = f"{OUTPUT}, session_id string, seq long, asked boolean, state string, last long"


def _decide(events: DataFrame, browsers: DataFrame, lim: Limits) -> DataFrame:
    """_MADE rows of events (with refuse: whether the address would refuse the document) and of every browser's state."""
    empty = {"doc_key": "string", "session_id": "string", "visible": "boolean", "address": "string", "seq": "bigint", "refuse": "boolean"}
    states = browsers.select("browser_id", F.lit(0).alias("kind"), F.col("last").alias("ts_ms"), *(F.lit(None).cast(t).alias(c) for c, t in empty.items()), "state")
    rows = events.select("browser_id", F.lit(1).alias("kind"), "ts_ms", *empty, F.lit(None).cast("string").alias("state")).unionByName(states)
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in _MADE.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        browser, held, last, out = None, None, 0, []
        ended = lambda: {"browser_id": browser, "state": json.dumps(held), "last": last}
        for r in (row for batch in batches for row in batch.to_pylist()):
            if held is None or r["browser_id"] != browser:
                if held is not None:
                    out.append(ended())
                browser, held, last = r["browser_id"], fresh(), 0
            now, doc = r["ts_ms"], r["doc_key"]
            last = max(last, now)
            if r["kind"] == 0:
                held = json.loads(r["state"])
                continue
            asked = False
            if doc is None:
                passed, charged, why, wait = register(held, r["session_id"], now, bool(r["visible"]), lim)
            else:
                passed, charged, why, wait = step(held, doc, r["session_id"], now, lim)
                asked = charged and r["address"] is not None
                if asked and r["refuse"]:
                    refund(held, doc, now)
                    passed, charged, why, wait = False, False, "address", -(-((now // DAY_MS + 1) * DAY_MS - now) // 1000)
            out.append(r | {"passed": passed, "charged": charged, "why": why, "retry_after": wait, "asked": asked, "state": None})
            if len(out) >= SLICE:
                yield pa.RecordBatch.from_pylist([{name: o.get(name) for name in schema.names} for o in out], schema=schema)
                out = []
        if held is not None:
            out.append(ended())
        yield pa.RecordBatch.from_pylist([{name: o.get(name) for name in schema.names} for o in out], schema=schema)

    order = [F.col("kind"), *(F.asc_nulls_first(c) for c in ORDER)]
    return rows.repartition("browser_id").sortWithinPartitions("browser_id", *order).mapInArrow(run, _MADE)


def _taken(asked: DataFrame, opened: DataFrame, limit: int) -> DataFrame:
    """(address, day, doc_key): documents that addresses take: those opened before, and the first ones put to them."""
    first = asked.groupBy("address", "day", "doc_key").agg(F.min(F.struct(*ORDER)).alias("first")).join(opened, ["address", "day", "doc_key"], "left_anti")
    place = F.row_number().over(Window.partitionBy("address", "day").orderBy("first"))
    held = opened.groupBy("address", "day").agg(F.count("*").alias("held"))
    ranked = first.withColumn("place", place).where(F.col("place") <= limit).join(held, ["address", "day"], "left")
    return opened.unionByName(ranked.where(F.col("place") + F.coalesce("held", F.lit(0)) <= limit).select("address", "day", "doc_key"))


def _day(ts: str = "ts_ms") -> Column:
    return F.floor(F.col(ts) / DAY_MS).cast("long")


def decide(events: DataFrame, browsers: DataFrame, opened: DataFrame, lim: Limits = Limits()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(decisions, browsers, opened) of a batch of events, from the states before it; all are written.

    events: browser_id, session_id, doc_key, ts_ms, and perhaps visible, address and seq.  browsers: browser_id, state,
    last.  opened: address, day, doc_key."""
    optional = {"visible": "boolean", "address": "string", "seq": "bigint"}
    batch = written(events.select("browser_id", "session_id", "doc_key", "ts_ms", *((F.col(c) if c in events.columns else F.lit(None)).cast(t).alias(c) for c, t in optional.items())).withColumn("day", _day()), "batch")
    taken, seen = opened, None
    for _ in range(MAX_ROUNDS):
        full = taken.groupBy("address", "day").agg(F.count("*").alias("n")).where(F.col("n") >= lim.per_address).select("address", "day", F.lit(True).alias("full"))
        there = taken.select("address", "day", "doc_key", F.lit(True).alias("there"))
        flagged = batch.join(full, ["address", "day"], "left").join(there, ["address", "day", "doc_key"], "left").withColumn("refuse", F.col("full").isNotNull() & F.col("there").isNull())
        made = written(_decide(flagged, browsers, lim), "decided")
        taken = written(_taken(made.where("asked").withColumn("day", _day()), opened, lim.per_address), "taken")
        now = taken.agg(F.count("*"), F.sum(F.xxhash64("address", "day", "doc_key").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    else:
        raise RuntimeError(f"the batch did not settle in {MAX_ROUNDS} rounds")
    newest = made.agg(F.max("last")).first()[0] or 0
    kept = made.where(F.col("state").isNotNull() & (F.col("last") > newest - IDLE_DAYS * DAY_MS)).select("browser_id", "state", "last")
    return made.where("state IS NULL").select(*(field.split()[0] for field in OUTPUT.split(", "))), kept, taken.where(F.col("day") > newest // DAY_MS - ADDRESS_DAYS)


_STATES = {"browsers": "browser_id string, state string, last long", "opened": "address string, day long, doc_key string"}


def charge(stream: DataFrame, target: str, checkpoint: str, lim: Limits = Limits()) -> StreamingQuery:
    """Start deciding on all events of the stream that are there now; decisions() reads what came of it."""

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = max((n for n in map(int, files.folders(spark, f"{target}/states")) if n < number), default=None)
        held = [spark.read.schema(ddl).parquet(f"{target}/states/{before}/{name}") if before is not None else spark.createDataFrame([], ddl) for name, ddl in _STATES.items()]
        made, *states = decide(batch, *held, lim)
        for name, rows in zip(_STATES, states, strict=True):
            rows.write.mode("overwrite").parquet(f"{target}/states/{number}/{name}")
        made.write.mode("overwrite").parquet(f"{target}/decisions/batch={number}")
        for old in map(int, files.folders(spark, f"{target}/states")):
            if before is not None and old < before:
                files.delete(spark, f"{target}/states/{old}")

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def decisions(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(OUTPUT).parquet(f"{target}/decisions")
