"""Streams against plain models."""

import random

from docketeer.plans import stream_queries
from docketeer.plans.registry import QUERIES
from docketeer.streaming import quota, windows
from tests.conftest import DATA


def model(events, lim):
    """Each event after the other: browsers by the steps, addresses by what they have opened, refunds at once."""
    states, opened, out = {}, {}, []
    key = lambda e: tuple((v is not None, v) for v in (e["ts_ms"], e["doc_key"], e["browser_id"], e["session_id"], e.get("seq")))
    for e in sorted(events, key=key):
        state, now = states.setdefault(e["browser_id"], quota.fresh()), e["ts_ms"]
        if e["doc_key"] is None:
            passed, charged, why, _ = quota.register(state, e["session_id"], now, bool(e.get("visible")), lim)
        else:
            passed, charged, why, _ = quota.step(state, e["doc_key"], e["session_id"], now, lim)
        if charged and e.get("address") is not None:
            docs = opened.setdefault((e["address"], now // quota.DAY_MS), set())
            if e["doc_key"] not in docs and len(docs) >= lim.per_address:
                day = str(now // quota.DAY_MS)
                state["days"][day] -= 1
                state["batch"] -= 1
                state["seen"].remove(e["doc_key"])
                passed, charged, why = False, False, "address"
            else:
                docs.add(e["doc_key"])
        out.append((e["browser_id"], e["doc_key"], now, passed, charged, why))
    return sorted(out, key=str)


def told(df):
    return sorted(((r["browser_id"], r["doc_key"], r["ts_ms"], r["passed"], r["charged"], r["why"]) for r in df.collect()), key=str)


def test_quota_stream_equals_the_steps(spark):
    events = [r.asDict() for r in stream_queries.access_events(spark.read.parquet(f"{DATA}/events.parquet")).collect()]
    expected = model(events, stream_queries.SMALL)
    assert told(QUERIES["stream_quota"](spark, DATA)) == expected and {"address", "daily", "seen"} <= {r[-1] for r in expected}


def random_events(seed, n):
    """Few browsers that share few addresses, now and then without one, over three days, with registrations."""
    rng = random.Random(seed)
    start = 20_000 * quota.DAY_MS
    out = []
    for i in range(n):
        doc = None if rng.random() < 0.05 else f"d{rng.randrange(40)}"
        out.append({"browser_id": f"b{rng.randrange(6)}", "session_id": f"s{rng.randrange(2)}", "doc_key": doc, "ts_ms": start + rng.randrange(3 * quota.DAY_MS // 20_000) * 20_000, "visible": rng.random() < 0.5, "address": rng.choice(["a0", "a1", None]), "seq": i})
    return out


EVENTS = "browser_id string, session_id string, doc_key string, ts_ms long, visible boolean, address string, seq long"


def test_refunds_equal_the_steps(spark, tmp_path):
    """Refunds let browsers open more later, at addresses that refuse again; also in several batches, and again."""
    lim = quota.Limits(per_minute=50, per_check=25, per_day=12, per_week=30, per_address=9)
    events = random_events(1, 600)
    expected = model(events, lim)
    assert sum(r[-1] == "address" for r in expected) > 50 and {"daily", "check", "registered", "weekly"} <= {r[-1] for r in expected}
    ordered = sorted(events, key=lambda e: e["ts_ms"])
    cuts = [0, 200, 420, 600]
    moved = [next(k for k in range(c, 601) if k in (0, 600) or ordered[k]["ts_ms"] != ordered[k - 1]["ts_ms"]) for c in cuts]
    names = [c.split()[0] for c in EVENTS.split(", ")]
    for i, (a, b) in enumerate(zip(moved, moved[1:], strict=False)):
        spark.createDataFrame([tuple(e[n] for n in names) for e in ordered[a:b]], EVENTS).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{i}"))
    stream = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    quota.charge(stream(), str(tmp_path / "out"), str(tmp_path / "p"), lim).awaitTermination()
    assert told(quota.decisions(spark, str(tmp_path / "out"))) == expected
    last = tmp_path / "p" / "commits" / "2"
    last.unlink()
    (tmp_path / "p" / "commits" / ".2.crc").unlink(missing_ok=True)
    quota.charge(stream(), str(tmp_path / "out"), str(tmp_path / "p"), lim).awaitTermination()
    assert told(quota.decisions(spark, str(tmp_path / "out"))) == expected
    assert sorted(p.name for p in (tmp_path / "out" / "states").iterdir()) == ["1", "2"]


def test_idle_states_go(spark):
    lim, day = quota.Limits(), 20_000
    rows = lambda *r: spark.createDataFrame([(b, "s", "d", (day + d) * quota.DAY_MS, None, "a", 0) for b, d in r], EVENTS)
    none = [spark.createDataFrame([], ddl) for ddl in quota._STATES.values()]
    made, browsers, opened = quota.decide(rows(("x", 0), ("y", 3)), *none, lim)
    assert made.count() == 2 and {r["browser_id"] for r in browsers.collect()} == {"x", "y"} and [r["day"] for r in opened.collect()] == [day + 3]
    _, browsers, opened = quota.decide(rows(("y", 9)), browsers, opened, lim)
    assert {r["browser_id"] for r in browsers.collect()} == {"y"} and [r["day"] for r in opened.collect()] == [day + 9]
    assert [d.count() for d in quota.decide(rows().where("false"), browsers, opened, lim)] == [0, 1, 1]


def test_each_user_is_a_browser(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    assert stream_queries.access_events(events).select("browser_id").distinct().count() == events.select("user_id").distinct().count()


def test_steps():
    lim = quota.Limits(per_minute=50, per_check=100, per_day=500, per_week=1000)
    state = quota.fresh()
    whys = [quota.step(state, f"d{i}", "s", i * 100, lim)[2] for i in range(51)]
    assert whys[:50] == ["charged"] * 50 and whys[50] == "fast"
    assert quota.step(state, "d0", "s", 6_000, lim)[2] == "paused"
    assert quota.step(state, "d0", "s", 700_000, lim)[2] == "ended"
    assert quota.step(state, "d0", "t", 700_000, lim)[2] == "seen"
    state = quota.fresh()
    slow = [quota.step(state, f"d{i}", "s", i * 2000, lim)[2] for i in range(101)]
    assert slow[99] == "charged" and slow[100] == "check"
    quota.renew(state, "n", True)
    assert quota.step(state, "x", "n", 300_000, lim)[2] == "charged"
    lim = quota.Limits(per_minute=50, per_check=10_000, per_day=3, per_week=4)
    state = quota.fresh()
    days = [quota.step(state, f"e{i}", "s", i * 60_000, lim)[2] for i in range(4)]
    assert days == ["charged"] * 3 + ["daily"]
    assert quota.step(state, "f", "s", quota.DAY_MS + 5, lim)[2] == "charged"
    passed, _, why, wait = quota.step(state, "g", "s", quota.DAY_MS + 90_000, lim)
    assert not passed and why == "weekly" and wait > 5 * 86_400


def test_windows_plan(spark):
    stream = spark.readStream.schema("address string, ts timestamp").parquet(f"{DATA}")
    assert windows.flood_guard(stream).isStreaming and windows.session_cap(stream).isStreaming


def test_ingest_fails_closed(spark, tmp_path):
    """A target that is there but can't be read isn't taken for an empty one."""
    import pytest

    from docketeer.streaming import ingest

    target = tmp_path / "target"
    ingest.append_new(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string"), str(target), "k")
    ingest.append_new(spark.createDataFrame([(2, "b"), (3, "c")], "k long, v string"), str(target), "k")
    assert sorted(map(tuple, spark.read.parquet(str(target)).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("not a parquet file")
    with pytest.raises(Exception):  # noqa: B017  whatever Spark raises for a file that it can't read
        ingest.append_new(spark.createDataFrame([(1, "a")], "k long, v string"), str(bad), "k")
    assert sorted(p.name for p in bad.iterdir()) == ["part-0.parquet"]


def test_registration_in_the_stream(spark, tmp_path):
    """A batch limit ends at a registration with a visible check, not at one without; older sessions end."""
    lim = quota.Limits(per_minute=50, per_check=2, per_day=100, per_week=100)
    day = 20_000 * quota.DAY_MS
    events = [("s1", "a", None), ("s1", "b", None), ("s1", "c", None), ("s2", None, False), ("s2", None, True), ("s2", "c", None), ("s1", "d", None), ("s2", "d", None)]
    rows = [("u", s, d, day + i * 2000, v) for i, (s, d, v) in enumerate(events)]
    schema = "browser_id string, session_id string, doc_key string, ts_ms long, visible boolean"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    quota.charge(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "progress"), lim).awaitTermination()
    found = [(r["why"], r["passed"]) for r in quota.decisions(spark, str(tmp_path / "out")).orderBy("ts_ms").collect()]
    assert found == [("charged", True), ("charged", True), ("check", False), ("check", False), ("registered", True), ("charged", True), ("ended", False), ("charged", True)]
    state = quota.fresh()
    state["paused"] = 5000
    assert quota.register(state, "s", 1000, True) == (False, False, "paused", 4)
