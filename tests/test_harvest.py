"""Walks, sweeps, page changes, run status, checked joins and batched appends against plain Python."""

import datetime as dt
import json
import random

import duckdb
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from docketeer.operators import captures, codes, status, sweeps, view, walk
from docketeer.plans import harvest_queries
from docketeer.plans.registry import ORACLE_SQL, QUERIES, Tables
from docketeer.streaming import batches
from tests.conftest import DATA


def test_walk_equals_breadth_first_search(spark):
    rng = random.Random(4)
    edges = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(70)})
    roots = [(0, "a"), (1, None), (0, "b")]
    df = spark.createDataFrame([(a, b, f"n{b}") for a, b in edges] + [(None, 3, "x"), (5, None, "y")], "parent int, child int, name string")
    found = {r["node"]: (r["depth"], tuple(r["path"])) for r in walk.walk(spark.createDataFrame(roots, "node int, label string"), df, 3).collect()}
    level, seen = {0: ("a",), 1: ("1",)}, {}
    for depth in range(4):
        seen |= {n: (depth, p) for n, p in level.items()}
        onward = {}
        for n, p in level.items():
            for a, b in edges:
                if a == n and b not in seen:
                    onward[b] = min(onward.get(b, (*p, f"n{b}")), (*p, f"n{b}"))
        level = onward
    assert found == seen
    assert walk.walk(spark.createDataFrame([], "node int, label string"), df).count() == 0


def test_folder_items_and_likely_rulings(spark):
    items = [["id1", ["p"], "a [b], c.pdf", "application/pdf", 1], [["id2", None, "Sub \"x\"", "folder"], "x"], ["id1", ["p"], "a [b], c.pdf", "application/pdf", 1]]
    escaped = "".join(f"\\x{ord(c):02x}" if c in '"[]{}=/&\'<>' else c for c in json.dumps(items))
    page = f"<script>window['_DRIVE_ivd'] = '{escaped}'; other</script>"
    row = spark.createDataFrame([(page,), ("none",), (None,)], "h string").select(walk.folder_items(F.col("h")).alias("i")).collect()
    assert [tuple(x)[::2] for x in row[0]["i"]] == [("id1", "application/pdf"), ("id2", "folder")] and row[0]["i"][0]["name"] == "a [b], c.pdf"
    assert row[1]["i"] == row[2]["i"] == []
    cases = [("Tentative 6-3.pdf", ["x"], True), ("a.pdf", ["Probate Notes"], True), ("rulings.docx", [], False), ("Ruling Guidelines.pdf", [], False), ("law & motion.PDF", [], True), ("menu.pdf", ["x"], False), (None, None, False)]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "n string, f array<string>")
    assert [r[0] for r in df.select(walk.likely_ruling(F.col("n"), F.col("f"))).collect()] == [c for *_, c in cases]


def test_date_answers(spark):
    first, last = sweeps.around(F.lit("2024-03-01").cast("date"), 7, 14)
    asked = sweeps.dates(spark, first, last, "https://a/date?date={day}")
    assert asked.count() == 22 and asked.agg(F.min("day"), F.max("day")).first() == (dt.date(2024, 2, 23), dt.date(2024, 3, 15))
    rows = [{"caseId": 7, "documentId": 9, "caseNumber": "24 CV/1", "department": "Department 13A"}, {"caseId": 7}, {"documentId": 1}, "odd", {"caseId": "8", "documentVersionId": "v", "description": "D"}, {"caseId": 9, "documentId": 0}]
    bodies = {"2024-03-01": json.dumps({"data": rows}), "2024-03-02": "[]", "2024-03-03": "no json", "2024-03-04": json.dumps({"data": "x"}), "2024-03-05": None, "2024-06-01": json.dumps({"data": rows})}
    answers = spark.createDataFrame([(f"https://a/date?date={d}", b) for d, b in bodies.items()], "request string, body string")
    found = sorted(tuple(r)[1:] for r in sweeps.answered_refs(asked, answers, "https://a").collect())
    assert found == [
        ("https://a/7/doc/9", "2024-03-01-24-CV-1-9.pdf", "13A", "Tentative Ruling", "https://a/date?date=2024-03-01"),
        ("https://a/8/doc/v", "2024-03-01-case-v.pdf", None, "D", "https://a/date?date=2024-03-01"),
    ]


def test_form_answers_and_choices(spark):
    asked = spark.createDataFrame([(dt.date(2024, 3, 1), "r1"), (dt.date(2024, 3, 2), "r2")], "day date, request string")
    answers = spark.createDataFrame([("r1", '<a href="/ViewFile?id=12">a</a><a href="/ViewFile?id=3&x">b</a><a href="/ViewFile?id=12">c</a>'), ("r2", None)], "request string, body string")
    found = sorted((r["id"], r["url"], r["filename"]) for r in sweeps.form_refs(asked, answers, r'href="(/ViewFile\?id=([0-9]+)[^"]*)"', "https://v", "ventura").collect())
    assert found == [("12", "https://v/ViewFile?id=12", "ventura-2024-03-01-12.pdf"), ("3", "https://v/ViewFile?id=3&x", "ventura-2024-03-01-3.pdf")]
    page = '<select name="judge"><option value="10">A</option><option value="x"><option value="9"></select><option value="77"><a href="?judge=100&amp;x&page=3">'
    df = spark.createDataFrame([(page, "u?a=1"), ("", "u"), (None, "n"), ("?page=99999999999", "v")], "html string, url string")
    assert [r[0] for r in df.select(sweeps.choices(F.col("html"), "judge")).collect()] == [["9", "10", "100"], [], [], []]
    assert [r[0] for r in df.select(sweeps.last_page(F.col("html"))).collect()] == [3, 0, 0, 25]
    assert sorted(r["request"] for r in sweeps.page_requests(df.where("url <> 'v'")).collect()) == ["u?a=1&page=1", "u?a=1&page=2", "u?a=1&page=3"]
    text = r'x \\\\/document\\/a.b \\u002Fdocument\/c-1 /document/a.b'
    assert spark.createDataFrame([(text,)], "h string").select(sweeps.calendar_paths(F.col("h"))).first()[0] == ["/document/a.b", "/document/c-1"]


def test_page_state_is_carried(spark):
    none = (spark.createDataFrame([], "url string, sha256 string, etag string, last_modified string, index_row string, gone boolean"), spark.createDataFrame([], "url string, content_key string"))
    fields = "url string, final boolean, index_row string, etag string, last_modified string, gone boolean, sha256 string, content_key string"
    batch = lambda *rows: spark.createDataFrame(list(rows), fields)
    said = lambda df: {r["url"]: r["decision"] for r in df.collect()}
    one, state, latest = captures.merge_pages(batch(("a", True, None, "e1", None, False, "s1", "k1"), ("b", False, "r", None, None, False, "s2", "k2"), ("c", None, None, None, None, True, None, None)), *none)
    assert said(one) == {"a": "stored", "b": "stored", "c": "gone"}
    two, state, latest = captures.merge_pages(batch(("a", False, None, "e2", None, False, "s3", "k1"), ("b", False, "r", "z", None, False, "s4", "other")), state, latest)
    assert said(two) == {"a": "unchanged", "b": "index"}
    held = {r["url"]: tuple(r)[1:] for r in state.collect()}
    assert held == {"a": ("s3", "e2", None, None, False), "b": ("s2", None, None, "r", False), "c": (None, None, None, None, True)}
    three, state, latest = captures.merge_pages(batch(("a", None, None, "e2", None, False, "s9", "k9"), ("b", False, "r2", None, None, False, "s5", "k5"), ("c", False, "q", None, None, False, "s6", "k6")), state, latest)
    assert said(three) == {"a": "not_modified", "b": "stored", "c": "stored"}
    assert {r["url"]: r["content_key"] for r in latest.collect()} == {"a": "k1", "b": "k5", "c": "k6"}


def test_pages_of_one_address(spark, tmp_path):
    """Pages that share an address, or have none, are decided one by one, as the query's SQL says."""
    rows = [(i, (None, "https://a", f"https://b/{i}")[i % 3 if i < 24 else 1], f"<p>page {i % 5}</p>") for i in range(36)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    found = sorted(tuple(r) for r in QUERIES["page_changes"](spark, str(tmp_path)).collect())
    assert found == sorted(connection.sql(ORACLE_SQL["page_changes"]).fetchall())


def test_state_keeps_one_row_an_address(spark):
    none = (spark.createDataFrame([], "url string, sha256 string, etag string, last_modified string, index_row string, gone boolean"), spark.createDataFrame([], "url string, content_key string"))
    fields = "url string, final boolean, index_row string, etag string, last_modified string, gone boolean, sha256 string, content_key string"
    batch = spark.createDataFrame([("a", False, None, "e1", None, False, "s1", "k1"), ("a", False, None, None, None, True, None, None), ("a", False, None, "e2", None, False, "s2", "k2"), ("b", False, None, None, None, True, None, None)], fields)
    one, state, latest = captures.merge_pages(batch, *none)
    two, state, latest = captures.merge_pages(batch, state, latest)
    assert (one.count(), two.count()) == (4, 4) and sorted(r["decision"] for r in two.where("url = 'a'").collect()) == ["gone", "not_modified", "stored"]
    assert sorted(r["url"] for r in state.collect()) == ["a", "b"] and [tuple(r) for r in latest.collect()] == [("a", "k1")]


def by_hand(events):
    """The status after each key's commands, one by one."""
    out = {}
    for key, command, ok, at in events:
        s = out.get(key)
        if command == "start":
            out[key] = {"run": (s or {"run": 0})["run"] + 1, "stage": "capturing", "capture": "running", "parse": "pending", "times": [at, None, None], "rejected": (s or {"rejected": 0})["rejected"]}
        elif s is None:
            continue
        elif command == "capture" and s["capture"] == "running":
            s |= {"capture": "ok" if ok else "failed", "stage": "captured" if ok else "failed"}
            s["times"][1] = at
        elif command == "parse" and s["capture"] != "running" and s["parse"] == "pending":
            s |= {"parse": "ok" if ok else "failed", "stage": "done"}
            s["times"][2] = at
        else:
            s["rejected"] += 1
    return {k: (s["run"], s["stage"], s["capture"], s["parse"], *s["times"], s["rejected"]) for k, s in out.items()}


def test_status_replays(spark):
    rng = random.Random(7)
    events = [(rng.choice("abcdef"), rng.choice(["start", "capture", "parse", "capture", "parse", "odd"]), rng.random() < 0.6, i) for i in range(150)]
    df = spark.createDataFrame([(i, *e) for i, e in enumerate(events)], "seq int, key string, command string, ok boolean, at int")
    told = lambda d: {r["key"]: tuple(r)[1:] for r in d.collect()}
    assert told(status.snapshot(df, "key", "seq")) == by_hand(events)
    table = None
    for low, high in ((0, 20), (20, 21), (21, 90), (90, 150)):
        table = status.upserted(table, df.where(F.col("seq").between(low, high - 1)), "key", "seq")
        assert told(table) == by_hand(events[:high])
    bad = {r["seq"]: r["problem"] for r in status.judged(df, "key", "seq").collect()}
    assert bad[next(i for i, e in enumerate(events) if e[1] == "odd")] == "unknown command"


def test_productive_and_recheck(spark):
    day = lambda n: dt.date(2024, 1, n)
    rows = [("a", day(1), 2, 0, None), ("a", day(5), 0, 0, None), ("a", day(25), 0, None, None), ("b", day(1), 0, 0, ["ERROR fetch x: 404 Client Error"]), ("b", day(2), 0, 1, ["ERROR fetch x: 404 Client Error", "ERROR fetch y: 500 Server Error"]), ("c", day(1), 0, 0, ["note", "ERROR fetch z: reset", "ERROR in discovery"])]
    df = status.productive(spark.createDataFrame(rows, "county string, day date, refs int, pages int, failures array<string>"), "county", "day")
    out = df.select("county", "day", "last_productive", status.recheck(F.lit(None), F.lit(None).cast("string"), F.col("failures"), F.col("refs"), F.col("pages"), F.col("before"), F.col("day")).alias("why"))
    found = {(r["county"], r["day"].day): (r["last_productive"], r["why"]) for r in out.collect()}
    assert found == {
        ("a", 1): (day(1), None), ("a", 5): (day(1), "captured nothing; last captured 2024-01-01"), ("a", 25): (day(1), None), ("b", 1): (None, None),
        ("b", 2): (day(2), "fetch: ERROR fetch y: 500 Server Error"), ("c", 1): (None, "discovery: ERROR in discovery")}
    assert spark.range(1).select(status.recheck(F.lit("off"), F.lit("x"), F.lit(None).cast("array<string>"), F.lit(0), F.lit(0), F.lit(day(1)), F.lit(day(2)))).first()[0] is None
    assert spark.range(1).select(status.recheck(F.lit(None), F.lit("x" * 300), F.lit(None).cast("array<string>"), F.lit(0), F.lit(0), F.lit(day(1)), F.lit(day(2)))).first()[0] == "error: " + "x" * 200


def test_details_must_be_there_once(spark):
    rows = spark.createDataFrame([("x", "1", "t"), ("x", "2", "u")], "county string, ruling_id string, title string")
    texts = [("x", "1", "one", "T"), ("x", "2", "two", None), ("y", "9", "nobody's", None)]
    details = lambda r: spark.createDataFrame(r, "county string, ruling_id string, body string, title string")
    assert sorted(tuple(r) for r in view.with_details(rows, details(texts)).collect()) == [("x", "1", "one", "T"), ("x", "2", "two", None)]
    for bad, what in ((texts[1:], "no detail for x/1"), ([*texts, texts[0]], "more than one detail for x/1")):
        with pytest.raises(SparkRuntimeException, match=what):
            view.with_details(rows, details(bad)).select("county").collect()


def test_sort_clicks():
    state = view.ViewQuery()
    assert (view.sorted_by(state, "hearing_date").direction, view.sorted_by(state, "dept").direction) == ("asc", "asc")
    assert view.sorted_by(view.sorted_by(state, "dept"), "dept").direction == "desc" and view.sorted_by(view.sorted_by(state, "dept"), "hearing_date").direction == "desc"
    assert view.sorted_by(state, "bogus") == state


def test_batched_appends(spark, tmp_path):
    """Parts of at least five rows; a callback that fails ends the run, and the next one calls it again, once a part."""
    calls, path = [], str(tmp_path / "out")

    def after(rows, number):
        calls.append((number, rows.count()))
        if len(calls) == 2:
            raise RuntimeError("lost")

    for i in range(4):
        spark.createDataFrame([(i * 3 + k,) for k in range(3)], "id int").coalesce(1).write.parquet(str(tmp_path / "in" / f"d{i}"))
    stream = lambda: spark.readStream.schema("id int").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="lost"):
        batches.append(stream(), path, str(tmp_path / "state"), 5, after).awaitTermination()
    assert calls == [(1, 6), (3, 6)] and batches.log(spark, path).count() == 6
    batches.append(stream(), path, str(tmp_path / "state"), 5, after).awaitTermination()
    assert calls[2:] == [(3, 6)] and sorted(r["id"] for r in batches.log(spark, path).collect()) == list(range(12))
    batches.append(stream(), path, str(tmp_path / "state"), 5, after).awaitTermination()
    assert len(calls) == 3 and batches.flush(spark, path, after) is None
    spark.createDataFrame([(99,)], "id int").write.parquet(str(tmp_path / "in" / "d9"))
    batches.append(stream(), path, str(tmp_path / "state"), 5, after).awaitTermination()
    assert len(calls) == 3 and batches.log(spark, path).count() == 12
    assert batches.flush(spark, path, after) > 3 and batches.log(spark, path).count() == 13


def test_written_export(spark, tmp_path):
    rows = spark.createDataFrame([("x", dt.date(2024, 1, 2), "1", 3, '=a"b', "r2", None), ("y", None, None, None, "c", "r1", "J")], "county string, hearing_date date, dept string, ruling_index int, case_title string, ruling_id string, judge_name string")
    counties = spark.createDataFrame([("x", "Ex County", "EX")], "slug string, label string, code string")
    view.write_export(view.export_rows(rows, counties), str(tmp_path / "out"), "hearing_date", "ruling_id")
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*"))).decode()
    lines = whole.split("\r\n")
    assert whole.startswith("\ufeffid,county,dept,judge,") and lines[-1] == "" and len(lines) == 4
    assert lines[1].startswith("Y-000000-D?-?,y,,,,") and lines[2].startswith("EX-240102-D1-3,Ex County,1,,2024-01-02,,\"'=a\"\"b\",")
    view.write_export(rows.limit(0), str(tmp_path / "none"), "hearing_date")
    assert b"".join(p.read_bytes() for p in sorted((tmp_path / "none").glob("part-*"))).decode().count("\r\n") == 1


def chosen_in_order(slugs):
    """One slug after the other, each with the first of its codes that nobody has."""
    used, out = set(), {}
    for slug in sorted(set(slugs), key=lambda x: x.encode()):
        letters = "".join(c for c in slug.upper() if c.isalpha())
        initials = "".join(part[0] for part in slug.split("-") if part).upper()
        base = letters[:3] or "CTY"
        wanted = ([initials] if len(initials) >= 2 else []) + [letters[:n] for n in range(3, min(len(letters), 6) + 1)] + [base] + [f"{base}{n}" for n in range(2, len(slugs) + 9)]
        out[slug] = next(c for c in wanted if c not in used)
        used.add(out[slug])
    return out


def test_unique_codes_equal_choosing_in_order(spark):
    rng = random.Random(12)
    odd = ["los-angeles", "lake-alpine", "la", "l-a", "a", "b", "a-2", "c-u-s-2", "customer-1", "customer-2", "cus", "cus2", "1-2", "12", "9", "--", "", "x-", "la2", "l-a-2"]
    many = [f"customer-{i:03}" for i in range(60)] + ["-".join("".join(rng.choice("ab1") for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    for slugs in (odd, many, odd + many, []):
        df = spark.createDataFrame([(s,) for s in [*slugs, None, *slugs[:3]]], "slug string")
        assert {r["slug"]: r["code"] for r in codes.unique_codes(df).collect()} == chosen_in_order(slugs)


def test_codes_of_the_tables(spark):
    slugs = [r["slug"] for r in harvest_queries.name_slugs(Tables(spark, DATA)).collect()]
    rows = QUERIES["unique_codes"](spark, DATA).collect()
    assert {r["slug"]: r["code"] for r in rows} == chosen_in_order(slugs) and len({r["code"] for r in rows}) == len(rows)
    assert all(r["label"] == " ".join(part.capitalize() for part in r["slug"].split("-")) for r in rows)


def test_volatile_addresses_and_routine_counties(spark):
    known = spark.createDataFrame([("u", None, "h1"), ("u", None, "h1"), ("v", "t", None)], "url string, wayback_ts string, sha256 string")
    refs = [("yolo", "u", None, None), ("yolo", "u", "t", None), ("yolo", "v", "t", None), ("orange", "u", None, "h1"), ("orange", "u", None, "h2"), ("orange", "v", "t", None), (None, "u", None, "x"), ("yolo", None, None, None)]
    found = captures.upload_plan(spark.createDataFrame(refs, "county string, url string, wayback_ts string, sha256 string"), known).collect()
    plans = {tuple(r)[:4]: r["plan"] for r in found}
    assert len(found) == len(refs) and [plans[r] == "already-captured" for r in refs] == [True, False, True, True, False, False, True, False]
    out = captures.routine(spark.createDataFrame([("amador",), ("yolo",)], "county string")).collect()
    assert out[0]["skipped"].startswith("legacy dropdowns") and out[1]["skipped"] is None
