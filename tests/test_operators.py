"""Operators on small tables."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from docketeer.operators import blocks, captures, dedupe, quota, view, warehouse
from docketeer.sources import archive, html, logs, schemas


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_log_reading(spark, tmp_path):
    lines = [{"source_sha256": "a", "source_url": "u1"}, {"source_sha256": "a", "source_url": "u2", "unknown": 1}, {"source_sha256": "b", "source_url": "u3"}]
    (tmp_path / "log.ndjson").write_text("\n".join([json.dumps(lines[0]), "", "{bad", json.dumps(lines[1]), json.dumps(lines[2]), "also bad"]))
    log = logs.read_log(spark, str(tmp_path / "log.ndjson"), schemas.CAPTURE)
    assert log.count() == 3
    assert rows(logs.last_by(log, "source_sha256").select("source_sha256", "source_url")) == [("a", "u2"), ("b", "u3")]
    assert rows(logs.first_by(log, "source_sha256").select("source_sha256", "source_url")) == [("a", "u1"), ("b", "u3")]
    bad = logs.malformed(spark, str(tmp_path / "log.ndjson"), schemas.CAPTURE).first()
    assert bad["lines"] == 2 and bad["samples"] == ["{bad", "also bad"]


def test_appended_logs_keep_their_order(spark, tmp_path):
    """The last append wins, whatever the files' sizes, also over a file that no append wrote; parts keep their rows' order."""
    path = str(tmp_path / "log")
    schema = schemas.struct("k string, v string")
    make = lambda rows: spark.createDataFrame(rows, "k string, v string")
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "captures.ndjson").write_text(json.dumps({"k": "a", "v": "first"}) + "\n")
    logs.append_log(make([("a", "old")] + [("z", "x" * 50)] * 5000).coalesce(1), path)
    logs.append_log(make([("a", "new"), ("b", "one")]).repartition(2), path)
    logs.append_log(make([("a", "newest")]), path)
    log = logs.read_log(spark, path, schema)
    assert log.count() == 5005
    assert rows(logs.last_by(log, "k").where("k <> 'z'").select("k", "v")) == [("a", "newest"), ("b", "one")]
    assert rows(logs.first_by(log, "k").where("k = 'a'").select("v")) == [("first",)]
    assert [r["v"] for r in log.where("k = 'a'").orderBy("line_no").collect()] == ["first", "old", "new", "newest"]
    logs.append_log(spark.range(0, 4000, 1, 4).select(F.lit("n").alias("k"), F.col("id").cast("string").alias("v")), path)
    last = logs.read_log(spark, path, schema).where("k = 'n'").orderBy("line_no")
    assert [r["v"] for r in last.collect()] == [str(i) for i in range(4000)]


def test_log_merge_keeps_repeats(spark):
    make = lambda values: spark.createDataFrame([(v,) for v in values], "line string")
    merged = logs.merge_logs(make("aab"), make("aabx"), make("abx"))
    assert rows(merged) == [("a",), ("a",), ("b",), ("x",)]


def test_archive_scan_and_quarantine(spark, tmp_path):
    for body, name in ((b"%PDF one", None), (b"%PDF two", "f" * 64)):
        sha = name or hashlib.sha256(body).hexdigest()
        (tmp_path / sha[:2]).mkdir(exist_ok=True)
        (tmp_path / sha[:2] / f"{sha}.pdf").write_bytes(body)
    (tmp_path / "zz").mkdir()
    (tmp_path / "zz" / "note.txt").write_text("x")
    found = archive.scan(spark, str(tmp_path))
    good, bad = archive.verified(found)
    assert found.count() == 2 and good.count() == 1 and bad.count() == 1
    archive.quarantine(bad, str(tmp_path / "quarantine"))
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 1
    assert archive.stats(archive.scan(spark, str(tmp_path), content=False)).first()["files"] == 2
    assert good.select(archive.looks_like(F.col("content"), "pdf")).first()[0] is True


def test_sidecar_keeps_identity(spark):
    source = spark.createDataFrame([("a", bytearray(b"x"), "pdf"), ("b", bytearray(b"y"), "pdf")], "source_sha256 string, content binary, extension string")
    ocr = spark.createDataFrame([("a", bytearray(b"ocr"))], "source_sha256 string, content binary")
    assert {r["source_sha256"]: bytes(r["content"]) for r in archive.with_sidecars(source, ocr).collect()} == {"a": b"ocr", "b": b"y"}
    named = archive.with_captures(source.drop("content"), spark.createDataFrame([("a", "https://x")], "source_sha256 string, source_url string"), F.lit("fake"))
    assert {r["source_sha256"]: r["source_url"] for r in named.collect()} == {"a": "https://x", "b": "archive://fake/b.pdf"}


def test_first_source_wins(spark):
    data = spark.createDataFrame([("k", 1, "x"), ("k", 1, "y"), ("k", 2, "z"), (None, 3, "n"), (None, 4, "m")], "key string, source int, row string")
    assert [r[2] for r in rows(dedupe.first_source_wins(data, F.col("key"), "source").select("key", "source", "row").fillna("", ["key"]))] == ["n", "x", "y"]


def test_html(spark):
    page = "<html><script>x</script><p>A&amp;B<br>c</p><a href='/r/1.pdf'>one</a><table><tr><td><a href='d?id=1'>x</a> y</td></tr><tr><td>none</td></tr></table></html>"
    df = spark.createDataFrame([(1, page), (2, None)], "page_id long, html string")
    assert df.select(html.html_to_text("html")).first()[0].split("\n")[:2] == ["A&B", "c"]
    assert [r["url"] for r in html.exploded_links(df).collect()] == ["/r/1.pdf", "d?id=1"]
    assert [tuple(r) for r in html.index_rows(df).collect()] == [(1, "d?id=1", "x y")]
    changed = spark.createDataFrame([(page.replace("<p>", "<p class='k'>"),), (page.replace("one", "two"),), (page,)], "html string")
    keys = [r[0] for r in changed.select(html.content_key(F.col("html"))).collect()]
    assert keys[0] == keys[2] != keys[1]
    assert df.select(html.layout(F.col("html")).alias("l")).first()["l"]["tables"] == 1


def test_cdx_and_escapes(spark):
    df = spark.createDataFrame([('[["url","ts"],["u","1"],["v","2"],["short"]]',)], "body string")
    assert [r["row"] for r in html.cdx_rows(df).orderBy("position").collect()] == [{"url": "u", "ts": "1"}, {"url": "v", "ts": "2"}]
    js = spark.createDataFrame([(r"\x5b\x22a\/b\x22\x5d",)], "c string")
    assert js.select(html.unescape_hex(F.col("c"))).first()[0] == '["a/b"]'


def test_view_semantics(spark):
    data = spark.createDataFrame(
        [("1", "x", None, "10", "Alpha (1)", None), ("2", "x", "2024-01-02", "2", "beta", "1"), ("3", "y", "2024-03-01", "CX", "a+b", None), ("4", "y", "2024-02-01", "", "gamma", None)],
        "ruling_id string, county string, hearing_date string, dept string, case_title string, previous_version_id string",
    )
    ids_of = lambda q: [r["ruling_id"] for r in q.rows(data).collect()]
    assert ids_of(view.ViewQuery()) == ["3", "4", "2"]  # 1 is a previous version
    assert ids_of(view.ViewQuery(sort="dept", direction="asc")) == ["4", "2", "3"]
    assert ids_of(view.ViewQuery(first="2024-02-01")) == ["3", "4"]
    assert ids_of(view.ViewQuery(q="A+B")) == ["3"] and ids_of(view.ViewQuery(q="g*a")) == ["4"] and ids_of(view.ViewQuery(q="?+b")) == ["3"]
    assert ids_of(view.ViewQuery(filters={"county": []})) == [] and ids_of(view.ViewQuery(filters={"county": ["x"]})) == ["2"]
    assert ids_of(view.ViewQuery(counties=["y"], sort="bogus")) == ["3", "4"]
    assert view.ViewQuery(page_size=50).counts(data).first()["n_pages"] == 1
    state = view.parse_state({"counties": "x,nope", "size": "7", "page": "0", "q": "a", "f_dept": "1|2"}, {"x", "y"})
    assert state.counties == ["x"] and state.page_size == 100 and state.page == 1 and state.filters == {"dept": ["1", "2"]}


def test_blocks(spark):
    doc = spark.createDataFrame([(1, "intro\nNo. 1 a\nbody\nNo. 2 b\nend"), (2, "nothing"), (3, None)], "id int, text string")
    found = rows(blocks.split_at(doc, r"No\. [0-9]", ["id"]))
    assert found == [(1, 1, 6, "No. 1 a\nbody\n"), (1, 2, 19, "No. 2 b\nend")]
    pages = spark.createDataFrame([(1, ["ab", "cde", ""])], "id int, pages array<string>").select(blocks.joined_pages(F.col("pages")).alias("j"))
    assert tuple(pages.first()["j"]) == ("ab\n\ncde\n\n", [0, 4, 9])
    number = lambda o: pages.select(blocks.page_for_offset(F.col("j.starts"), F.lit(o))).first()[0]
    assert [number(o) for o in (0, 3, 4, 8, 9, 99)] == [1, 1, 2, 2, 3, 3]
    near = spark.createDataFrame([(["Alpha beta gamma delta 1", "alpha beta gamma delta 2", "other"],), (None,)], "pages array<string>")
    assert [r["pages"] for r in blocks.collapse_similar(near).collect()][0] == ["alpha beta gamma delta 2", "other"]
    shared = spark.createDataFrame([(1, ["H\nx\nF", "H\ny\nF"]), (2, ["H"])], "id int, pages array<string>")
    assert rows(blocks.common_lines(shared, "id")) == [(1, 1, 1), (2, 0, 0)]
    assert spark.range(1).select(blocks.page_slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.lit(0), F.lit(9))).first()[0] == ["a", "b", "c"]


def test_summary_hides_text(spark):
    long = "word " * 400
    data = spark.createDataFrame(
        [("1", "x", "t" * 600, "m", long, long, long, "secret"), ("2", "x", "t", "m", "", "Calendar notes are not yet available. Check back for updated notes.", "", "secret")],
        "ruling_id string, county string, case_title string, motion_type string, outcome_text string, body_text string, full_text string, new_column string",
    )
    out = {r["ruling_id"]: r for r in warehouse.summary(data).collect()}
    assert "new_column" not in out["1"].asDict() and "full_text" not in out["1"].asDict()
    assert out["1"]["case_title"] == "" and out["1"]["outcome_text"].endswith("…") and len(out["1"]["body_text"]) <= 601
    assert out["2"]["status"] == "pending" and out["2"]["body_text"] is None


def test_summary_limits(spark):
    """600 characters of the disposition, 300 of the opening; columns in the index's order."""
    data = spark.createDataFrame([("1", "published", "word " * 400, "body " * 400, "x", "j")], "ruling_id string, status string, outcome_text string, body_text string, county string, judge string")
    out = warehouse.summary(data)
    assert out.columns == ["ruling_id", "county", "judge", "status", "outcome_text", "body_text"]
    row = out.first()
    assert 590 < len(row["outcome_text"]) <= 601 and 290 < len(row["body_text"]) <= 301


def test_details_conflict(spark):
    columns = "ruling_id string, county string, case_title string, motion_type string, outcome_text string, body_text string, full_text string"
    same = spark.createDataFrame([("1", "x", "t", "m", "o", "b", "f")] * 2, columns)
    assert warehouse.details(same).count() == 1
    with pytest.raises(Exception, match="different records"):
        warehouse.details(same.union(spark.createDataFrame([("1", "x", "t", "m", "o", "b", "g")], columns))).collect()


def test_merge_promotes_null(spark):
    old = spark.createDataFrame([(1,)], "id int").withColumn("dept", F.lit(None))
    merged = warehouse.merged(old, spark.createDataFrame([(2, "RIV-1")], "id int, dept string"))
    assert dict(merged.dtypes)["dept"] == "string" and [r["dept"] for r in merged.orderBy("id").collect()] == [None, "RIV-1"]


def test_sharded_write(spark, tmp_path):
    import os

    data = spark.range(2000).withColumn("x", F.sha2(F.col("id").cast("string"), 512))
    path = str(tmp_path / "t")
    warehouse.write_sharded(data, path, ["id"], 130.0, limit=80_000)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) > 1 and all(os.path.getsize(f"{path}/{f}") <= 100_000 for f in files)
    assert spark.read.parquet(path).count() == 2000 and warehouse.bytes_per_row(spark, path) > 50
    warehouse.write_sharded(data.limit(3), path, ["id"], 130.0)
    assert spark.read.parquet(path).count() == 3


def test_sharded_write_keeps_the_old_table(spark, tmp_path):
    """A write that fails leaves the old table; one that was cut off between the renames is brought back."""
    import os

    from docketeer.sources import files

    path = str(tmp_path / "t")
    warehouse.write_sharded(spark.range(100), path, ["id"], 8.0)
    broken = spark.range(10).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        warehouse.write_sharded(broken, path, ["id"], 8.0)
    assert spark.read.parquet(path).count() == 100
    os.rename(path, f"{path}.old")
    files.recover(spark, path)
    assert spark.read.parquet(path).count() == 100
    noise = spark.range(3000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("x"))
    warehouse.write_sharded(noise, path, ["id"], 1.0, limit=60_000)  # a wrong guess of the size is made good
    assert all(size <= 60_000 for size in files.sizes(spark, path, ".parquet").values()) and spark.read.parquet(path).count() == 3000


def test_starts_over_chunks(spark):
    for n in (0, 1, 2, 255, 256, 257, 1000):
        lengths = [(i * 7) % 11 for i in range(n)]
        found = spark.createDataFrame([(lengths,)], "x array<int>").select(blocks.starts_of(F.col("x"))).first()[0]
        assert found == [sum(lengths[:i]) for i in range(n)]


def test_holding_any(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "say alphabet soup now"), (2, "nothing"), (3, None), (4, "ab"), (5, "alphabet so")], "id int, text string")
    phrases = spark.createDataFrame([("alphabet soup",), ("ab",), ("",)], "phrase string")
    few = rows(blocks.holding_any(docs, phrases, "id", "text").select("id", "holds"))
    monkeypatch.setattr(blocks, "FEW_PHRASES", 0)
    for group in (100, 1):
        monkeypatch.setattr(blocks, "GROUP_PHRASES", group)
        assert rows(blocks.holding_any(docs, phrases, "id", "text").select("id", "holds")) == few == [(1, True), (2, False), (3, False), (4, True), (5, True)]
    rng = __import__("random").Random(1)
    word = lambda n: "".join(rng.choice("abé") for _ in range(n))
    texts, wanted = [(i, word(60)) for i in range(80)], [word(6) for _ in range(30)]
    monkeypatch.setattr(blocks, "GROUP_PHRASES", 12)
    found = blocks.holding_any(spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame([(w,) for w in wanted], "phrase string"), "id", "text")
    assert rows(found.select("id", "holds")) == [(i, any(w in t for w in wanted)) for i, t in texts]


def test_version_depths(spark):
    links = [(f"v{i}", f"v{i - 1}") for i in range(1, 300)] + [("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("lone", None), ("v0", None)]
    found = {r["id"]: (r["root"], r["n_versions"]) for r in view.version_depths(spark.createDataFrame(links, "id string, prev string"), "id", "prev").collect()}
    assert all(found[f"v{i}"] == ("v0", i) for i in range(1, 300)) and len(found) == 303
    assert all(found[k] == (None, None) for k in "xyzw")


def test_digest_and_stale(spark):
    one = spark.createDataFrame([("a", "h1")], "name string, sha256 string")
    two = one.union(spark.createDataFrame([("b", "h2")], "name string, sha256 string"))
    assert warehouse.dataset_digest(one).first()[0] == "h1"
    assert warehouse.dataset_digest(two).first()[0] == hashlib.sha256(b"a h1\nb h2\n").hexdigest()
    files = lambda r: spark.createDataFrame(r, "path string, bytes long, sha256 string")
    assert rows(warehouse.stale_outputs(files([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x")]), files([("a", 1, "x"), ("b", 2, "x"), ("c", 1, "y"), ("d", 1, "x")]))) == [("b", "bytes"), ("c", "hash"), ("d", "unlisted")]


def test_live_block():
    block = warehouse.live_block({"rulings": 18076, "counties": 32, "sources": 5, "first_date": "2000-10-12", "last_date": "2026-06-08"}, "today")
    assert "| Parsed rulings | 18,076 |" in block
    assert warehouse.replace_block("a\n<!-- LIVE:START -->old<!-- LIVE:END -->z", "new") == "a\n<!-- LIVE:START -->\nnew\n<!-- LIVE:END -->z"
    with pytest.raises(ValueError, match="markers"):
        warehouse.replace_block("none", "new")


def test_latest_ties(spark):
    log = spark.createDataFrame([("u", 1, 1), ("u", 2, 2), ("u", 2, 3)], "url string, ts int, line int")
    assert captures.latest(log, "url", "ts", "line").first()["line"] == 2
    assert captures.latest(log, "url", "ts", "line", "last").first()["line"] == 3


def test_known_refs_do_not_use_the_limit(spark):
    refs = spark.createDataFrame([("u1", 1), ("u2", 2), ("u3", 3)], "url string, ord int").withColumn("g", F.lit(1))
    known = spark.createDataFrame([("u1",)], "url string")
    assert rows(captures.known_skipped_then_limited(refs, known, ["url"], "g", "ord", 2).select("url")) == [("u2",), ("u3",)]


def test_archive_fallback(spark):
    refs = spark.createDataFrame([("u1",), ("u2",)], "url string")
    listing = spark.createDataFrame([("u1", "t1"), ("u1", "t2")], "url string, ts string")
    near = spark.createDataFrame([("u1", "t9"), ("u2", "t3")], "url string, ts string")
    assert rows(captures.with_archive_fallback(refs, listing, near)) == [("u1", "t1"), ("u1", "t2"), ("u2", "t3")]


def test_trailing_window_excludes_its_start(spark):
    data = spark.sql("SELECT 'k' AS k, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS ts FROM VALUES (0), (59), (60) t(s)")
    assert sorted(r["n"] for r in quota.trailing_count(data, "k", "ts", 60).collect()) == [1, 2, 2]


def test_docx_lines(spark):
    import io
    import zipfile

    from docketeer.sources.docx import docx_lines

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "<w:p><w:r><w:t>No. 1</w:t><w:tab/><w:t>CU0001234 </w:t></w:r></w:p><w:p/><w:p><w:r><w:t>one</w:t><w:br/><w:t> two &amp; three</w:t></w:r></w:p>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
    empty = io.BytesIO()
    with zipfile.ZipFile(empty, "w") as archive:
        archive.writestr("other.xml", "<x/>")
    rows_ = [(1, bytearray(out.getvalue())), (2, bytearray(b"no zip")), (3, None), (4, bytearray(empty.getvalue()))]
    found = spark.createDataFrame(rows_, "id int, content binary").select("id", docx_lines("content").alias("l")).orderBy("id").collect()
    assert [r["l"] for r in found] == [["No. 1\tCU0001234", "one", "two & three"], [], [], []]

    from docketeer.operators import parsing

    page = b"<p>Line one<br>two</p><script>x</script>"
    sources = spark.createDataFrame([("nevada", "docx", rows_[0][1], None), ("los_angeles", "html", bytearray(page), None), ("fresno", "html", bytearray(page), None), ("fresno", "pdf", None, ["p"])], "county string, extension string, content binary, pages array<string>")
    assert [r["pages"] for r in parsing.with_pages(sources).collect()] == [["No. 1\tCU0001234\none\ntwo & three"], ["Line one\ntwo"], None, ["p"]]


def test_page_links_and_static_refs(spark):
    page = """<a href='/r/One%20x.PDF'>First <b>file</b></a><select name='dept'><option value='d/2.pdf?x=1'>Dept 2</option><option>none</option></select>
<a href='https://other.example/3.pdf'>3</a><a href='r/One%20x.PDF'>again</a><a>no</a> [Fourth  file](docs/4.docx "t") [Fourth  file](docs/4.docx)"""
    links = html.page_links(spark.createDataFrame([(1, "https://c.example/p/i.html", page), (2, None, None)], "page_id int, url string, html string"))
    assert [(r["tag"], r["url"], r["text"], r["list"]) for r in links.orderBy("position").collect()] == [
        ("a", "https://c.example/r/One%20x.PDF", "First file", None),
        ("option", "https://c.example/p/d/2.pdf?x=1", "Dept 2", "dept"),
        ("a", "https://other.example/3.pdf", "3", None),
        ("a", "https://c.example/p/r/One%20x.PDF", "again", None),
        ("markdown", "https://c.example/p/docs/4.docx", "Fourth file", None),
    ]
    refs = html.static_refs(links.union(links), ["c.example"], division="Civil")
    assert rows(refs.select("url", "filename", "link_text", "division_hint")) == [
        ("https://c.example/p/d/2.pdf?x=1", "2.pdf", "Dept 2", "Civil"),
        ("https://c.example/p/r/One%20x.PDF", "One x.PDF", "again", "Civil"),
        ("https://c.example/r/One%20x.PDF", "One x.PDF", "First file", "Civil"),
    ]
    assert rows(html.static_refs(links, ["c.example"], path="^/r/").select("link_text")) == [("First file",)]


def test_page_refs_of_the_table(spark):
    """Every page's anchors against a plain pattern, which the table's flat anchors fit."""
    import re
    from html import unescape
    from urllib.parse import urljoin

    from docketeer.plans import table_queries  # noqa: F401
    from docketeer.plans.registry import QUERIES
    from tests.conftest import DATA

    expected = []
    for r in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        markup = re.sub(r"(?s)<!--.*?-->|<(script|style)\b.*?</\1>", "", r["html"] or "")
        expected += [(r["page_id"], urljoin(r["url"], unescape(h)), " ".join(unescape(re.sub("<[^>]*>", "", t)).split())) for h, t in re.findall(r"""(?is)<a\s[^>]*?href="([^"]+)"[^>]*>(.*?)</a>""", markup)]
    found = QUERIES["page_refs"](spark, DATA).where("tag = 'a'")
    assert sorted(map(tuple, found.select("page_id", "url", "text").collect())) == sorted(expected) and expected


def test_rewrite_if_changed(spark, tmp_path):
    import os

    path, schema = str(tmp_path / "state"), schemas.struct("kind string, url string")
    make = lambda values: spark.createDataFrame([(k, u) for k, u in values], schema)
    assert not logs.rewrite_if_changed(make([]), path, schema, "kind", "url") and not os.path.exists(path)
    assert logs.rewrite_if_changed(make([("b", "2"), ("a", "1")]), path, schema, "kind", "url")
    files_then = sorted(os.listdir(f"{path}/batch-000000000001"))
    assert not logs.rewrite_if_changed(make([("a", "1"), ("b", "2")]), path, schema, "kind", "url")
    assert sorted(os.listdir(f"{path}/batch-000000000001")) == files_then
    assert logs.rewrite_if_changed(make([("a", "1"), ("b", "3")]), path, schema, "kind", "url")
    assert [r["url"] for r in logs.read_log(spark, path, schema).orderBy("line_no").collect()] == ["1", "3"]


def test_publishing(spark, tmp_path):
    import os

    columns = "ruling_id string, county string, case_title string, motion_type string, outcome_text string, body_text string, full_text string"
    data = spark.createDataFrame([("ab1", "x", "t", "m", "o", "b", "f"), ("cd2", "x", "t", "m", "o", "b", "f"), ("cd2", "x", "t", "m", "o", "b", "f")], columns)
    path = str(tmp_path / "view")
    assert not warehouse.published(spark, path, "d1")
    warehouse.publish(data, path, "d1")
    assert warehouse.published(spark, path, "d1") and not warehouse.published(spark, path, "d2")
    assert sorted(n for n in os.listdir(f"{path}/ruling-text") if n.startswith("prefix")) == ["prefix=ab", "prefix=cd"]
    assert spark.read.json(f"{path}/summary").count() == 3 and spark.read.json(f"{path}/ruling-text").count() == 2
    part = next(n for n in os.listdir(f"{path}/summary") if n.endswith(".json"))
    with open(f"{path}/summary/{part}", "a") as file:
        file.write("{}\n")
    assert not warehouse.published(spark, path, "d1")


def test_ticked_values():
    assert view.ticked_filter("dept", ["1", "2"], ["1", "2"]) is None and view.ticked_filter("dept", [], ["1", "2"]) == []
    assert view.ticked_filter("case_title", [], ["1", "2"]) is None and view.ticked_filter("dept", ["1"], ["1", "2"]) == ["1"]


def test_html_to_text_of_the_table(spark):
    """Every page's whole text, against tags cut out by pattern."""
    import re
    from html import unescape

    from docketeer.plans import table_queries  # noqa: F401
    from docketeer.plans.registry import QUERIES
    from tests.conftest import DATA

    pages = {r["page_id"]: r["html"] or "" for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    found = {r["page_id"]: r["text"] for r in QUERIES["html_to_text"](spark, DATA).collect()}
    assert set(found) == set(pages)
    for page, markup in pages.items():
        bare = re.sub(r"(?is)<(script|style|noscript)\b.*?</\1>|<!--.*?-->|<![^>]*>", "", markup)
        text = re.sub("<[^>]*>", "", re.sub(r"(?i)</?(?:br|div|p|li|tr|table|h1|h2|h3|h4|h5|h6|hr)\b[^>]*>", "\n", bare))
        text = re.sub(r"[ \t\f\v]+", " ", unescape(unescape(text)).replace("\xa0", " ").replace("\r\n", "\n").replace("\r", "\n"))
        assert found[page] == re.sub(r"\n{3,}", "\n\n", re.sub(r" ?\n ?", "\n", text)).strip(), page


def test_html_cells_stay_in_their_line(spark):
    cases = {
        "<tr><td>24CV00123</td> <td>Smith v. Jones</td></tr>": "24CV00123 Smith v. Jones",
        "<tr><td>24CV00123</td><td>Smith</td></tr>": "24CV00123Smith",
        "<p>a</p><p>b</p><section>c</section><ul><li>d</ul>": "a\n\nb\nc\nd",
        "x<br><br><br>y &amp;amp; z<script>if (a < b) {}</script><noscript>no</noscript>w": "x\n\ny & zw",
        "</script>a<div>&nbsp; b</div>": "a\nb",
    }
    df = spark.createDataFrame([(k,) for k in [*cases, None]], "html string")
    assert [r[0] for r in df.select(html.html_to_text("html")).collect()] == [*cases.values(), ""]


def test_adjacent_pages_of_the_table(spark):
    """Every document's pages, each compared with the last one kept by the whole ratio alone."""
    import difflib
    import re

    from docketeer.plans import document_queries  # noqa: F401
    from docketeer.plans.registry import QUERIES
    from tests.conftest import DATA

    found = {r["doc_id"]: r["n_pages"] for r in QUERIES["adjacent_page_dedupe"](spark, DATA).collect()}
    plain = lambda page: re.sub("[^a-z0-9]", "", page.lower())
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        kept = []
        for page in (r["text"] or "").split("\n"):
            if kept and (plain(kept[-1]) == plain(page) or difflib.SequenceMatcher(None, plain(kept[-1]), plain(page), autojunk=False).ratio() > 0.9):
                kept.pop()
            kept.append(page)
        assert found[r["doc_id"]] == len(kept)


def test_shared_lines_equal_brute_force(spark):
    """Random pages against the definition, line by line; page numbers are alike, and prefix and suffix don't overlap."""
    import random

    number = lambda line: (x := line.strip().replace("–", "-").replace("—", "-").strip(" -\t")) and x.isdigit()
    alike = lambda a, b: bool(number(a) and number(b)) or a.strip() == b.strip()

    def brute(pages):
        cut = [(p or "").splitlines() for p in pages or []]
        least = min((len(p) for p in cut), default=0) if len(cut) > 1 else 0
        prefix = next((i for i in range(least) if not all(alike(p[i], cut[0][i]) for p in cut)), least)
        suffix = next((i for i in range(least - prefix) if not all(alike(p[-1 - i], cut[0][-1 - i]) for p in cut)), least - prefix)
        return prefix, suffix, ["\n".join(p[prefix : len(p) - suffix]) for p in cut]

    rng = random.Random(2)
    some = ["head", " head", "1", "- 2 -", "– 3 –", "²", "①", "x", "", "12a", "　foot"]
    cases = [["a\nb", "a\nb"], [*(["\n".join(f"l{i}" for i in range(20))] * 2)], ["only"], [], None, ["", "a"], [None, None], ["a\r\nb\x0bc", "a\nb c"], ["1\n", "2"]]
    cases += [["\n".join(rng.choice(some) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 4))] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(cases)), "id int, pages array<string>")
    found = {r["id"]: (r["prefix"], r["suffix"]) for r in blocks.common_lines(df, "id").collect()}
    left = {r["id"]: r["p"] for r in df.select("id", blocks.without_shared_lines(F.col("pages")).alias("p")).collect()}
    for i, pages in enumerate(cases):
        prefix, suffix, stripped = brute(pages)
        assert found[i] == (prefix, suffix) and (left[i] or []) == stripped, pages


def test_history_leaves_out_rows_without_a_case(spark):
    data = spark.createDataFrame([(1, None, "2024-01-01", "1"), (2, "", "2024-01-02", "1"), (3, "A", "2024-01-01", "1"), (4, "A", "2024-01-01", "2"), (5, "A", None, None)], "ruling_id int, case_number string, hearing_date string, dept string")
    assert rows(view.ordered_history(data).select("ruling_id", "place")) == [(3, 2), (4, 1), (5, 3)]
    assert rows(view.case_history(data).select("ruling_id", "n_history")) == [(3, 3), (4, 3), (5, 3)]
