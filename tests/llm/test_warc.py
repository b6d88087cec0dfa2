"""WARC archives and their index: round trips, look-ups, and what the query's SQL says."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docketeer.llm import queries, warc
from docketeer.llm.common import shared_path
from tests.conftest import DATA

BIG = "<p>ü word</p>" * 120
ROWS = [
    (1, "http://www.Example.com/a?x=1#top", BIG), (2, "https://b.example.com:443/", BIG), (3, "https://b.example.com:8080", BIG),
    (4, "http://www.example.com/a?x=1", "short"), (5, "http://www.example.com/a?x=1", "short"), (6, None, None), (7, "no address", ""),
    (8, "http://h.test/with space\r\nX: y", "a\r\n\r\nb"), (8, "http://h.test/with space\r\nX: y", "a\r\n\r\nb"), (9, "", BIG + "2"), (9, "", BIG + "2"), (4, "http://z.test/", BIG + "2"),
    (None, "http://n.test/", BIG), (None, "http://n.test/", BIG + "3"), (None, "http://n.test/", BIG + "3"), (10, "http://é.test/ñ", "\x00\U0001f600"),
]
SCHEMA = "page_id long, url string, html string"


def expected(rows):
    text = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for p, data in text:
        same = [q for q, d in text if d == data and q is not None]
        last = max(same, default=None)
        again = len(data) >= 1000 and p != last
        out.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("sent", [100_000, 0])
def test_odd_pages(spark, monkeypatch, sent):
    monkeypatch.setattr(warc, "MOST_SENT", sent)
    frame = spark.createDataFrame([(*r, 0, "x") for r in ROWS], SCHEMA + ", digest int, file string").repartition(3)
    assert sorted((tuple(r) for r in warc.archive_digest(frame).collect()), key=str) == expected(ROWS)
    assert warc.archive_digest(frame.limit(0)).count() == 0


def test_pages_equal_sql(same_rows):
    same_rows(queries.op13_warc, warc.ORACLE_SQL)


def test_keys(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA).select(warc.url_key(F.col("url"))).collect()
    assert [r[0] for r in rows][:8] == ["com,example,www)/a?x=1", "com,example,b)/", "com,example,b:8080)/", "com,example,www)/a?x=1", "com,example,www)/a?x=1", "", "no%20address", "test,h)/with%20space%20%20X:%20y"]


@pytest.fixture(scope="module")
def many(spark):
    """A host with a third of all captures of one address, in blocks of seven lines."""
    rng = random.Random(1)
    rows = [(i, "http://hot.test/same" if i % 3 == 0 else f"http://h{rng.randrange(40)}.test/{rng.randrange(30)}", f"page {i}") for i in range(900)]
    frame, folder = spark.createDataFrame(rows, SCHEMA).repartition(4), shared_path(spark, "many")
    old, warc.BLOCK_LINES, archive, warc.ARCHIVE_BYTES = warc.BLOCK_LINES, 7, warc.ARCHIVE_BYTES, 20_000
    captures = warc.write_archive(frame, f"{folder}/archive")
    index = warc.write_index(captures, f"{folder}/index")
    warc.BLOCK_LINES, warc.ARCHIVE_BYTES = old, archive
    return rows, folder, captures, index


def test_find_and_read(spark, many):
    rows, folder, captures, index = many
    assert captures.select("file").distinct().count() > 4 and index.agg(F.sum("n_lines")).first()[0] == 900
    asked = ["http://hot.test/same", "http://h3.test/5", "http://h3.test/6", "http://absent.test/", "http://zzz.test/", "http://h9.test/1"]
    keys = spark.createDataFrame([(u,) for u in [*asked, asked[0]]], "url string").select(warc.url_key(F.col("url")).alias("url_key"))
    records = warc.read_records(warc.find(index, f"{folder}/index", keys), f"{folder}/archive").collect()
    found = sorted((int(r["page"]), r["url"], bytes(r["payload"]).decode()) for r in records)
    assert found == sorted(r for r in rows if r[1] in asked) and len(found) > 300


def test_archives_are_wellformed(spark, many):
    """Each file is a series of gzip members, in the order of their offsets, that holds nothing else."""
    _, folder, captures, _ = many
    by_file = {}
    for r in captures.collect():
        by_file.setdefault(r["file"], []).append((r["offset"], r["length"], r["page"], r["digest"]))
    for name, places in by_file.items():
        with open(f"{folder}/archive/{name}".removeprefix("file://"), "rb") as file:
            data = file.read()
        at = 0
        for offset, length, page, digest in sorted(places):
            assert offset == at
            fields = warc.parsed(data[at : at + length])
            assert fields[0] == page and fields[5] == digest == hashlib.sha1(fields[6]).hexdigest()
            at += length
        assert at == len(data)


def test_every_page_once(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    out = queries.op13_warc(spark, DATA)
    assert out.count() == pages.count() == out.select("page_id").distinct().count()
