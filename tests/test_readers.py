"""Parsers of counties: table functions, labelled pages, and the ingest of all counties over sources of every kind."""

import datetime as dt
import hashlib
import html as markup
import re

from pyspark.sql import functions as F

from docketeer.operators import parsing, readers
from docketeer.plans import ruling_queries
from docketeer.plans.registry import QUERIES, Tables
from tests.conftest import DATA

PAGES = [
    "Consolidated Calendar\nSuperior Court of California, County of Tuolumne\nDepartment 2 June 3, 2026 8:30 am Date Filed DA Case #\nCV68039 01/27/2026 1 Petition in re: 16760 Woodside Wy Sonora, CA 95370\nAttorney: Yet Not Entered 16760 Woodside Wy Sonora, CA\nCase Management Conference\nFURTHER - POS?\n01/27/2026 Petition File Tracking\n5/27/2026 2:07 pm\nThis is a petition to deposit surplus funds.\nThe petition cannot be summarily granted and will be set for hearing on notice.",
    "Consolidated Calendar\nDepartment 2 June 3, 2026 8:30 am Date Filed DA Case #\nCVL66996 02/25/2025 3 Bank of America, N.A. vs. Maria M. Ramirez\nAttorney: Donald Sherrill\nMotion Hearing - Other\n5/27/2026 2:07 pm\nMotion to deem admitted DENIED without prejudice.",
    "a page without a case", None,
]


def source(spark, county, pages=None, content=None, extension="pdf", url="https://court/x"):
    return spark.createDataFrame([(county, "a" * 64, extension, url, pages, content)], "county string, source_sha256 string, extension string, source_url string, pages array<string>, content binary")


def test_calendar_with_a_case_a_page(spark):
    found = parsing.extract_all(source(spark, "tuolumne", PAGES)).orderBy("ruling_index").collect()
    assert [(r["case_number"], r["dept"], r["page_start"], r["hearing_date"]) for r in found] == [("CV68039", "2", 1, dt.date(2026, 6, 3)), ("CVL66996", "2", 2, dt.date(2026, 6, 3))]
    assert "Case Management Conference" in found[0]["motion_type"] and found[0]["body_text"].startswith("This is a petition") and found[1]["outcome"] == "denied"
    assert {r["style"] for r in found} == {"tuolumne-consolidated-calendar"} and len({r["ruling_id"] for r in found}) == 2


def test_functions_take_the_hints_they_name(spark):
    def parse(pages, source_url, division_hint=None, capture=None):
        yield {"case_number": "X1", "case_title": source_url, "motion_type": (capture or {}).get("label_hint"), "body_text": "Granted."}
        yield {"case_number": "X2", "division": division_hint, "body_text": " ".join(pages), "ruling_index": 7}

    docs = source(spark, "sierra", ["a", "b"]).withColumn("division_hint", F.lit("Probate")).withColumn("capture", F.lit('{"label_hint": "L"}'))
    before = dict(parsing.CUSTOM)
    try:
        readers.register_function("sierra", parse)
        rows = parsing.extract(docs, parsing.SPECS["sierra"]).orderBy("case_number").collect()
        none = parsing.extract(docs.withColumn("pages", F.lit(None).cast("array<string>")), parsing.SPECS["sierra"]).count()
    finally:
        parsing.CUSTOM.clear()
        parsing.CUSTOM.update(before)
    assert [(r["case_title"], r["motion_type"], r["division"], r["ruling_index"]) for r in rows] == [("https://court/x", "L", "Probate", 1), (None, None, "Probate", 7)]
    assert none == 2


LABELLED = "<p>Tentative Ruling: old</p><h2>Tentative Ruling: <b>In re</b> Smith: a</h2><div>Case Number</div><div>24CV00001</div><p>Case Type</p><p>Probate</p><p>Hearing Date / Time</p><p>Wednesday, June 3, 2026 - 9:00</p><p>Nature of Proceedings</p><p>Motion</p><p>to compel</p><p>Judges</p><p>A B, Dept. 4 </p><p>Tentative Ruling</p><p>Denied.</p><p>x &amp;amp; y</p><p>Was this helpful?</p><p>Case Number</p>"


def test_labelled_page(spark):
    rows = parsing.extract_all(source(spark, "santa_barbara", content=LABELLED.encode(), extension="html", url="https://c/tentative-ruling/1")).collect()
    assert [(r["case_number"], r["case_title"], r["division"], r["dept"], r["hearing_date"], r["motion_type"], r["body_text"], r["outcome"]) for r in rows] == [
        ("24CV00001", "In re Smith: a", "Probate", "4", dt.date(2026, 6, 3), "Motion\nto compel", "Denied.\nx & y", "denied")]
    for page, url in ((LABELLED, "https://c/other/1"), (LABELLED.replace("24CV00001", ""), "https://c/tentative-ruling/1"), (LABELLED.replace("June 3, 2026", "soon"), "https://c/tentative-ruling/1"), ("", "https://c/tentative-ruling/1")):
        assert parsing.extract_all(source(spark, "santa_barbara", content=page.encode(), extension="html", url=url)).count() == 0


def test_documents_are_read_once(spark):
    """No step of a parser stands in its plan again, as it does below a filter on what it found."""

    def plan(df):
        spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
        try:
            return df._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.debug.maxToStringFields")

    docs = spark.read.schema("source_sha256 string, source_url string, pages array<string>").parquet(f"{DATA}/pages.parquet")
    assert plan(readers.labelled_page(docs, parsing.SPECS["santa_barbara"])).count("map_from_arrays") == 1
    found = plan(parsing.declared(docs, parsing.SPECS["monterey"]))
    assert "monday" in found and not re.search(r"(?m)^\W*Filter .*monday", found)


def test_kinds_of_files_by_county(spark):
    rows = [("nevada", "docx"), ("nevada", "pdf"), ("nevada", "html"), ("monterey", "docx"), ("stanislaus", "html"), ("nowhere", "pdf"), (None, "pdf"), ("monterey", None), ("monterey", "PDF")]
    found = parsing.readable(spark.createDataFrame(rows, "county string, extension string")).collect()
    assert {tuple(r) for r in found} == {("nevada", "docx"), ("nevada", "pdf"), ("stanislaus", "html"), ("monterey", "PDF")}


SPACES = "[\\s\x1c-\x1f]"


def cleaned(text):
    text = markup.unescape(text).replace("\xa0", " ").replace("\r\n", "\n").replace("\r", "\n")
    for pattern, to in ((r"[ \t\f\v]+", " "), (r"\n[ \t]+", "\n"), (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n")):
        text = re.sub(pattern, to, text)
    return text.strip()


def test_all_counties_equal_brute_force(spark):
    """Every document and page as its county's file, against blocks that are known as they were made."""
    rows = {(r["source_url"], r["ruling_index"]): r for r in QUERIES["parsed_rulings"](spark, DATA).collect()}
    expected = {}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        lines = (r["text"] or "").translate({0: " ", 11: " ", 12: " "}).split("\n")
        kind, url = r["doc_id"] % 4, f"https://court.example/{r['doc_id']}"
        for index, at in enumerate(range(0, len(lines), ruling_queries.LINES), 1):
            number = str(index - 1 + r["doc_id"] % 1000 * 100).rjust(6, "0")[:6]
            block = lines[at : at + ruling_queries.LINES]
            if kind == 0:
                body = "\n".join(x.strip() for x in block).strip()
                expected[url, index] = ("tuolumne", f"CV{number}", "Motion Hearing", index, digest(body))
                continue
            case = {1: f"CU0{number}", 2: f"20CV{number}", 3: f"CV-20-{number}"}[kind]
            text = cleaned("\n".join(x.strip() for x in block if x.strip()) if kind == 1 else "\n".join(block))
            text = cleaned(text) if kind == 3 else text
            body = cleaned("\n".join(x for x in text.split("\n") if x.strip(" ")))
            expected[url, index] = ({1: "nevada", 2: "monterey", 3: "stanislaus"}[kind], case, "Motion to Compel", 1, digest(body or "Motion to Compel"))
    for r in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        bare = re.sub(r"(?is)<(script|style|noscript)\b.*?</\1>|<!--.*?-->|<![^>]*>", "", r["html"] or "")
        text = re.sub("<[^>]*>", "", re.sub(r"(?i)</?(?:br|div|p|li|tr|table|h1|h2|h3|h4|h5|h6|hr)\b[^>]*>", "\n", bare))
        body = "\n".join(x for x in (" ".join(y.split()) for y in cleaned(markup.unescape(text)).split("\n")) if x)
        expected[f"https://court.example/tentative-ruling/{r['page_id']}", 1] = ("santa_barbara", "24CV00001", "Motion", 1, digest(body))
    first = {}
    for (url, index), row in sorted(expected.items(), key=lambda x: (digest(x[0][0].replace("https://court.example/tentative-ruling/", "p").replace("https://court.example/", "d")), x[0][1])):
        first.setdefault((row[0], row[1], row[2], " ".join(row[4].split())), url)
    expected = {k: v for k, v in expected.items() if first[v[0], v[1], v[2], v[4]] == k[0]}
    found = {k: (r["county"], r["case_number"], r["motion_type"], r["page_start"], r["body_sha256"]) for k, r in rows.items()}
    assert {k[0].rpartition("/")[0] for k in found} == {"https://court.example", "https://court.example/tentative-ruling"}
    wrong = [(k, found.get(k), v) for k, v in expected.items() if found.get(k) != v]
    assert not wrong, (len(wrong), wrong[:3])
    assert set(found) == set(expected) and all(r["hearing_date"] == dt.date(2026, 6, 3) for r in rows.values())
    assert Tables(spark, DATA).documents.count() <= len({k[0] for k in found})
