"""Literal cases of the expressions."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from docketeer.functions import classify, dates, ids, text, urls


@pytest.mark.parametrize(
    ("given", "limit", "expected"),
    [
        ("  GRANTED.\n\n  Appearances   required. ", 300, "GRANTED. Appearances required."),
        ("aaaa bbbb cccc", 10, "aaaa bbbb…"),
        ("a bbbbbbbbbbbbbbbb", 10, "a bbbbbbbb…"),
        ("abcdefghijkl", 5, "abcde…"),
        ("x y", 5, "x y"),
        (None, 5, ""),
    ],
)
def test_clip(value, given, limit, expected):
    assert value(lambda c: text.clip(c, limit), given) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("Friday, March 3, 2023", dt.date(2023, 3, 3)),
        ("March 3rd, 2023", None),
        ("march 3 rd, 2023", dt.date(2023, 3, 3)),
        ("2/30/2024", None),
        ("1/2/69", dt.date(2069, 1, 2)),
        ("1/2/70", dt.date(1970, 1, 2)),
        ("on 2024-02-29", dt.date(2024, 2, 29)),
        ("nothing", None),
        (None, None),
    ],
)
def test_parse_date(value, given, expected):
    assert value(dates.parse_date, given) == expected


def test_find_date_takes_kinds_in_order(value):
    assert value(dates.find_date, "filed 1/5/2020, heard Monday, June 1, 2020") == dt.date(2020, 6, 1)
    assert value(dates.find_date, "2021-01-02 then 3/4/2022") == dt.date(2022, 3, 4)


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("https://x/a/20240115_D9.pdf", dt.date(2024, 1, 15)),
        ("https://x/2024-1-5.pdf", dt.date(2024, 1, 5)),
        ("https://x/3-7-2022-dept.pdf", dt.date(2022, 3, 7)),
        ("https://x/march-7-2022.pdf", dt.date(2022, 3, 7)),
        ("https://x/03-07-22.pdf", dt.date(2022, 3, 7)),
        ("https://x/none.pdf", None),
    ],
)
def test_url_date(value, url, expected):
    assert value(dates.url_date, url) == expected


@pytest.mark.parametrize(
    ("phrase", "expected"),
    [
        ("The motion is granted.", "granted"),
        ("Granted in part and denied in part.", "other"),
        ("OFF-CALENDAR and granted", "off_calendar"),
        ("Continued. Motion denied.", "continued"),
        ("Parties shall appear.", "appearance_required"),
        ("", "other"),
        (None, "other"),
    ],
)
def test_shared_rules(value, phrase, expected):
    assert value(classify.SHARED.outcome, phrase) == expected


@pytest.mark.parametrize(
    ("county", "phrase", "expected"),
    [
        ("fresno", "granted in part, denied in part", "denied"),
        ("el_dorado", "appearances are required; off calendar", "appearance_required"),
        ("nevada", "matter is continued to May 1; motion denied", "continued"),
        ("nevada", "no appearances are required", "other"),
        ("amador", "there is no tentative ruling", "appearance_required"),
        ("amador", "no appearance necessary. appearance necessary", "other"),
        ("solano", "the objection is overruled", "other"),
        ("solano", "the motion is overruled", "denied"),
        ("san_bernardino", "overruled", "denied"),
        ("riverside", "moot", "off_calendar"),
        ("contra_costa", "the order is vacated by consent", "other"),
        ("contra_costa", "x\nVACATED as moot", "off_calendar"),
        ("tuolumne", "set for hearing", "continued"),
        ("merced", "no appearance is required", "other"),
    ],
)
def test_county_rules(value, county, phrase, expected):
    assert value(classify.rules_for(county).outcome, phrase) == expected
    assert value(lambda c: classify.classify_by_county(F.lit(county), c), phrase) == expected


def test_every_county_has_rules():
    assert len(classify.COUNTY_RULES) + len(classify.SHARED_COUNTIES) == 34


def test_conditional_and_continued(value):
    assert value(classify.SHARED.is_conditional, "Absent any timely objection") is True
    assert value(classify.SHARED.continued_to, "denied, continued until 3/4/25") == dt.date(2025, 3, 4)
    assert value(classify.rules_for("fresno").continued_to, "denied until 3/4/25") is None


ALL_RULES = {"shared": classify.SHARED, **classify.COUNTY_RULES}


def test_plain_texts_and_first_letters_change_nothing(spark):
    """Every pattern over texts made of its own parts, against the pattern alone."""
    rng = random.Random(3)
    patterns = sorted({p for r in ALL_RULES.values() for p in (*r.patterns.values(), *r.veto.values(), r.conditional)})
    texts = []
    for pattern in patterns:
        parts = re.findall(r"[a-z]+", re.sub(r"\\.", " ", pattern))
        texts += ["".join(rng.choice(parts) + rng.choice(["", "", " ", " ", "\n", "  ", "-", ". ", "\u0301"]) for _ in range(rng.randrange(1, 7))) for _ in range(150)]
    small = F.col("x")
    differ = [F.count_if(classify.has(small, p) != small.rlike(p)).alias(f"d{i}") for i, p in enumerate(patterns)]
    hits = [F.count_if(classify.has(small, p)).alias(f"h{i}") for i, p in enumerate(patterns)]
    row = spark.createDataFrame([(x,) for x in texts], "x string").agg(*differ, *hits).first()
    assert not any(row[: len(patterns)]) and sum(n > 0 for n in row[len(patterns) :]) > 0.8 * len(patterns)
    assert all(classify.needed(p) for p in patterns)


def test_each_pattern_is_tried_once_a_row(spark):
    """However many counties share it: 63 patterns, not one for each county and outcome."""
    from docketeer.plans import document_queries
    from docketeer.plans.registry import Tables
    from tests.conftest import DATA

    patterns = {p for r in ALL_RULES.values() for p in (*r.patterns.values(), *r.veto.values())}
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        plan = document_queries.classify_precedence_variants(Tables(spark, DATA))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert 0 < plan.count("RLIKE") <= len(patterns)


def test_ids(value):
    import hashlib

    assert value(lambda a, b: ids.ruling_id(a, F.lit(3), b), "ab", "CV1") == hashlib.sha256(b"ab:3:CV1").hexdigest()[:32]
    assert value(lambda a: ids.short_id(a, F.lit("2025-12-01").cast("date"), F.lit("9"), F.lit(3)), "eld") == "ELD-251201-D9-3"
    assert value(lambda a: ids.short_id(a, F.lit(None).cast("date"), F.lit(""), F.lit(None)), "eld") == "ELD-000000-D?-?"
    assert value(ids.document_key, "/data/yolo/ruling-text/ab/" + "ab" * 16 + ".json") == "ruling:yolo/" + "ab" * 16
    assert value(ids.document_key, "/data/yolo/rulings/" + "ab" * 16 + ".pdf") == "ruling:yolo/" + "ab" * 16
    assert value(ids.document_key, "/other") is None


def test_urls(value):
    assert value(urls.filename_of, "https://x.org/a%20b/c%20d.pdf?q=1") == "c d.pdf"
    assert value(urls.filename_of, "https://x.org/") == "source.pdf"
    assert value(lambda c: urls.host_allowed(c, ["court.gov"]), "https://www.court.gov/x") is True
    assert value(lambda c: urls.host_allowed(c, ["court.gov"]), "https://u:p@court.gov/x") is False
    assert value(lambda c: urls.host_allowed(c, ["court.gov"]), "https://evilcourt.gov/x") is False
    assert value(lambda c: urls.in_years(c, 2020, 2021), "https://x/2019/a") is False
    assert value(lambda c: urls.in_years(c, 2020, 2021), "https://x/a") is True
    assert value(urls.address_key, "::ffff:1.2.3.4") == "1.2.3.4"
    assert value(urls.address_key, "2001:db8::1") == "2001:db8:0:0::/64"
    assert value(lambda p: urls.archive_path_safe(p, F.lit("fake")), "archive/fake/pages/../../outside.html") is False
    assert value(lambda p: urls.archive_path_safe(p, F.lit("fake")), "archive/fake/pages/ab/x.html") is True
    assert urls.wayback_stamp(2020, 2022) == "20221231235959" and urls.wayback_stamp(2020, None) == "20200101000000"


def test_text(value):
    assert value(text.clean_lines, "a&nbsp;b\r\n\r\n\r\n\r\n c &amp; d ") == "a b\n\nc & d"
    assert value(text.collapse, "\xa0a \xa0 b ") == "a b"
    assert value(text.class_token, "Off Calendar!") == "off-calendar" and value(text.class_token, "") == "other"
    assert value(text.csv_cell, '=1,"a"') == '"\'=1,""a"""'
    assert value(text.html_escape, "<a & 'b'>") == "&lt;a &amp; &#39;b&#39;&gt;"
    assert value(text.mask, "/2024-01-02/ID 33 0123456789abcdef0123") == "/{date}/id {number} {hash}"


def test_unescape_equals_the_standard_library(spark):
    """Every named reference with and without its semicolon, numbers at all limits, and references inside words."""
    import html
    from html.entities import html5

    from docketeer.functions import text

    numbers = [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000, 10**12]
    cases = [f"a&{name}b &{name}" for name in html5] + [f"&#{n};&#x{n:x};&#X{n:X}z&#0{n} " for n in numbers]
    cases += ["", "&", "&&amp;", "&amp;lt;", "&notit; &notin; &ampx; &unknown; &#; &#x; &#xg;", "&" + "a" * 50 + ";", "a & b &copy", "&\namp;", "&lt&gt;&QUOT;"]
    df = spark.createDataFrame([(c,) for c in [*cases, None]], "c string").select("c", text.unescape(F.col("c")).alias("u"))
    wrong = [(r["c"], r["u"]) for r in df.collect() if r["u"] != html.unescape(r["c"] or "")]
    assert not wrong, wrong[:5]


def test_clean_lines(value):
    from docketeer.functions import text

    cases = {"a&mdash;b &#8217; &sect;&nbsp;c": "a—b ’ § c", " a \r\n\tb\r\r\r\rc \x0b d\n": "a\nb\n\nc d", "　x\n \n \n y": "x\n\ny", "": ""}
    for given, expected in cases.items():
        assert value(text.clean_lines, given) == expected


@pytest.mark.parametrize("number, expected", [("LCPR1", "Probate"), ("24FL0001", "Family Law"), ("24clj001", "Civil Law and Motion"), ("CU0001", "Civil Law and Motion"), ("UD1", "other"), (None, "other")])
def test_case_division(value, number, expected):
    from docketeer.operators.parsing import case_division

    assert value(lambda c: case_division(c, F.lit("other")), number) == expected
