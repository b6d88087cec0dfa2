"""The ingest of all counties over sources of every kind: page arrays, Word files and HTML pages."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from docketeer.functions.text import html_escape
from docketeer.plans import ingest
from docketeer.plans.registry import Tables, query

#: Lines of a text that make one ruling.
LINES = 8
_WORD = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{}</w:body></w:document>'


@F.pandas_udf(BinaryType())
def word_file(texts: pd.Series) -> pd.Series:
    """A Word file with a paragraph a line; its text is escaped already."""

    def one(text: str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("word/document.xml", _WORD.format("".join(f"<w:p><w:r><w:t>{line}</w:t></w:r></w:p>" for line in text.split("\n"))))
        return out.getvalue()

    return texts.map(one)


def county_sources(t: Tables) -> DataFrame:
    """Whole texts as files of five counties: (county, source_sha256, extension, content, pages).

    Documents by their id's remainder are a calendar with a case a page, a Word file, pages with numbered cases, or a web
    page; each ruling has LINES lines of the text.  Each web page of `pages` is the ruling of a county's own page."""
    rows = t.documents.select("doc_id", F.split(F.translate(F.coalesce("text", F.lit("")), "\x00\x0b\x0c", "   "), "\n").alias("lines"))
    number = lambda letters: lambda i: F.concat(F.lit(letters), F.lpad((F.floor(i / LINES) + F.col("doc_id") % 1000 * 100).cast("string"), 6, "0"))
    parts = lambda make: F.transform(F.sequence(F.lit(0), F.size("lines") - 1, F.lit(LINES)), lambda i: F.concat(make(i), F.lit("\n"), F.array_join(F.slice("lines", i + 1, F.lit(LINES)), "\n")))
    kind = F.col("doc_id") % 4
    day = F.lit("Tentative rulings for June 3, 2026\n")
    calendar = parts(lambda i: F.concat(F.lit("Consolidated Calendar\nDepartment 2 June 3, 2026 8:30 am\n"), number("CV")(i), F.lit(" 01/27/2026 1 Smith v. Jones\nAttorney: Yet Not Entered\nMotion Hearing\n5/27/2026 2:07 pm")))
    cases = lambda letters: F.concat(day, F.array_join(parts(lambda i: F.concat(number(letters)(i), F.lit(" Smith v. Jones\nMotion to Compel"))), "\n"))
    content = F.when(kind == 1, word_file(F.when(kind == 1, F.regexp_replace(html_escape(cases("1. CU0")), r"[\x00-\x08\x0B-\x1F]", " ")).otherwise("")))
    content = content.when(kind == 3, F.concat(F.lit("<html><body><p>"), F.replace(html_escape(cases("CV-20-")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p></body></html>")).cast("binary"))
    documents = rows.select(
        F.element_at(F.array(*map(F.lit, ("tuolumne", "nevada", "monterey", "stanislaus"))), (kind + 1).cast("int")).alias("county"),
        F.sha2(F.concat(F.lit("d"), F.col("doc_id")), 256).alias("source_sha256"),
        F.element_at(F.array(*map(F.lit, ("pdf", "docx", "pdf", "html"))), (kind + 1).cast("int")).alias("extension"),
        content.alias("content"),
        F.when(kind == 0, calendar).when(kind == 2, F.array(cases("20CV"))).alias("pages"),
        F.concat(F.lit("https://court.example/"), F.col("doc_id")).alias("source_url"),
    )
    labels = "<div>Tentative Ruling: Smith v. Jones</div><div>Case Number</div><div>24CV00001</div><div>Case Type</div><div>Civil</div><div>Hearing Date / Time</div><div>June 3, 2026 9:00</div><div>Nature of Proceedings</div><div>Motion</div><div>Judges</div><div>Dept. 4</div><div>Tentative Ruling</div>"
    pages = t.pages.select(
        F.lit("santa_barbara").alias("county"), F.sha2(F.concat(F.lit("p"), F.col("page_id")), 256).alias("source_sha256"), F.lit("html").alias("extension"),
        F.concat(F.lit(labels), F.coalesce("html", F.lit("")), F.lit("<div>Was this helpful?</div>")).cast("binary").alias("content"),
        F.lit(None).cast("array<string>").alias("pages"), F.concat(F.lit("https://court.example/tentative-ruling/"), F.col("page_id")).alias("source_url"),
    )
    return documents.unionByName(pages)


@query()
def parsed_rulings(t: Tables) -> DataFrame:
    """What the ingest of all counties makes of these sources, with a log that names each one's address."""
    sources = county_sources(t)
    log = sources.select("source_sha256", "source_url", F.lit(None).cast("string").alias("dept_hint"), F.lit(None).cast("string").alias("division_hint"), F.lit(0).alias("line_no"))
    rows = ingest.new_rulings(sources.drop("source_url"), log, None)
    return rows.select("county", "source_url", "ruling_index", "case_number", "case_title", "motion_type", "hearing_date", "division", "dept", "outcome", "page_start", F.sha2("body_text", 256).alias("body_sha256"))
