"""Sweeps: generated requests over dates and pages, and the references in their answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketeer.functions.text import blank, collapse

#: Pages of a listing that are asked for at most, beside the first.
MAX_PAGE = 25


def dates(spark: SparkSession, first: Column, last: Column, address: str) -> DataFrame:
    """(day, request): every day from first to last, both counted, and the address with the day in place of {day}."""
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
    return days.select("day", F.replace(F.lit(address), F.lit("{day}"), F.date_format("day", "yyyy-MM-dd")).alias("request"))


def around(today: Column, before: int, after: int) -> tuple[Column, Column]:
    """The first and last day of a sweep."""
    return F.date_sub(today, before), F.date_add(today, after)


def safe_filename(c: Column, default: str = "tentative-ruling") -> Column:
    """Letters, digits, full stops, underscores and hyphens stay; all else is one hyphen, none at the ends."""
    name = F.regexp_replace(F.regexp_replace(blank(c), "[^A-Za-z0-9_.-]+", "-"), r"^-+|-+\z", "")
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(default))


def answered_refs(requests: DataFrame, answers: DataFrame, base: str) -> DataFrame:
    """References in JSON answers (request, body) to a date sweep: (day, url, filename, dept_hint, link_text, source_page_url).

    An answer's `data` is a list of rows; rows without a case or a document (or its version) are left out, as are
    answers that are none or hold no list.  Days that nothing answered have no rows."""
    row = "struct<caseId:string,documentId:string,documentVersionId:string,caseNumber:string,department:string,description:string>"
    listed = F.from_json("body", "struct<data:array<string>>")["data"]  # each row as JSON, so that an odd one spoils no other
    rows = requests.join(answers, "request").select("day", "request", F.explode(listed).alias("j")).select("day", "request", F.from_json("j", row).alias("r"))
    document = F.coalesce(_told("r.documentId"), _told("r.documentVersionId"))
    whole = rows.where(F.col("r.caseId").isNotNull()).withColumn("document", document).where("document is not null")
    dept = F.nullif(collapse(F.replace(blank(F.col("r.department")), F.lit("Department"), F.lit(""))), F.lit(""))
    name = F.concat_ws("-", F.date_format("day", "yyyy-MM-dd"), F.coalesce(_told("r.caseNumber"), F.lit("case")), "document")
    return whole.select(
        "day",
        F.concat(F.lit(f"{base}/"), "r.caseId", F.lit("/doc/"), "document").alias("url"),
        F.concat(safe_filename(name), F.lit(".pdf")).alias("filename"),
        dept.alias("dept_hint"),
        F.coalesce(_told("r.description"), F.lit("Tentative Ruling")).alias("link_text"),
        F.col("request").alias("source_page_url"),
    )


def _told(name: str) -> Column:
    """A value that isn't null, empty, zero or false."""
    return F.when(~F.col(name).isin("", "0", "false"), F.col(name))


def form_refs(requests: DataFrame, answers: DataFrame, pattern: str, base: str, label: str) -> DataFrame:
    """References in HTML answers (request, body): of each answer the first link of each id.

    pattern's first group is a link's address (below base), its second the file's id."""
    found = requests.join(answers, "request").select("day", "request", F.posexplode(F.regexp_extract_all(blank(F.col("body")), F.lit(pattern), 0)).alias("at", "hit"))
    rows = found.select("day", "request", "at", F.regexp_extract("hit", pattern, 1).alias("href"), F.regexp_extract("hit", pattern, 2).alias("id"))
    first = rows.groupBy("day", "request", "id").agg(F.min_by("href", "at").alias("href"))
    day = F.date_format("day", "yyyy-MM-dd")
    return first.select("day", "id", F.concat(F.lit(base), "href").alias("url"), F.concat_ws("-", F.lit(label), day, F.concat("id", F.lit(".pdf"))).alias("filename"), F.col("request").alias("source_page_url"))


def last_page(html: Column, most: int = MAX_PAGE) -> Column:
    """The greatest page number that a listing links to, at most `most`; 0 without one."""
    numbers = F.transform(F.regexp_extract_all(blank(html), F.lit(r"[?&]page=([0-9]+)"), 1), lambda n: F.coalesce(n.try_cast("int"), F.lit(most)))
    return F.least(F.coalesce(F.array_max(numbers), F.lit(0)), F.lit(most))


def page_requests(first_pages: DataFrame, url: str = "url", html: str = "html", most: int = MAX_PAGE) -> DataFrame:
    """first_pages' url and the requests for the listing's other pages (page from 1): one row a page."""
    pages = F.filter(F.sequence(F.lit(0), last_page(F.col(html), most)), lambda n: n > 0)
    rows = first_pages.select(F.col(url), F.explode(pages).alias("page"))
    return rows.select(url, "page", F.concat(F.col(url), F.when(F.contains(F.col(url), F.lit("?")), "&").otherwise("?"), F.lit("page="), "page").alias("request"))


def choices(html: Column, name: str) -> Column:
    """Numbers that the list of this name offers, or that links ask for by it, each once, smallest first."""
    lists = F.regexp_extract_all(blank(html), F.lit(rf'(?is)name="{name}".*?</select>'), 0)
    offered = F.flatten(F.transform(lists, lambda x: F.regexp_extract_all(x, F.lit(r'(?i)<option[^>]+value="([0-9]+)"'), 1)))
    linked = F.regexp_extract_all(F.replace(blank(html), F.lit("&amp;"), F.lit("&")), F.lit(rf"[?&]{name}=([0-9]+)(?=[&#\"'])"), 1)
    return F.transform(F.array_sort(F.transform(F.array_distinct(F.concat(offered, linked)), lambda x: F.struct(x.cast("decimal(38,0)").alias("n"), x.alias("text")))), lambda x: x["text"])


def calendar_paths(html: Column) -> Column:
    """Documents that a calendar page's script names, its escapes undone three times, each once in order."""
    out = blank(html)
    for _ in range(3):
        for escape, plain in (("\\\\/", "/"), ("\\/", "/"), ("\\u002F", "/"), ("\\u0022", '"')):
            out = F.replace(out, F.lit(escape), F.lit(plain))
    return F.array_distinct(F.regexp_extract_all(out, F.lit("/document/[A-Za-z0-9_.-]+"), 0))
