"""Counties whose files a declaration can't read: Python table functions over pages, and readers of labelled pages.

A table function is a Python generator registered for a county.  Spark calls it in a lateral join, one document a call,
so that it is spread as the documents are.  It takes the document's pages and, of the keyword arguments source_url,
source_sha256, dept_hint, division_hint and capture (the log's last line on the document, a dict), those that it names.
It yields dicts of FOUND; what it leaves out is null, but for ruling_index (numbered as they come), division (the hint,
else the declaration's) and full_text (the body).
"""

from __future__ import annotations

import datetime as dt
import inspect
import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.functions import dates, fields
from docketeer.functions.text import collapse, let, lines_of, strip, tidy_lines
from docketeer.operators import parsing

FOUND = "ruling_index int, case_number string, case_title string, motion_type string, hearing_date date, division string, dept string, body_text string, full_text string, page_start int, page_end int"
HINTS = ("source_url", "source_sha256", "dept_hint", "division_hint", "capture")


def table_function(read: Callable[..., Iterator[dict]]):
    """read as a Python table function of (pages, hints as JSON) to FOUND."""
    wanted = [name for name in HINTS if name in inspect.signature(read).parameters]
    names = [field.split()[0] for field in FOUND.split(", ")]

    class Rows:
        def eval(self, pages: list, given: str):
            hints = json.loads(given)
            for number, found in enumerate(read(list(pages or []), **{name: hints.get(name) for name in wanted}), 1):
                row = {"ruling_index": number, "division": hints.get("division_hint"), "full_text": found.get("body_text")} | found
                yield tuple(row.get(name) for name in names)

    return F.udtf(Rows, returnType=FOUND)


def register_function(county: str, read: Callable[..., Iterator[dict]], applies: Callable[[], Column] | None = None, style: str | None = None) -> None:
    """Have read parse the county's documents; with applies (makes a condition on pages) those alone, and the declaration the others."""
    function = table_function(read)

    def parse(docs: DataFrame, spec: parsing.ParserSpec) -> DataFrame:
        holds = F.lit(True) if applies is None else F.coalesce(applies(), F.lit(False))
        mine = docs.where(holds)
        given = {name: F.col(name) if name in docs.columns else F.lit(None).cast("string") for name in HINTS}
        line = given.pop("capture")
        hints = F.to_json(F.struct(*(c.alias(name) for name, c in given.items()), F.from_json(line, "map<string,string>").alias("capture")))
        called = mine.select("source_sha256", "source_url", "pages", hints.alias("__hints"))
        rows = called.lateralJoin(function(F.col("pages").outer(), F.col("__hints").outer())).drop("pages", "__hints")
        out = parsing.finished(rows.withColumn("division", F.coalesce("division", F.lit(spec.division))), spec, style or f"{county}-function")
        return out if applies is None else out.unionByName(parsing.declared(docs.where(~holds), spec))

    parsing.register(county, parse)


# How a consolidated calendar's case rows, headers and time stamps look.
CASE_ROW = r"^[ \t]*([A-Z]{2,5}[0-9]{5,7})[ \t]+[0-9]{2}/[0-9]{2}/[0-9]{4}[ \t]+[0-9]{1,3}[ \t]+([^\n]*)"
_HEADER = re.compile(r"(?i)\bdepartment\s+([0-9]{1,3})\s+([a-z]+\s+[0-9]{1,2},\s*[0-9]{4})")
_STAMP = re.compile(r"^\s*[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\s+[0-9]{1,2}:[0-9]{2}\s*[ap]m\s*$", re.I)
_ASIDE = re.compile(r"^\s*attorney:|\bfile tracking\b", re.I)


def calendar_pages(pages: list[str], dept_hint: str | None = None) -> Iterator[dict]:
    """A calendar with a case a page: a header with department and date, the case's row, what is heard, a time stamp,
    and the ruling below it.  Pages without a case row or a date hold none."""
    for number, page in enumerate(pages, 1):
        lines = (page or "").split("\n")
        row = next((i for i, line in enumerate(lines) if re.match(CASE_ROW, line)), None)
        header = _HEADER.search(page or "")
        if row is None or header is None:
            continue
        try:
            day = dt.datetime.strptime(" ".join(header[2].replace(",", " ").split()), "%B %d %Y").date()
        except ValueError:
            continue
        case, title = re.match(CASE_ROW, lines[row]).groups()
        stamp = next((i for i in range(row + 1, len(lines)) if _STAMP.match(lines[i])), len(lines))
        heard = [line for line in lines[row + 1 : stamp] if line.strip() and not _ASIDE.search(line)]
        body = "\n".join(line.strip() for line in lines[stamp + 1 :]).strip()
        yield {
            "case_number": case, "case_title": " ".join(title.split()), "motion_type": " ".join(" ".join(heard).split()), "hearing_date": day,
            "dept": dept_hint or header[1], "body_text": body, "full_text": (page or "").strip(), "page_start": number, "page_end": number,
        }


# Where a ruling's own page starts and ends, and its labels.
_OPENING, _CLOSING = "Tentative Ruling:", "Was this helpful?"
_LABELS = ["Case Number", "Case Type", "Hearing Date / Time", "Nature of Proceedings", "Tentative Ruling", "Judges"]


def labelled_page(docs: DataFrame, spec: parsing.ParserSpec) -> DataFrame:
    """Pages that hold one ruling each, as labels with values below them.  Other addresses, and pages that lack the
    opening, a case number, a date or a ruling, hold none."""
    text = F.coalesce(F.get("pages", F.lit(0)), F.lit(""))
    after = F.concat(F.lit(_OPENING), F.substring_index(text, _OPENING, -1))
    section = tidy_lines(F.substring_index(after, _CLOSING, 1))
    own = docs.where(F.contains("source_url", F.lit("/tentative-ruling/")) & F.contains(text, F.lit(_OPENING)))

    def ruling(full: Column, lines: Column, f: Column) -> Column:
        judge = F.regexp_extract(f["Judges"], r"(?i)Dept\.\s*([^\n]+)", 1)
        return F.struct(
            full.alias("full_text"), F.lit(1).alias("ruling_index"), F.lit(1).alias("page_start"), F.lit(1).alias("page_end"),
            f["Case Number"].alias("case_number"), strip(F.regexp_replace(F.get(lines, F.lit(0)), "^[^:]*:", "")).alias("case_title"),
            f["Nature of Proceedings"].alias("motion_type"), dates.find_date(f["Hearing Date / Time"]).alias("hearing_date"),
            F.nullif(f["Case Type"], F.lit("")).alias("division"), F.nullif(collapse(judge), F.lit("")).alias("dept"), f["Tentative Ruling"].alias("body_text"),
        )

    filled = lambda full: F.filter(F.transform(lines_of(full), lambda x: collapse(x)), lambda x: x != "")
    read = let(section, lambda full: let(filled(full), lambda lines: let(fields.labelled_values(lines, _LABELS), lambda f: ruling(full, lines, f))))
    whole = lambda r: (r["case_number"] != "") & r["hearing_date"].isNotNull() & (r["body_text"] != "")
    # The condition stays in the row: a filter after this would be moved below it, with all of it put in once more for each field.
    rows = own.select("source_sha256", "source_url", F.inline(F.filter(F.array(read), whole)))
    return parsing.finished(rows, spec, f"{spec.county}-detail-page")


def _is_calendar() -> Column:
    return F.exists("pages", lambda p: p.rlike("(?m)" + CASE_ROW) & p.rlike(r"(?i)\bdepartment\s+[0-9]{1,3}\s+[a-z]+\s+[0-9]{1,2},"))


register_function("tuolumne", calendar_pages, _is_calendar, "tuolumne-consolidated-calendar")
parsing.register("santa_barbara", labelled_page)
