"""County parsers as declarations: where a ruling starts, how its header reads, whose rules classify it.

`extract` turns source documents (page texts) into ruling rows with one plan for all documents of a county: pages are
joined, the text is split at anchors, section headings and departments are carried forward, and the disposition rules
apply to the body.  A document without a hearing date or an anchor gives no rows.  Counties whose files need more than
this register a function instead (see `register`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketeer.functions import classify, dates, ids
from docketeer.functions.text import blank, clean_lines, collapse, first_filled, let, tidy_lines
from docketeer.operators import blocks
from docketeer.sources.docx import docx_lines
from docketeer.sources.html import html_to_text
from docketeer.sources.shared import written


@dataclass(frozen=True)
class ParserSpec:
    """anchor: at a line start, without groups.  number and title: patterns whose first group is read in the block's
    head.  dept and section: patterns whose first group is carried forward.  id_parts: what the ruling id is made of.
    date_chars: the stretches from the text's start in which the hearing date is sought, one after the other (None: the
    whole text).  A county whose reference parser reads nothing but a stretch has that one alone."""

    county: str
    anchor: str
    number: str
    title: str = r"\A[^\n]*?(?:CASE_NUMBER)[\s,:–-]*([^\n]*)"
    dept: str = r"(?i)\b(?:department|dept\.?|courtroom)\s*#?\s*([A-Z]?[0-9]{1,3}[A-Z]?)\b"
    section: str | None = None
    division: str = "Civil Law and Motion"
    body: str | None = None
    extensions: tuple[str, ...] = (".pdf",)
    html: bool = False
    id_parts: tuple[str, ...] = ("sha", "index", "case")
    version: str = "1"
    date_chars: tuple[int | None, ...] = (4000, None)

    @property
    def rules(self) -> classify.Rules:
        return classify.rules_for(self.county)


# How case numbers and headings look in each county's files.
_RULING = r"[ \t]*\(?[ \t]*(?i:tentative\s+ruling)"
_CASE_WORD = r"(?i:case\s+no\.?)"


def _numbered(county: str, number: str, before: str = "", **more) -> ParserSpec:
    """Blocks that start with the case number, perhaps after something else on the line."""
    return ParserSpec(county, anchor=rf"[ \t]*{before}(?:{_CASE_WORD}[ \t]+)?(?:{number})\b", number=rf"({number})", **more)


def _headed(county: str, heading: str, number: str, **more) -> ParserSpec:
    """Blocks that start with a heading; the case number follows somewhere in the block."""
    return ParserSpec(county, anchor=heading, number=rf"({number})", **more)


_GENERIC = r"[0-9]{2}[A-Z]{2,5}-?[0-9]{4,6}|[A-Z]{1,5}-?[0-9]{2}-[0-9]{4,6}|[A-Z]{2,5}[0-9]{4,8}"
_PROBATE_SECTION = r"(?im)^[ \t]*(probate[^\n]*calendar|probate notes|law\s*(?:and|&)\s*motion[^\n]*|case\s+management\s+conferences?)"

SPECS: dict[str, ParserSpec] = {
    s.county: s
    for s in (
        _headed("amador", _RULING, _GENERIC),
        _numbered("butte", r"[0-9]{2}(?:CV|PR)[0-9]{5}", r"(?:[0-9]+(?:-[0-9]+)?\.[ \t]+|[0-9]{1,2}:[0-9]{2}[ \t]+)?", section=_PROBATE_SECTION, date_chars=(800,)),
        _numbered("calaveras", r"[0-9]{2}[A-Z]{2,4}[0-9]{4,6}|[A-Z]{1,4}[0-9]{4,6}", section=_PROBATE_SECTION),
        _numbered("contra_costa", r"(?:MS)?C[0-9]{2}-[0-9]{5}|[CLNPD][0-9]{2}-[0-9]{5}", r"(?:[0-9]{1,3}\.[ \t]+)?(?:[0-9:]+[ \t]+[AP]M[ \t]+)?(?i:case\s+number:?[ \t]+)?", id_parts=("sha", "case", "index")),
        _headed("el_dorado", r"(?i:tentative\s+ruling\s*#\s*[0-9]{1,3}\s*:)", _GENERIC, id_parts=("sha", "index", "start", "case")),
        _headed("fresno", r"(?:\([0-9]{1,3}\)\s*)?(?i:tentative\s+ruling)[ \t]*\n[ \t]*(?i:re:)", r"[0-9]{2}[A-Z]{4}[0-9]{5}", title=r"(?i)\A[\s\S]*?re:[ \t]*([^\n]*)"),
        _headed("imperial", r"(?i:tentative\s+ruling)(?:[ \t]+[A-Z]{3,5}[0-9]{5,})?[ \t]*$", r"[A-Z]{3,5}[0-9]{5,}"),
        _numbered("los_angeles", r"[0-9]{2}[A-Z]{4,5}[0-9]{5}|[A-Z]{2}[0-9]{6}", r"(?i:case\s+number:[ \t]*)?", html=True),
        _numbered("marin", r"(?:CIV|CV|FL|PR|PRO)[0-9]{7}", section=_PROBATE_SECTION),
        _numbered("merced", r"[0-9]{2}[A-Z]{2,3}-[0-9]{4,6}(?:-[A-Z]{2,5})?|[A-Z]{1,3}[0-9]{2}-[0-9]{4,6}", section=_PROBATE_SECTION, date_chars=(4000,)),
        _numbered("monterey", r"[0-9]{2}CV[0-9]{6}"),
        _headed("napa", r".{3,160}?[ \t]+(?:[0-9]{2}(?:PR|CV|FL)[0-9]{6}|PR[0-9]{5})[ \t]*$", r"[0-9]{2}(?:PR|CV|FL)[0-9]{6}|PR[0-9]{5}", title=r"\A([^\n]*?)[ \t]+(?:CASE_NUMBER)", section=r"(?m)^([A-Z][A-Z &/]+CALENDAR)"),
        _numbered("nevada", r"[A-Z]{1,3}[0-9]{2}-[0-9]{4,6}|[A-Z]{2,3}[0-9]{7}|CU[0-9]{7}", r"[0-9]{1,3}\.[ \t]+", extensions=(".pdf", ".docx")),
        _numbered("orange", r"(?:30-)?20[0-9]{2}-[0-9]{7,8}|[0-9]{2}-[0-9]{7,8}", r"(?:[0-9]{1,3}\.?[ \t]+)?[^\n]{0,120}?"),
        _numbered("placer", r"[A-Z]-[A-Z]{2,3}-[0-9]{4,10}|[A-Z]{2,5}[0-9]{3,8}", r"[0-9]{1,3}\.[ \t]+", id_parts=("sha", "index", "start", "case")),
        _numbered("plumas", r"[A-Z]{2}[0-9]{2}-[0-9]{5}|[A-Z]{2,3}[0-9]{4,8}", date_chars=(2500,)),
        _headed("riverside", r"[ \t]*[0-9]{1,3}\.[ \t]*$", r"CV[A-Z]{2}[0-9]{7}|[A-Z]{2,5}[0-9]{7}"),
        _numbered("san_benito", r"(?:FL|CU|PR)-[0-9]{2}-[0-9]{5}", body=r"(?is)(.*?)(?:\n\s*end\s+of\s+tentative\s+decisions|\z)", date_chars=(1200,)),
        _numbered("san_bernardino", r"CIV[A-Z]{2}[0-9]{5,7}|[A-Z]{4}[0-9]{5,7}", r"[0-9]{1,3}\.[ \t]+[^\n]{0,160}?", title=r"\A[ \t]*[0-9]{1,3}\.[ \t]+([^\n]*?),?[ \t]+(?:(?i:case\s+no\.?)[ \t]+)?(?:CASE_NUMBER)"),
        _headed("san_francisco", r"[ \t]*(?i:tentative\s+ruling)[ \t]*$", r"[A-Z]{3}-?[0-9]{2}-?[0-9]{6}"),
        _numbered("san_luis_obispo", r"[0-9]{2}(?:CV|PR|LC|CVP|PRP)-?[0-9]{4}|[0-9]{2}[A-Z]{2,3}-[0-9]{4}", r"(?:[0-9]+[ \t]+)?"),
        _numbered("san_mateo", r"[0-9]{2}-(?:CIV|CLJ|PRO)-[0-9]{5}", r"(?:[0-9]{1,3}\.?[ \t]+)?"),
        _numbered("santa_barbara", r"[0-9]{2}(?:CV|PR|FL)[0-9]{5}", r"(?i:case\s+number:?[ \t]+)?", html=True),
        _headed("santa_clara", r"[ \t]*LINE[ \t]+[0-9]{1,3}\b", r"[0-9]{2}(?:CV|PR)[0-9]{6}"),
        _headed("santa_cruz", r"[ \t]*Nos?\.[ \t]+[0-9A-Z,\s]+?[ \t]*$", r"[0-9]{2}CV[0-9]{5}", date_chars=(1000,)),
        _headed("shasta", r"[^\n]{0,80}?(?i:case\s+number:?)[ \t]+", r"[0-9]{2}[A-Z]{2}-?[0-9]{5,7}|CV[A-Z]{0,2}[0-9]{2}-[0-9]{4,7}|[0-9]{5,7}"),
        _numbered("sierra", r"[A-Z]{2,3}[0-9]{5,7}"),
        _headed("solano", r"[ \t]*(?i:tentative\s+ruling|pregrant\s+order)[ \t]*:?[ \t]*$", r"[A-Z]{2,3}[0-9]{2}-[0-9]{5}|FCS[0-9]{6}"),
        _numbered("sonoma", r"SCV-[0-9]{6}|[0-9]{2}CV[0-9]{5}|S?PR-?[0-9]{6}|MCV-[0-9]{6}", r"(?:[0-9]{1,2}\.[ \t]+)?", html=True, body=r"(?is)(.*?)(?:\n\s*\*+\s*end\s+of\s+tentative\s+rulings|\z)", date_chars=(None,)),
        _numbered("stanislaus", r"(?:CV|FL|PR|UD)-[0-9]{2}-[0-9]{6}", html=True, date_chars=(None,)),
        _numbered("tulare", r"[VP]PR[0-9]{6}|VCU[0-9]{6}|PCU[0-9]{6}", extensions=(".pdf",), html=True),
        _numbered("tuolumne", r"[A-Z]{2,5}[0-9]{5,7}", title=r"\A[ \t]*(?:CASE_NUMBER)[ \t]+[0-9]{2}/[0-9]{2}/[0-9]{4}[ \t]+[0-9]{1,3}[ \t]+([^\n]*)"),
        _headed("ventura", r"[A-Z0-9]{5,30}:[ \t]*[^\n]+$", r"[A-Z0-9]{5,30}(?=:)", title=r"\A[A-Z0-9]{5,30}:[ \t]*([^\n]*)"),
        _numbered("yolo", r"(?:CV|PR|CU)-?[0-9]{2,4}-[0-9]{3,5}|[A-Z]{2}[0-9]{4}-[0-9]{4}", r"(?:(?i:case:?)[ \t]+)?", section=_PROBATE_SECTION),
    )
}

#: County to a function that replaces the declared parser: (docs, spec) to ruling rows (docketeer.operators.readers).
CUSTOM: dict[str, Callable[[DataFrame, ParserSpec], DataFrame]] = {}


def register(county: str, parser: Callable[[DataFrame, ParserSpec], DataFrame]) -> None:
    CUSTOM[county] = parser


def cleaned(docs: DataFrame) -> DataFrame:
    """docs with tidy pages, their character references decoded."""
    return docs.withColumn("pages", F.transform("pages", clean_lines))


def extract(docs: DataFrame, spec: ParserSpec) -> DataFrame:
    """Rulings of one county's documents: source_sha256, source_url, pages, and perhaps dept_hint and division_hint."""
    return _parsed(cleaned(docs), spec)


def _parsed(docs: DataFrame, spec: ParserSpec) -> DataFrame:
    return CUSTOM[spec.county](docs, spec) if spec.county in CUSTOM else declared(docs, spec)


def declared(docs: DataFrame, spec: ParserSpec) -> DataFrame:
    """What the declaration alone finds in cleaned documents."""
    hints = [c for c in ("dept_hint", "division_hint") if c in docs.columns]
    keep = ["source_sha256", "source_url", *hints, "n_pages", "starts", "hearing_date", "text"]

    def dated_text(j: Column) -> Column:
        day = F.coalesce(*(dates.find_date(F.substring(j["text"], 1, n) if n else j["text"]) for n in spec.date_chars))
        return F.struct(j["starts"].alias("starts"), j["text"].alias("text"), day.alias("hearing_date"))

    # Documents without a date leave inside the row: a filter would be moved below, and join the pages and seek the date again.
    one = F.filter(F.array(let(blocks.joined_pages(F.col("pages")), dated_text)), lambda x: x["hearing_date"].isNotNull())
    dated = docs.select("source_sha256", "source_url", *hints, F.size("pages").alias("n_pages"), F.inline(one))
    found = blocks.split_at(dated.withColumn("length", F.length("text")), spec.anchor, [c for c in keep if c != "text"] + ["length"])

    case = F.upper(F.regexp_extract("block", spec.number, 1))
    title = F.regexp_extract("block", spec.title.replace("CASE_NUMBER", spec.number[1:-1]), 1)
    rows = found.withColumn("case_number", case).where("case_number <> ''").withColumn("case_title", collapse(title))
    after = F.substring_index(F.col("block"), "\n", 1)
    rest = F.substring(F.col("block"), F.length(after) + 2, F.length("block"))
    lines = F.filter(F.split(rest, "\n"), lambda x: F.trim(x) != "")
    motion = F.coalesce(F.get(lines, F.lit(0)), F.lit(""))
    body = tidy_lines(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1))), "\n"))
    rows = rows.withColumn("motion_type", collapse(motion)).withColumn("body_text", F.regexp_extract(body, spec.body, 1) if spec.body else body)
    rows = rows.withColumn("body_text", first_filled(F.col("body_text"), F.col("motion_type")))

    place = Window.partitionBy("source_sha256").orderBy("start")
    before = place.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("ruling_index", F.row_number().over(place))  # numbers of the rows that are left
    text_dept = F.nullif(F.regexp_extract("block", spec.dept, 1), F.lit(""))
    hint = lambda c: F.nullif(F.col(c), F.lit("")) if c in hints else F.lit(None).cast("string")
    rows = rows.withColumn("dept", F.coalesce(hint("dept_hint"), F.last(text_dept, ignorenulls=True).over(before)))
    section = F.last(F.nullif(F.regexp_extract("block", spec.section, 1), F.lit("")), ignorenulls=True).over(place.rowsBetween(Window.unboundedPreceding, -1)) if spec.section else F.lit(None).cast("string")
    rows = rows.withColumn("division", F.coalesce(hint("division_hint"), collapse_or_null(section), F.lit(spec.division)))
    end = F.col("start") + F.length("block") - 1
    first_page = blocks.page_for_offset(F.col("starts"), F.col("start"))
    rows = rows.withColumn("full_text", F.col("block")).withColumn("page_start", first_page).withColumn("page_end", F.greatest(first_page, blocks.page_for_offset(F.col("starts"), end)))
    return finished(rows, spec, f"{spec.county}-declared")


def finished(rows: DataFrame, spec: ParserSpec, style: str) -> DataFrame:
    """Ruling rows of what a parser found: identity, and what the county's rules say of the body."""
    part = {"sha": F.col("source_sha256"), "index": F.col("ruling_index"), "case": F.col("case_number"), "start": F.col("start") if "start" in rows.columns else F.col("page_start"), "url": F.col("source_url")}
    return rows.select(
        ids.ruling_id(*(part[p] for p in spec.id_parts)).alias("ruling_id"), F.lit(spec.county).alias("county"), "division", "dept", "hearing_date", "ruling_index", "case_number", "case_title", "motion_type",
        spec.rules.outcome(F.col("body_text")).alias("outcome"), F.col("body_text").alias("outcome_text"), spec.rules.is_conditional(F.col("body_text")).alias("conditional"), spec.rules.continued_to(F.col("body_text")).alias("continued_to"),
        "body_text", "full_text", "page_start", "page_end", "source_sha256", "source_url", F.lit(f"{spec.county}-v{spec.version}").alias("parser_version"), F.lit(style).alias("style"),
    )


def with_pages(sources: DataFrame) -> DataFrame:
    """sources (county, extension, content, pages) with the pages of each kind of file: those given for PDF files, the
    lines of a Word file as one page, the visible text of an HTML page as one (for counties that read such)."""
    pages = F.col("pages") if "pages" in sources.columns else F.lit(None).cast("array<string>")
    reads_html = F.col("county").isin(*(s.county for s in SPECS.values() if s.html))
    markup = F.when((F.lower("extension") == "html") & reads_html, F.make_valid_utf8(F.col("content").cast("string")))
    word = F.when(F.lower("extension") == "docx", F.col("content"))
    lines = F.array_join(docx_lines(word), "\n")
    made = F.when(word.isNotNull() & (lines != ""), F.array(lines)).when(markup.isNotNull(), F.array(html_to_text(markup)))
    return sources.withColumn("pages", F.coalesce(made, pages))


def collapse_or_null(c: Column) -> Column:
    return F.nullif(collapse(c), F.lit(""))


def readable(sources: DataFrame) -> DataFrame:
    """Sources whose kind of file their county's parser reads; a page's is html."""
    kinds = {name: [*(e.lstrip(".") for e in spec.extensions), *(["html"] if spec.html else [])] for name, spec in SPECS.items()}
    read = F.create_map(*(x for name, found in sorted(kinds.items()) for x in (F.lit(name), F.array(*map(F.lit, found)))))
    return sources.where(F.coalesce(F.array_contains(F.try_element_at(read, F.col("county")), F.lower("extension")), F.lit(False)))


def extract_all(sources: DataFrame) -> DataFrame:
    """Rulings of sources of many counties (column county).

    Files come with their content, or with pages where these are known; `with_pages` gives each its pages, by its kind.
    They are cleaned and written once in folders of counties, so that each county's plan reads its own documents alone."""
    docs = with_pages(readable(sources)).drop("content") if "content" in sources.columns else sources
    parted = written(cleaned(docs.where(F.col("county").isin(*SPECS))), "documents", "county")
    there = {r["county"] for r in parted.select("county").distinct().collect()}  # at most as many as SPECS; from folder names
    plans = [_parsed(parted.where(F.col("county") == name), SPECS[name]) for name in sorted(there or list(SPECS)[:1])]
    return reduce(DataFrame.unionByName, plans)


def extensions_of(county: str) -> tuple[str, ...]:
    return SPECS[county].extensions if county in SPECS else (".pdf",)


def case_division(case_number: Column, default: Column | None = None) -> Column:
    """The division that a case number's letters tell, wherever they stand in it; else the default."""
    number = F.upper(blank(case_number))
    has = lambda *letters: F.array_contains(F.array(*(F.contains(number, F.lit(x)) for x in letters)), True)
    other = F.lit(None).cast("string") if default is None else default
    # Letters in order of precedence, and the divisions' names.
    return F.when(has("PR"), "Probate").when(has("FL"), "Family Law").when(has("CV", "CU", "CLJ", "CIV"), "Civil Law and Motion").otherwise(other)
