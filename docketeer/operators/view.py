"""The viewer's query: filters, search, sorting, paging, facets, histories."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketeer.functions import ids
from docketeer.functions.text import blank, csv_cell, first_filled
from docketeer.sources.shared import written

SEARCH_FIELDS = ("case_number", "case_title", "motion_type", "judge", "outcome", "outcome_text", "body_text")
SORT_COLUMNS = ("county", "hearing_date", "dept", "judge", "case_number", "case_title", "motion_type", "outcome")
PAGE_SIZES = (50, 100, 250, 500)
FACET_CAP = 200


def search_text(*fields: str) -> Column:
    """The filled fields, lower-cased and joined by spaces."""
    return F.lower(F.concat_ws(" ", *(F.nullif(F.col(f).cast("string"), F.lit("")) for f in fields)))


def wildcard_pattern(raw: str) -> str:
    """* as any run and ? as any one character of a line; all else stands for itself."""
    return "".join({"*": ".*", "?": "."}.get(c) or re.escape(c) for c in raw)


def search_matches(text: Column, raw: str | None) -> Column:
    """Substring search; with * or ? a pattern anywhere in the text."""
    raw = (raw or "").strip()
    if not raw:
        return F.lit(True)
    if "*" in raw or "?" in raw:
        return text.rlike("(?iu)" + wildcard_pattern(raw))
    return F.contains(text, F.lit(raw.lower()))


def date_matches(day: Column, first: str | None, last: str | None) -> Column:
    """Inclusive bounds on ISO text; a missing date is '': outside any lower bound, inside any upper one."""
    text, out = blank(day), F.lit(True)
    if first:
        out = out & (text >= first)
    if last:
        out = out & (text <= last)
    return out


def columns_match(filters: dict[str, list[str]]) -> Column:
    """Each column's value is in its set; an empty set matches nothing."""
    out = F.lit(True)
    for name, values in filters.items():
        out = out & (blank(F.col(name)).isin(*values) if values else F.lit(False))
    return out


def number_of(c: Column) -> Column:
    """The number that text stands for ('' is 0), or null."""
    text = F.trim(blank(c))
    return F.when(text == "", F.lit(0.0)).otherwise(text.try_cast("double"))


def sort_keys(column: str, direction: str, ties: list[str]) -> list[Column]:
    """Departments by number, then those that are none by text; other columns by text; ties by the given columns."""
    keys = [F.coalesce((number_of(F.col(column)).isNull()).cast("int"), F.lit(1)), number_of(F.col(column)), blank(F.col(column))] if column == "dept" else [blank(F.col(column))]
    return [k.asc() if direction == "asc" else k.desc() for k in keys] + [F.col(t).asc() for t in ties]


def hide_previous(rows: DataFrame, ident: str = "ruling_id", previous: str = "previous_version_id") -> DataFrame:
    """Rows that no other row names as its previous version."""
    named = rows.select(F.col(previous).alias(ident)).where(F.col(previous).isNotNull() & (F.col(previous) != "")).distinct()
    return rows.join(named, ident, "left_anti")


@dataclass
class ViewQuery:
    """A viewer state.  rows() is one plan: filters reach the scan, and only the page is sorted out of it."""

    counties: list[str] | None = None
    q: str = ""
    first: str | None = None
    last: str | None = None
    filters: dict[str, list[str]] = field(default_factory=dict)
    sort: str = "hearing_date"
    direction: str = "desc"
    page: int = 1
    page_size: int = 100
    search_fields: tuple[str, ...] = SEARCH_FIELDS
    date_column: str = "hearing_date"
    ties: tuple[str, ...] = ("ruling_id",)

    def filtered(self, rows: DataFrame) -> DataFrame:
        out = rows
        if self.counties is not None:
            out = out.where(F.col("county").isin(*self.counties) if self.counties else F.lit(False))
        if "previous_version_id" in out.columns:
            out = hide_previous(out)
        out = out.where(date_matches(F.col(self.date_column), self.first, self.last) & columns_match(self.filters))
        return out.where(search_matches(search_text(*(f for f in self.search_fields if f in out.columns)), self.q))

    def ordered(self, rows: DataFrame) -> DataFrame:
        known = self.sort in SORT_COLUMNS and self.direction in ("asc", "desc")
        column, direction = (self.sort, self.direction) if known else ("hearing_date", "desc")
        column = self.date_column if column == "hearing_date" else column
        return rows.orderBy(*sort_keys(column, direction, list(self.ties)))

    def rows(self, rows: DataFrame) -> DataFrame:
        size = self.page_size if self.page_size in PAGE_SIZES else 100
        return self.ordered(self.filtered(rows)).offset((max(1, self.page) - 1) * size).limit(size)

    def counts(self, rows: DataFrame) -> DataFrame:
        size = self.page_size if self.page_size in PAGE_SIZES else 100
        found = self.filtered(rows)
        return found.agg(F.count("*").alias("n_rows"), F.countDistinct("county").alias("n_counties"), F.greatest(F.lit(1), F.ceil(F.count("*") / size)).cast("long").alias("n_pages"))


def parse_state(params: dict[str, str], known: set[str]) -> ViewQuery:
    """A viewer address's parameters; unknown counties and sizes are dropped."""
    wanted = [c for c in (params.get("counties") or "").split(",") if c in known]
    counties = sorted(known) if params.get("counties") == "all" else wanted or None
    size = int(params["size"]) if (params.get("size") or "").isdigit() else 100
    page = int(params["page"]) if (params.get("page") or "").isdigit() else 1
    filters = {name[2:]: [v for v in value.split("|") if v] for name, value in params.items() if name.startswith("f_")}
    return ViewQuery(counties, params.get("q", ""), params.get("from") or None, params.get("to") or None, filters, params.get("sort", "hearing_date"), params.get("dir", "desc"), max(1, page), size if size in PAGE_SIZES else 100)


def page_count(total: int, size: int) -> int:
    return max(1, math.ceil(total / size))


def facet(rows: DataFrame, column: str) -> DataFrame:
    """Values with their counts, most frequent first, equal counts by value."""
    return rows.groupBy(blank(F.col(column)).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def facet_list(rows: DataFrame, column: str, needle: str = "", order: str = "count", cap: int = FACET_CAP) -> DataFrame:
    """The facet menu: values that contain the needle, by count or name, at most cap of them."""
    found = facet(rows, column).where(F.contains(F.lower("value"), F.lit(needle.lower())))
    by = {"count": [F.desc("n"), F.asc("value")], "az": [F.asc("value")], "za": [F.desc("value")]}[order]
    return found.orderBy(*by).limit(cap)


def case_history(rows: DataFrame, case_column: str = "case_number") -> DataFrame:
    """Every row that has a case number, with the number of rows of its case."""
    sizes = rows.where(blank(F.col(case_column)) != "").groupBy(case_column).agg(F.count("*").alias("n_history"))
    return rows.join(sizes, case_column)


def ordered_history(rows: DataFrame, ident: str = "ruling_id") -> DataFrame:
    """Every row of a case with place: its number in the case's history, latest hearing first, then by department
    (both falling, as one text); equal ones by id.  Rows without a case number have no history, and are left out."""
    at = F.concat(blank(F.col("hearing_date")), F.lit(" "), blank(F.col("dept")))
    return rows.where(blank(F.col("case_number")) != "").withColumn("place", F.row_number().over(Window.partitionBy("case_number").orderBy(at.desc(), ident)))


#: Columns with so many values that none is ticked at first.
MANY_VALUED = ("case_title",)


def ticked_filter(column: str, ticked: list[str], values: list[str]) -> list[str] | None:
    """The filter that ticked values of a menu make: None (no filter) if all are ticked, or none in a column of many
    values; an empty list, which matches nothing, if none is ticked in another column."""
    if len(set(ticked)) == len(set(values)) or (not ticked and column in MANY_VALUED):
        return None
    return list(ticked)


# The columns of an export, in order.
EXPORT_COLUMNS = (
    "id", "county", "dept", "judge", "hearing_date", "case_number", "case_title",
    "motion_type", "outcome", "conditional", "continued_to",
    "page_start", "page_end", "source_url",
)


def export_line(rows: DataFrame) -> Column:
    """A row as a line of CSV text; columns that rows lack are empty cells."""
    have = {c: F.col(c).cast("string") for c in rows.columns}
    if "judge" in have and "judge_name" in have:
        have["judge"] = first_filled(F.col("judge"), F.col("judge_name"))
    have["conditional"] = F.when(F.col("conditional"), "true").otherwise("false") if "conditional" in have else F.lit("false")
    cells = [csv_cell(have.get(c, F.lit(None).cast("string"))) for c in EXPORT_COLUMNS]
    return F.concat_ws(",", *cells)


def export_lines(rows: DataFrame) -> DataFrame:
    """rows as lines of CSV text (column line), without the head."""
    return rows.select(export_line(rows).alias("line"))


def export_rows(rows: DataFrame, counties: DataFrame) -> DataFrame:
    """Rulings with the export's id (the short one) and the county's label.

    counties: slug, label, code.  A county that it lacks keeps its slug, and the slug's first letters as its code."""
    names = counties.select(F.col("slug").alias("county"), F.col("label").alias("__label"), F.col("code").alias("__code"))
    code = F.coalesce("__code", F.upper(F.left("county", F.lit(3))))
    named = rows.join(names, "county", "left").withColumn("id", ids.short_id(code, F.col("hearing_date"), F.col("dept"), F.col("ruling_index")))
    return named.withColumn("county", F.coalesce("__label", "county")).drop("__label", "__code")


def write_export(rows: DataFrame, path: str, *order: str) -> None:
    """Write rows as CSV text in the folder path, in this order: the parts, one after the other, are one file.

    It begins with a byte-order mark and the columns' names; lines end in CRLF, the last one too.  No rows give the head."""
    spark = rows.sparkSession
    head = spark.range(1).select(F.lit(0).alias("__part"), *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order), F.lit("\ufeff" + ",".join(EXPORT_COLUMNS)).alias("line"))
    body = rows.select(F.lit(1).alias("__part"), *order, export_line(rows).alias("line"))
    place = [F.col("__part"), *(F.asc_nulls_first(c) for c in order)]
    head.unionByName(body).repartitionByRange(*place).sortWithinPartitions(*place).select("line").write.option("lineSep", "\r\n").text(path)


def version_depths(rows: DataFrame, ident: str, previous: str) -> DataFrame:
    """(ident, root, n_versions) of each row with a previous version: its oldest version and how many lie before it;
    null for rows whose versions go in a cycle.

    Pointer doubling: each round a row takes over what its furthest known ancestor knows, so that a chain of n rows
    takes log2(n) rounds, whatever its length; a row is one row in every round, never a pair with each ancestor.
    """
    links = rows.where(F.col(previous).isNotNull()).select(F.col(ident).alias("id"), F.col(previous).alias("at"))
    state = written(links.groupBy("id").agg(F.min("at").alias("at")).select("id", "at", F.lit(1).cast("long").alias("n"), F.lit(True).alias("open")), "versions")
    for _ in range(max(1, state.count()).bit_length() + 1):
        if state.where("open").isEmpty():
            break
        ahead = state.select(F.col("id").alias("__id"), F.col("at").alias("__at"), F.col("n").alias("__n"), F.col("open").alias("__open"))
        further = state.where("open").join(ahead, F.col("at") == F.col("__id"), "left")
        moved = further.select("id", F.coalesce("__at", "at").alias("at"), (F.col("n") + F.coalesce("__n", F.lit(0))).alias("n"), F.coalesce("__open", F.lit(False)).alias("open"))
        state = written(state.where("not open").union(moved), "versions")
    ended = lambda c: F.when(~F.col("open"), F.col(c))
    return state.select(F.col("id").alias(ident), ended("at").alias("root"), ended("n").alias("n_versions"))


def with_details(summaries: DataFrame, details: DataFrame, keys: tuple[str, ...] = ("county", "ruling_id")) -> DataFrame:
    """summaries with the other columns of details.  The plan fails on a summary whose detail is missing or doubled.

    The check is a filter, so that it holds whatever columns are read afterwards.  A detail without a summary is left out."""
    names = [c for c in details.columns if c not in keys]
    one = details.groupBy(*keys).agg(F.count("*").alias("__n"), F.first(F.struct(F.lit(1).alias("__x"), *names)).alias("__d"))
    said = F.concat_ws("/", *(F.col(k).cast("string") for k in keys))
    fails = lambda what: F.raise_error(F.concat(F.lit(what), said)).cast("boolean")
    whole = F.when(F.col("__n").isNull(), fails("no detail for ")).when(F.col("__n") > 1, fails("more than one detail for ")).otherwise(True)
    joined = summaries.select(*(c for c in summaries.columns if c not in names)).join(one, list(keys), "left").where(whole)
    return joined.select(*(c for c in summaries.columns if c not in names), *(F.col(f"__d.{c}").alias(c) for c in names))


#: Columns whose rows are sorted falling at first.
FALLING = ("hearing_date",)


def sorted_by(state: ViewQuery, column: str) -> ViewQuery:
    """The state after a click on a column's head: the other direction if it is sorted by that column, else the column's
    first direction.  Columns that can't be sorted by change nothing."""
    if column not in SORT_COLUMNS:
        return state
    first = "desc" if column in FALLING else "asc"
    return replace(state, sort=column, direction={"asc": "desc", "desc": "asc"}[state.direction] if state.sort == column else first)
