"""HTML pages: text, links, index rows, content keys, layouts.

Links, content keys and masks are plain expressions; a tree walk (html_to_text) runs in an Arrow UDF.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from itertools import accumulate
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from docketeer.functions import urls
from docketeer.functions.text import clean_lines, collapse, mask

HREF = r"""(?i)<(?:a|area|iframe|embed|object)\s[^>]*?(?:href|src|data)\s*=\s*["']([^"']+)["']"""
DROPPED = (r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", r"(?is)<noscript\b.*?</noscript>", r"(?s)<!--.*?-->")
# The tags that start and end a line, and those whose content isn't shown.
BLOCKS = frozenset(("br", "div", "p", "li", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6", "hr"))
HIDDEN = frozenset(("script", "style", "noscript"))


def links(html: Column) -> Column:
    """Addresses of links and embedded documents, in order, repeats included."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(HREF), 1)


def exploded_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row a link: key, position, url."""
    return pages.select(key, F.posexplode(links(F.col(html))).alias("position", "url"))


def visible_text(html: Column) -> Column:
    """Text without scripts, styles, comments and tags; entities stay."""
    out = F.coalesce(html, F.lit(""))
    for pattern in DROPPED:
        out = F.regexp_replace(out, pattern, " ")
    return collapse(F.regexp_replace(out, "<[^>]*>", " "))


def content_key(html: Column) -> Column:
    """The same for pages with the same visible text and links, whatever their markup."""
    return F.sha2(F.concat_ws("\n", visible_text(html), F.array_join(links(html), "\n")), 256)


def index_rows(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """Table rows with a link: key, the first link of the row, the row's text; the first row of each link counts."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b.*?</tr>"), 0)).alias("position", "row"))
    named = rows.select(key, "position", F.get(links(F.col("row")), F.lit(0)).alias("href"), visible_text(F.col("row")).alias("row_text")).where("href is not null")
    return named.groupBy(key, "href").agg(F.min_by("row_text", "position").alias("row_text"))


def layout(html: Column) -> Column:
    """Masked, sorted and counted forms of a page's tags and links: equal for pages of one layout."""
    classes = F.transform(F.regexp_extract_all(html, F.lit(r"""(?i)<([a-z0-9]+)[^>]*?class\s*=\s*["']([^"']*)["']"""), 2), lambda x: mask(x))
    paths = F.transform(links(html), lambda x: mask(F.regexp_replace(x, r"^https?://[^/]*", "")))
    some = lambda a, n: F.slice(F.array_sort(F.array_distinct(a)), 1, n)
    return F.struct(some(classes, 120).alias("classes"), some(paths, 40).alias("paths"), F.size(F.regexp_extract_all(html, F.lit("(?i)<form\\b"), 0)).alias("forms"), F.size(F.regexp_extract_all(html, F.lit("(?i)<table\\b"), 0)).alias("tables"))


class _Markup(HTMLParser):
    """A page as a flat list of what it is made of: (START, tag, attributes), (END, tag, None), (DATA, text, None)."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[tuple[int, str, dict | None]] = []
        self.handle_starttag = lambda tag, attrs: self.items.append((START, tag, dict(attrs)))
        self.handle_endtag = lambda tag: self.items.append((END, tag, None))
        self.handle_data = lambda text: self.items.append((DATA, text, None))
        self.feed(page)
        self.close()


START, END, DATA = range(3)


@F.pandas_udf(StringType())
def _shown(pages: pd.Series) -> pd.Series:
    """Text outside of HIDDEN, with a line end for each BLOCKS tag."""

    def one(page: str | None) -> str:
        out, depth = [], 0
        for kind, what, _ in _Markup(page or "").items:
            if kind == DATA:
                out.append("" if depth else what)
            elif what in HIDDEN and (kind == START or depth):
                depth += 1 if kind == START else -1
            elif what in BLOCKS:
                out.append("\n")
        return "".join(out)

    return pages.map(one, na_action=None)


def html_to_text(page: Column | str) -> Column:
    """Lines of visible text: BLOCKS start and end lines, at most one empty line in a row; null is ''."""
    return clean_lines(_shown(F.col(page) if isinstance(page, str) else page))


def _opened(item: tuple) -> str | None:
    """The address of a link or list entry that starts here."""
    kind, tag, attrs = item
    return attrs.get({"a": "href", "option": "value"}.get(tag, "")) or None if kind == START else None


def _select_names(names: tuple[str, ...], item: tuple) -> tuple[str, ...]:
    """The names of the lists that are open after the item, when these were open before it."""
    kind, tag, attrs = item
    if tag != "select" or kind == DATA:
        return names
    return (*names, attrs.get("name") or attrs.get("id") or "") if kind == START else names[:-1]


def _spans(page: str) -> list[tuple]:
    """(tag, address, text, list): links up to their own end tag; one in which another starts is none."""
    items = _Markup(page).items
    places = [i for i, item in enumerate(items) if _opened(item)]
    lists = list(accumulate(items, _select_names, initial=()))
    out = []
    for at, until in zip(places, [*places, len(items)][1:], strict=True):
        tag = items[at][1]
        end = next((i for i in range(at + 1, until) if items[i][:2] == (END, tag)), None)
        if end is not None:
            text = "".join(what for kind, what, _ in items[at + 1 : end] if kind == DATA)
            out.append((tag, _opened(items[at]), " ".join(text.split()), lists[at][-1] if tag == "option" and lists[at] else None))
    return out


# Fixed value: links to PDF and Word files in Markdown text.
_MARKDOWN = re.compile(
    r"\[(?P<text>[^\]]*)\]\("
    r"(?P<url>[^)\s]+?\.(?:pdf|docx)(?:\?[^)\s]*)?)"
    r"(?:\s+(?:\"[^\"]*\"|'[^']*'|[^)]*))?"
    r"\)",
    re.IGNORECASE,
)


def _joined(base: str, address: str) -> str:
    try:
        return urljoin(base, address)
    except ValueError:  # an address that can't be joined stands for itself
        return address


def _all_links(page: str, base: str) -> list[tuple]:
    written = dict.fromkeys(("markdown", m["url"], " ".join(m["text"].split()), None) for m in _MARKDOWN.finditer(page))
    return [(tag, address, _joined(base, address), text, of) for tag, address, text, of in [*_spans(page), *written]]


_LINK = StructType([StructField(name, StringType()) for name in ("tag", "href", "url", "text", "list")])


@F.pandas_udf(ArrayType(_LINK))
def link_rows(pages: pd.Series, bases: pd.Series) -> pd.Series:
    """Anchors, options and Markdown links of pages, with absolute addresses and texts."""
    rows = [[dict(zip(_LINK.names, row)) for row in _all_links(markup or "", base or "")] for markup, base in zip(pages, bases)]
    return pd.Series(rows, index=pages.index, dtype=object)


def page_links(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """One row a link: key, position, tag, href, url (absolute), text, list (of options), page_url."""
    found = pages.select(F.col(key), F.col(url).alias("page_url"), F.posexplode(link_rows(html, url)).alias("position", "x"))
    return found.select(key, "position", "x.tag", "x.href", "x.url", "x.text", "x.list", "page_url")


def static_refs(links: DataFrame, hosts: list[str], key: str = "page_id", path: str | None = None, text: str | None = None, division: str | None = None) -> DataFrame:
    """References to PDF files among links, on the hosts, perhaps with a pattern for their path or text: one row an
    address, its first place on its page."""
    wanted = urls.host_of(F.col("url")).isin(*hosts) & F.contains(F.lower("href"), F.lit(".pdf"))
    for pattern, column in ((path, urls.path_of(F.col("url"))), (text, F.col("text"))):
        wanted = wanted & (column.rlike(pattern) if pattern else F.lit(True))
    refs = links.where(wanted).groupBy(key, "url").agg(F.min_by(F.struct("position", "text", "page_url"), "position").alias("x"))
    named = refs.select(key, "x.position", "url", urls.filename_of(F.col("url"), "tentative-ruling.pdf").alias("filename"), F.col("x.text").alias("link_text"), F.col("x.page_url").alias("source_page_url"))
    return named.withColumn("division_hint", F.lit(division).cast("string"))


def cdx_rows(payload: DataFrame, column: str = "body") -> DataFrame:
    """Index listings (a JSON array of arrays with a header first) as one map per row."""
    parsed = payload.select("*", F.from_json(column, "array<array<string>>").alias("__all"))
    rows = parsed.select(*payload.columns, F.get("__all", F.lit(0)).alias("__head"), F.posexplode("__all").alias("position", "__row"))
    whole = rows.where((F.col("position") > 0) & (F.size("__row") == F.size("__head")))
    return whole.select(*payload.columns, "position", F.map_from_arrays("__head", "__row").alias("row"))


def pdf_in_json(body: Column) -> Column:
    """The document that a JSON answer carries in base64."""
    return F.unbase64(F.get_json_object(body, "$.data.contents"))


def unescape_hex(c: Column) -> Column:
    """Script text with \\xNN escapes of JSON punctuation as plain characters."""
    out = c
    for code, char in (("22", '"'), ("5b", "["), ("5d", "]"), ("7b", "{"), ("7d", "}"), ("3d", "="), ("2f", "/"), ("26", "&"), ("27", "'"), ("3c", "<"), ("3e", ">")):
        out = F.replace(out, F.lit("\\x" + code), F.lit(char))
    return F.replace(out, F.lit("\\/"), F.lit("/"))
