"""Text expressions: whitespace, excerpts, masks, guards."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, and the separators U+001C to U+001F, which count as such too.
SPACE = r"(?U)[\s\x1c-\x1f]"
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank(c: Column) -> Column:
    """Null as the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def collapse(c: Column) -> Column:
    """Every run of white space (Unicode and U+001C to U+001F) as one space, none at the ends; null as ''."""
    return F.trim(F.regexp_replace(blank(c), r"(?U)[\s\x1c-\x1f]+", " "))


def strip(c: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(blank(c), rf"^{SPACE}+|{SPACE}+\z", "")


def lines_of(c: Column) -> Column:
    """Lines without their ends, of any kind; an end of line at the text's end starts none.  Null has no lines."""
    return let(F.split(blank(c), LINE_END), lambda a: F.when(F.element_at(a, -1) == "", F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(a))


@lru_cache(maxsize=1)
def _references() -> tuple[str, str, tuple[str, ...]]:
    """Of HTML's character references: names to text, numbers that don't stand for themselves to text (both as JSON),
    and names that need no semicolon, longest first.

    Numbers 128 to 159 are read as Windows-1252; control characters and non-characters are dropped."""
    numbers = {0: "\ufffd", 13: "\r"} | {n: "" for n in (*range(1, 9), 11, *range(14, 32), 127, *range(0xFDD0, 0xFDF0))} | {plane << 16 | n: "" for plane in range(17) for n in (0xFFFE, 0xFFFF)}
    for n in range(128, 160):
        try:
            numbers[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            numbers[n] = chr(n)
    short = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
    return json.dumps(html5), json.dumps(numbers), tuple(short)


def unescape(c: Column) -> Column:
    """Text with HTML's character references decoded, all of them once, as browsers do; null as ''."""
    names, numbers, short = _references()
    known, special = F.from_json(F.lit(names), "map<string,string>"), F.from_json(F.lit(numbers), "map<string,string>")

    def number(piece: Column) -> Column:
        digits = F.regexp_replace(piece, "^&#[xX]?0*|;$", "")
        value = F.when(F.length(digits) > 7, F.lit(0x110000)).when(piece.rlike("^&#[xX]"), F.conv(digits, 16, 10).try_cast("int")).otherwise(digits.try_cast("int"))
        return let(
            F.coalesce(value, F.lit(0)),
            lambda n: F.coalesce(F.try_element_at(special, n.cast("string")), F.when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))),
        )

    def name(piece: Column) -> Column:
        text = F.substring(piece, 2, 40)
        start = F.get(F.filter(F.array(*map(F.lit, short)), lambda x: F.startswith(text, x)), F.lit(0))
        return F.coalesce(F.try_element_at(known, text), let(start, lambda x: F.concat(F.try_element_at(known, x), F.substring(text, F.length(x) + 1, F.lit(40)))), piece)

    def decoded(piece: Column) -> Column:
        return F.when(piece.rlike(r"^&#[0-9]|^&#[xX][0-9a-fA-F]"), number(piece)).when(F.startswith(piece, F.lit("&")) & (F.length(piece) > 1), name(piece)).otherwise(piece)

    pieces = F.regexp_extract_all(blank(c), F.lit(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"), F.lit(0))
    return F.when(F.contains(blank(c), F.lit("&")), F.array_join(F.transform(pieces, decoded), "")).otherwise(blank(c))


def tidy_lines(c: Column) -> Column:
    """Line ends as LF, blanks in lines collapsed and none at their ends, at most one empty line in a row, trimmed."""
    out = F.translate(blank(c), " ", " ")
    for pattern, to in (("\r\n?", "\n"), (r"[ \t\f\x0B]+", " "), (r"\n[ \t]+", "\n"), (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n")):
        out = F.regexp_replace(out, pattern, to)
    return strip(out)


def clean_lines(c: Column) -> Column:
    """Character references decoded, then tidy_lines()."""
    return tidy_lines(unescape(c))


def clip(c: Column, limit: int) -> Column:
    """Collapsed text; if longer than limit, cut at the last space within it (when past the middle) and marked."""

    def cut(text: Column) -> Column:
        head = F.substring(text, 1, limit)
        at = F.length(head) - F.length(F.substring_index(head, " ", -1)) - 1
        short = F.when(at > limit // 2, F.substring(head, F.lit(1), at)).otherwise(head)
        return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.rtrim(short), F.lit("…")))

    return let(collapse(c), cut)


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor ''; else ''."""
    return F.coalesce(*(F.nullif(blank(c), F.lit("")) for c in columns), F.lit(""))


def alnum_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(blank(c)), "[^a-z0-9]", "")


def class_token(c: Column, default: str = "other") -> Column:
    """A lower-case token of letters and digits joined by single hyphens."""
    token = F.regexp_replace(F.regexp_replace(F.lower(blank(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(token, F.lit("")), F.lit(default))


def html_escape(c: Column) -> Column:
    out = blank(c)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def csv_guard(c: Column) -> Column:
    """A cell that a spreadsheet won't take as a formula."""
    return F.when(blank(c).rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), blank(c))).otherwise(blank(c))


def csv_cell(c: Column) -> Column:
    """The guarded cell, quoted where it holds a quote, comma or line end."""
    cell = csv_guard(c)
    return F.when(cell.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(cell)


def mask(c: Column, limit: int = 180) -> Column:
    """Lower case with hashes, dates and numbers as place holders: equal for pages of one layout."""
    out = F.lower(collapse(c))
    for pattern, to in ((r"\b[0-9a-f]{16,}\b", "{hash}"), (r"\b[0-9]{1,4}[-/_.][0-9]{1,2}[-/_.][0-9]{1,4}\b", "{date}"), (r"[0-9]+", "{number}")):
        out = F.regexp_replace(out, pattern, to)
    return F.left(out, F.lit(limit))


def format_count(c: Column) -> Column:
    """1234567 as 1,234,567."""
    return F.format_number(c.cast("long"), 0)


def page_range(start: Column, end: Column) -> Column:
    """p. 3 or pp. 3-5; '' without a page."""
    return F.when(start.isNull() | (start < 1), "").when(end.isNull() | (end <= start), F.concat(F.lit("p. "), start)).otherwise(F.concat(F.lit("pp. "), start, F.lit("-"), end))
