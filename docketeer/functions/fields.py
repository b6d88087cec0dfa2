"""What headers and forms say: labelled values, divisions, departments, case numbers, statuses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketeer.functions.text import blank, collapse, let, strip


def labelled_values(lines: Column, labels: list[str]) -> Column:
    """A map of every label to the lines after its first occurrence, up to the next line that is a label, joined by
    line ends.  A label that no line is has the empty text; null lines have all labels so."""
    marks = F.filter(F.transform(F.coalesce(lines, F.array().cast("array<string>")), lambda line, i: F.struct(i.alias("i"), line.alias("line"))), lambda x: x["line"].isin(*labels))

    def value(found: Column, label: str) -> Column:
        first = F.get(F.filter(found, lambda x: x["line"] == label), F.lit(0))["i"]
        after = let(first, lambda i: F.coalesce(F.get(F.filter(found, lambda x: x["i"] > i), F.lit(0))["i"], F.size(lines)))
        return F.when(first.isNull(), "").otherwise(F.array_join(F.slice(lines, first + 2, after - first - 1), "\n"))

    return let(marks, lambda found: F.map_from_arrays(F.array(*map(F.lit, labels)), F.array(*(value(found, label) for label in labels))))


# By county, words of a header in order of precedence, and the division that each one tells.
DIVISION_WORDS = {
    "el_dorado": (
        (("PROBATE",), "Probate"),
        (("LAW AND MOTION", "LAW & MOTION", "LAW AMP; MOTION"), "Law and Motion"),
        (("FAMILY",), "Family Law"),
        (("CIVIL",), "Civil"),
        (("CRIMINAL",), "Criminal"),
    ),
    "orange": (
        (("PROBATE",), "Probate"),
        (("FAMILY",), "Family Law"),
        (("CIVIL", "LAW AND MOTION"), "Civil"),
    ),
}
DEPARTMENT_WORDS = (
    "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
    "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "twenty-one", "twenty-two",
    "twenty-three", "twenty-four", "twenty-five",
)


def header_division(header: Column, county: str, hint: Column | None = None) -> Column:
    """The division that a header's words tell by the county's list; else the hint."""
    text = F.upper(blank(header))
    text = F.regexp_replace(text, r"(?U)\s+", " ") if county == "el_dorado" else text
    out = F.lit(None).cast("string") if hint is None else hint
    for words, name in reversed(DIVISION_WORDS[county]):
        out = F.when(F.array_contains(F.array(*(F.contains(text, F.lit(w)) for w in words)), True), name).otherwise(out)
    return out


def department(c: Column, last: int = len(DEPARTMENT_WORDS)) -> Column:
    """A department's name without blanks and full stops around it, number words up to `last` as digits; '' is null."""
    text = F.regexp_replace(collapse(c), r"^[ .]+|[ .]+\z", "")
    numbers = F.create_map(*(F.lit(x) for i, word in enumerate(DEPARTMENT_WORDS[:last], 1) for x in (word, str(i))))
    return F.when(blank(c) != "", F.coalesce(F.try_element_at(numbers, F.lower(text)), text))


def case_number(c: Column, county: str) -> Column:
    """The county's one way of writing a case number."""
    text = strip(c)
    white = r"(?U)[\s\x1c-\x1f]"
    if county == "amador":
        return F.regexp_replace(text, rf"{white}+", "-")
    if county == "orange":
        plain = F.regexp_replace(F.regexp_replace(F.translate(text, "–", "-"), rf"{white}*-{white}*", "-"), rf"{white}+", "")
        return F.regexp_replace(F.regexp_replace(plain, "-+", "-"), r"-+\z", "")
    if county == "san_bernardino":
        return F.upper(F.regexp_replace(blank(c), rf"{white}+", ""))
    return text


def http_status(c: Column) -> Column:
    """The status code that an error line tells, or null."""
    return F.regexp_extract(blank(c), r"\b([1-5][0-9]{2}) (?:Client|Server) Error", 1).try_cast("int")
