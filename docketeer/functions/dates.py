"""Dates in text.  A date that the calendar lacks gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketeer.functions.text import collapse, let

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
_MONTH, _WEEKDAY = "|".join(MONTHS), "|".join(WEEKDAYS)

LONG = rf"(?i)\b({_MONTH})\s+([0-9]{{1,2}}),?\s+([0-9]{{4}})\b"
NUMERIC = r"\b([0-9]{1,2})/([0-9]{1,2})/([0-9]{2,4})\b"
ISO = r"\b(20[0-9]{2})-([0-9]{1,2})-([0-9]{1,2})\b"


def make_date(year: Column, month: Column, day: Column) -> Column:
    """A date of numbers as text; null if there is none."""
    return F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")


def full_year(c: Column) -> Column:
    """Two digits below 70 are in the 2000s, from 70 on in the 1900s."""
    n = c.try_cast("int")
    return F.when(n < 70, n + 2000).when(n < 100, n + 1900).otherwise(n).cast("string")


def month_number(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for number, month in enumerate(MONTHS, 1):
        out = F.when(F.lower(name) == month, str(number)).otherwise(out)
    return out


def _iso(c: Column) -> Column:
    return make_date(*(F.regexp_extract(c, ISO, i) for i in (1, 2, 3)))


def _numeric(c: Column) -> Column:
    return make_date(full_year(F.regexp_extract(c, NUMERIC, 3)), F.regexp_extract(c, NUMERIC, 1), F.regexp_extract(c, NUMERIC, 2))


def _long(c: Column) -> Column:
    return make_date(F.regexp_extract(c, LONG, 3), month_number(F.regexp_extract(c, LONG, 1)), F.regexp_extract(c, LONG, 2))


def parse_date(c: Column) -> Column:
    """The date in a short text: ISO, then month/day/year, then "Month day, year"; weekday and ordinal ending ignored."""
    text = F.regexp_replace(collapse(c), rf"(?i)^(?:{_WEEKDAY})\s*,?\s+", "")
    text = F.regexp_replace(text, r"([0-9]{1,2})\s*,\s*([0-9]{4})", "$1, $2")
    text = F.regexp_replace(text, r"(?i)([0-9]{1,2})\s+(st|nd|rd|th)\b", "$1")
    return let(text, lambda x: F.when(x.rlike(ISO), _iso(x)).when(x.rlike(NUMERIC), _numeric(x)).when(x.rlike(LONG), _long(x)))


def find_date(c: Column) -> Column:
    """The first date of the first kind that the text has: weekday and long, long, numeric, ISO."""
    kinds = (rf"(?i)\b(?:{_WEEKDAY})\s*,?\s+(?:{_MONTH})\s+[0-9]{{1,2}},?\s+[0-9]{{4}}\b", LONG, NUMERIC, ISO)
    return F.coalesce(*(parse_date(F.regexp_extract(c, kind, 0)) for kind in kinds))


def parse_time(c: Column) -> Column:
    """An ISO time as a timestamp (UTC if it names no zone); null if it is none."""
    return F.try_to_timestamp(F.regexp_replace(c, "T", " "))


def continued_to(c: Column) -> Column:
    """The date after "continued to" or "continued until"."""
    return parse_date(F.regexp_extract(c, rf"(?i)continued\s+(?:to|until)\s+([A-Za-z]+ [0-9]{{1,2}},? [0-9]{{4}}|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2,4}})", 1))


#: Where an address may carry a date: compact, dashed year first, dashed month first, month name, two-digit year.
URL_DATES = (
    (r"(20[0-9]{2})([01][0-9])([0-3][0-9])", (1, 2, 3)),
    (r"(20[0-9]{2})[-_.]([0-9]{1,2})[-_.]([0-9]{1,2})", (1, 2, 3)),
    (r"([0-9]{1,2})[-_.]([0-9]{1,2})[-_.](20[0-9]{2})", (3, 1, 2)),
    (rf"(?i)({_MONTH})[-_ ]([0-9]{{1,2}})[-_ ,]+(20[0-9]{{2}})", (3, 1, 2)),
    (r"([0-9]{1,2})[-_.]([0-9]{1,2})[-_.]([0-9]{2})(?![0-9])", (3, 1, 2)),
)


def url_date(c: Column) -> Column:
    found = []
    for pattern, (y, m, d) in URL_DATES:
        month = F.regexp_extract(c, pattern, m)
        found.append(make_date(full_year(F.regexp_extract(c, pattern, y)), F.coalesce(month_number(month), month), F.regexp_extract(c, pattern, d)))
    return F.coalesce(*found)


def page_hearing_date(url: Column, title: Column) -> Column:
    """The date in the address as month/day/year, else in the title."""
    return F.coalesce(_numeric(F.coalesce(url, F.lit(""))), _long(F.coalesce(title, F.lit(""))))


def utc_day(ts: Column) -> Column:
    return F.to_date(ts)


def seconds_to_midnight(ts: Column) -> Column:
    seconds = F.unix_micros(ts.cast("timestamp")) / 1_000_000
    return F.ceil(F.lit(86400) - seconds % 86400).cast("long")


def hour_of(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / 3_600_000_000).cast("long")
