"""Addresses: hosts, file names, years, routes, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST = r"^https?://(?:[^/@]*@)?([^/:?#]+)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def has_credentials(url: Column) -> Column:
    return url.rlike(r"^https?://[^/@]*@")


def host_allowed(url: Column, hosts: list[str]) -> Column:
    """An http(s) address without credentials whose host is one of hosts or below one."""
    host = host_of(url)
    named = F.lit(False)
    for allowed in hosts:
        named = named | (host == allowed) | host.endswith("." + allowed)
    return F.coalesce(url.rlike("^https?://") & ~has_credentials(url) & named, F.lit(False))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1)


def filename_of(url: Column, default: str = "source.pdf") -> Column:
    name = F.coalesce(F.try_url_decode(F.regexp_extract(path_of(url), "([^/]*)$", 1)), F.lit(""))
    return F.when(name == "", default).otherwise(name)


def url_year(url: Column) -> Column:
    """The year that is a whole segment of the path; null without one."""
    return F.nullif(F.regexp_extract(path_of(url), r"/((?:19|20)[0-9]{2})(?:/|$)", 1), F.lit("")).cast("int")


def in_years(url: Column, first: int | None, last: int | None) -> Column:
    """Addresses without a year stay."""
    year, inside = url_year(url), F.lit(True)
    if first is not None:
        inside = inside & (year >= first)
    if last is not None:
        inside = inside & (year <= last)
    return year.isNull() | inside


def is_route(path: Column) -> Column:
    """Paths that may be served: index, summary and, where the prefix is that of the id, detail records and slices."""
    plain = path.rlike(r"^/(?:data/[a-z_]+/(?:summary|_viewer)\.json|counties\.json)$")
    pattern = r"^/data/[a-z_]+/ruling-text/([0-9a-f]{2})/([0-9a-f]{32})\.json$"
    return plain | ((F.regexp_extract(path, pattern, 2) != "") & (F.regexp_extract(path, pattern, 1) == F.left(F.regexp_extract(path, pattern, 2), F.lit(2))))


def archive_path_safe(path: Column, county: Column) -> Column:
    """A relative path inside archive/<county>/pages without parent segments."""
    return F.coalesce(~path.startswith("/") & ~path.rlike(r"(?:^|/)\.\.(?:/|$)") & ~path.rlike(r"\\") & path.startswith(F.concat(F.lit("archive/"), county, F.lit("/pages/"))), F.lit(False))


def address_key(address: Column) -> Column:
    """IPv4 as it is (also where mapped into IPv6), IPv6 by its first four groups."""
    mapped = F.regexp_extract(F.lower(address), r"^::ffff:([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+)$", 1)
    left, right = F.split(F.lower(address), "::", 2), F.lower(address).contains("::")
    head = F.filter(F.split(F.element_at(left, 1), ":"), lambda x: x != "")
    tail = F.filter(F.split(F.when(right, F.element_at(left, 2)).otherwise(F.lit("")), ":"), lambda x: x != "")
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(head) - F.size(tail), F.lit(0)))
    groups = F.transform(F.slice(F.concat(head, zeros, tail), 1, 4), lambda x: F.coalesce(F.nullif(F.regexp_replace(x, "^0+", ""), F.lit("")), F.lit("0")))
    return F.when(mapped != "", mapped).when(~address.contains(":"), address).otherwise(F.concat(F.array_join(groups, ":"), F.lit("::/64")))


def wayback_stamp(from_year: int | None, to_year: int | None) -> str | None:
    """The end of the last wanted year before the start of the first one."""
    return f"{to_year}1231235959" if to_year else f"{from_year}0101000000" if from_year else None


def replay_url(stamp: Column, url: Column) -> Column:
    return F.concat(F.lit("https://web.archive.org/web/"), stamp, F.lit("id_/"), url)


def page_link(url: Column, page: Column) -> Column:
    """The address of a page: #page=N for PDF files only."""
    return F.when(F.lower(path_of(url)).endswith(".pdf") & (page > 0), F.concat(url, F.lit("#page="), page)).otherwise(url)


def safe_http(url: Column) -> Column:
    return F.when(url.rlike(r"^https?://[^\s]+$"), url).otherwise("")
