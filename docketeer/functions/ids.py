"""Identity: ruling ids, logical keys, short ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketeer.functions.text import blank, collapse, first_filled


def ruling_id(*parts: Column) -> Column:
    """The first 32 hex digits of the SHA-256 of the parts joined by colons (null as '')."""
    return F.substring(F.sha2(F.concat_ws(":", *(blank(p) for p in parts)), 256), 1, 32)


def logical_key(county: Column, case_number: Column, hearing_date: Column, motion_type: Column, body_text: Column) -> Column:
    """What makes two rows the same ruling, whatever source they came from."""
    parts = {"county": county, "case_number": F.upper(blank(case_number)), "hearing_date": hearing_date, "motion_type": motion_type, "body_text": body_text}
    return F.struct(*(collapse(c).alias(name) for name, c in parts.items()))


def short_id(code: Column, hearing_date: Column, dept: Column, index: Column) -> Column:
    """CODE-YYMMDD-Ddept-seq; six zeros for no date, ? for no dept or index.  Not unique."""
    day = F.coalesce(F.date_format(hearing_date, "yyMMdd"), F.lit("000000"))
    seq = F.coalesce(index.cast("string"), F.lit("?"))
    return F.concat(F.upper(blank(code)), F.lit("-"), day, F.lit("-D"), first_filled(dept, F.lit("?")), F.lit("-"), seq)


def row_key(row_id: Column, ruling: Column, short: Column) -> Column:
    return first_filled(row_id, ruling, short)


def document_key(path: Column) -> Column:
    """ruling:<county>/<id> of a detail or slice path, with or without a ref before it; null for other paths."""
    pattern = r"(?:^|/)data/([a-z_]+)/(?:ruling-text/[0-9a-f]{2}|rulings)/([0-9a-f]{32})\.(?:json|pdf)$"
    county, ident = (F.regexp_extract(path, pattern, i) for i in (1, 2))
    return F.when(ident != "", F.concat(F.lit("ruling:"), county, F.lit("/"), ident))


def fallback_url(county: Column, sha: Column, extension: Column) -> Column:
    return F.concat(F.lit("archive://"), county, F.lit("/"), sha, extension)
