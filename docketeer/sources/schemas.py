"""Schemas of the engine's tables."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()), "pairs": T.MapType(T.StringType(), T.StringType()),
}


def struct(fields: str) -> T.StructType:
    """A schema from "name type" pairs; needs no session."""
    return T.StructType([T.StructField(*(n if i == 0 else _TYPES[n] for i, n in enumerate(f.split()))) for f in fields.split(",")])

CAPTURE = struct(
    "source_sha256 string, source_url string, discovered_filename string, fetched_at string, wayback_ts string, content_length long,"
    " dept_hint string, division_hint string, source_page_url string, source_format string, archive_extension string,"
    " county string, source_fetch_url string, date_hint string, label_hint string, page_title_hint string"
)
PAGE_CAPTURE = struct("archive_path string, captured_at string, content_key string, content_length long, county string, page_kind string, source_sha256 string, source_url string, title string")
LAYOUT_CAPTURE = struct("county string, source_sha256 string, source_url string, title string, captured_at string, content_length long, archive_path string, layout_version int")
FETCH_STATE = struct("kind string, url string, sha256 string, etag string, last_modified string, gone int, gone_since string, final boolean, index_row string")
PDF_REF = struct("url string, filename string, wayback_ts string, dept_hint string, division_hint string, link_text string, source_page_url string")
PAGE_REF = struct("url string, title string, page_kind string, source_url string, method string, data pairs, index_row string, prefetched_html string")
SOURCE_DOC = struct("county string, source_sha256 string, extension string, pages strings, ocr_pages strings")
RULING = struct(
    "ruling_id string, county string, division string, dept string, hearing_date date, ruling_index int, case_number string, case_title string,"
    " motion_type string, outcome string, outcome_text string, conditional boolean, continued_to date, body_text string, full_text string,"
    " page_start int, page_end int, source_sha256 string, source_url string, parser_version string, style string, ingest_ts timestamp"
)
COUNTY = struct("slug string, label string, code string")
RUN_SUMMARY = struct(
    "county string, discovered int, refs int, refs_not_modified int, refs_final_skipped int, pages_final_skipped int, skipped_known_wayback int,"
    " skipped_gone int, pages_discovered int, pages int, pages_unchanged int, pages_not_modified int, failures strings, skipped string, exception string"
)
ACCESS_EVENT = struct("browser_id string, address string, session_id string, doc_key string, ts timestamp, session_exp timestamp")
