"""From archive and logs to the ruling warehouse, as one plan per county batch.

The order matters: sources that are already represented leave before anything reads their content; hashes are checked
before parsing; rows are deduplicated by first source, then against the warehouse, and only then written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.functions import ids
from docketeer.operators import dedupe, parsing, readers, warehouse  # noqa: F401  readers register with parsing
from docketeer.sources import logs
from docketeer.sources.shared import written


def _key(prefix: str = ""):
    return ids.logical_key(*(F.col(prefix + c) for c in ("county", "case_number", "hearing_date", "motion_type", "body_text")))


def _named(docs: DataFrame, captures: DataFrame) -> DataFrame:
    """docs with what the log's last line on each says: address and hints, and the line itself as JSON (capture)."""
    last = logs.last_by(captures, "source_sha256")
    line = F.to_json(F.struct(*(c for c in last.columns if c != "line_no"))).alias("capture")
    hints = last.select("source_sha256", "source_url", "dept_hint", "division_hint", line)
    own = F.concat(F.lit("archive://"), F.col("county"), F.lit("/"), F.col("source_sha256"), F.lit("."), F.col("extension"))
    return docs.join(hints, "source_sha256", "left").withColumn("source_url", F.coalesce("source_url", own))


def new_rulings(docs: DataFrame, captures: DataFrame, existing: DataFrame | None, county: str | None = None, reparse: bool = False) -> DataFrame:
    """Rows to add, of one county or (None) of all.

    docs: county, source_sha256, extension and pages, or content, from which pages are made; captures: a log with line_no.
    """
    left = docs if county is None else docs.where(F.col("county") == county) if "county" in docs.columns else docs.withColumn("county", F.lit(county))
    left = parsing.readable(left)
    if existing is not None and not reparse:
        left = left.join(existing.select("source_sha256").distinct(), "source_sha256", "left_anti")
    named = _named(left, captures)
    if "content" in named.columns:
        named = parsing.with_pages(named).drop("content")
    rows = parsing.extract_all(named) if county is None else parsing.extract(named, parsing.SPECS[county])
    keyed = rows.withColumn("ingest_ts", F.current_timestamp()).withColumn("__logical", dedupe.digest(_key()))
    parsed = written(keyed, "rulings")  # documents are parsed once, whatever reads them
    rows = dedupe.first_source_wins(parsed, F.col("__logical"), "source_sha256").drop("__logical")
    return rows if existing is None or reparse else dedupe.new_rows(rows, existing, _key(), _key())


def merged_rulings(existing: DataFrame | None, new: DataFrame, reparse: bool = False) -> DataFrame:
    """The county's table after the run: replaced when all is parsed again, else added to."""
    return new if existing is None or reparse else warehouse.merged(existing, new)
