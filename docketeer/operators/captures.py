"""What the capture logs say: latest captures, replaced and final addresses, and what to fetch next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketeer.functions.dates import parse_time
from docketeer.functions.text import blank, first_filled
from docketeer.sources.shared import written


def latest(rows: DataFrame, key: str, ts: str, line: str, ties: str = "first") -> DataFrame:
    """The row of the greatest ts of each key; of equal ones the first or the last line."""
    sign = -1 if ties == "first" else 1
    others = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(F.col(ts), (F.col(line) * sign).alias("l"))).alias("__row"))
    return best.select(key, "__row.*").select(rows.columns)


def ever_replaced(rows: DataFrame, url: str, version: str) -> DataFrame:
    """Addresses with more than one version."""
    per = rows.groupBy(url).agg(F.countDistinct(version).alias("versions"))
    return per.where("versions > 1")


def pages_final(rows: DataFrame, group: str, url: str, version: str, ts: str, days: int = 14) -> DataFrame:
    """Whether no address of the group ever had two versions and its oldest capture is days older than the log's newest."""
    per = rows.where(F.col(ts).isNotNull()).groupBy(group, url).agg(F.min(version).alias("a"), F.max(version).alias("b"), F.min(ts).alias("oldest"))
    seen = per.groupBy(group).agg(F.bool_and(F.col("a").eqNullSafe(F.col("b"))).alias("__same"), F.min("oldest").alias("__oldest"))
    now = rows.agg(F.max(ts).alias("__now"))  # one row
    return seen.join(F.broadcast(now)).select(group, (F.col("__same") & (F.col("__oldest") <= F.col("__now") - F.make_dt_interval(F.lit(days)))).alias("final"))


def changes(rows: DataFrame, url: str, version: str, *order: str) -> DataFrame:
    """Rows whose version differs from that before it at their address; the first of each address counts."""
    before = F.lag(version).over(Window.partitionBy(url).orderBy(*order))
    numbered = F.row_number().over(Window.partitionBy(url).orderBy(*order))
    marked = rows.withColumn("__before", before).withColumn("__n", numbered)
    return marked.where((F.col("__n") == 1) | ~F.col("__before").eqNullSafe(F.col(version))).drop("__before", "__n")


def known_skipped_then_limited(refs: DataFrame, known: DataFrame, keys: list[str], group: str, order: str, n: int) -> DataFrame:
    """References that the log lacks, the first n of each group: known ones don't use up the limit."""
    left = refs.join(known.select(*keys).distinct(), keys, "left_anti")
    place = Window.partitionBy(group).orderBy(order)
    return left.withColumn("__n", F.row_number().over(place)).where(F.col("__n") <= n).drop("__n")


def fetch_decision(gone: Column, final: Column, has_state: Column, has_capture: Column, index_same: Column) -> Column:
    """What to do with a reference: skip those gone or final, or whose index row is unchanged; ask with validators
    where there are some; seed validators where only a capture is known; else fetch."""
    return F.when(gone, "skip_gone").when(final & has_capture, "skip_final").when(index_same, "skip_index").when(has_state, "conditional").when(has_capture, "seed").otherwise("fetch")


def fetch_plan(refs: DataFrame, state: DataFrame, captures: DataFrame) -> DataFrame:
    """refs (county, url, wayback) plus decision, from what the logs say.

    state (url, gone, final, sha256, etag, last_modified): one row an address.  captures (county, url, version, ts): live
    captures.  Where no address of a county with captures ever had two versions, its files are final.  A reference of an
    archive has no validators and never changes; one that is gone isn't asked for again.
    """
    per = captures.groupBy("county", "url").agg(F.min("version").alias("a"), F.max("version").alias("b"))
    known = written(per, "captured")  # addresses, one row each: used for both joins
    settled = known.groupBy("county").agg(F.bool_and(F.col("a").eqNullSafe(F.col("b"))).alias("__settled"))
    captured = known.select("county", "url").withColumn("__captured", F.lit(True))
    last = state.select("url", F.struct("gone", "final", "sha256", "etag", "last_modified").alias("__state"))
    joined = refs.join(captured, ["county", "url"], "left").join(last, "url", "left").join(settled, "county", "left")
    live = ~F.col("wayback") & F.coalesce("__captured", F.lit(False))
    yes = lambda c: F.coalesce(F.col(f"__state.{c}"), F.lit(False))
    has = lambda c: F.coalesce(F.col(f"__state.{c}"), F.lit("")) != ""
    validators = ~F.col("wayback") & has("sha256") & (has("etag") | has("last_modified"))
    decision = (
        F.when(yes("gone"), "skip_gone")
        .when(live & (yes("final") | F.coalesce("__settled", F.lit(False))), "skip_final")
        .when(live & F.col("__state").isNull(), "seed")
        .when(validators, "conditional")
        .otherwise("fetch")
    )
    return joined.withColumn("decision", decision).select(*refs.columns, "decision")


def recheck_reason(failures: Column, all_gone: Column, productive_now: Column, last_productive: Column, now: Column, days: int = 14) -> Column:
    """Why a county should be tried again: failures other than missing files, or nothing found though it was
    productive lately; null for no reason."""
    lately = F.coalesce(last_productive >= now - F.make_dt_interval(F.lit(days)), F.lit(False))
    return F.when((failures > 0) & ~all_gone, "failures").when(~productive_now & lately, "empty")


def page_is_past(hearing_date: Column, today: Column, days: int = 2) -> Column:
    """Whether a dated page lies so far back that later changes are ignored."""
    return F.coalesce(hearing_date < F.date_sub(today, days), F.lit(False))


def with_archive_fallback(refs: DataFrame, listing: DataFrame, available: DataFrame, url: str = "url") -> DataFrame:
    """Archived forms of references: rows of the listing, and where it has none for an address the closest one."""
    listed = refs.select(url).join(listing, url)
    closest = refs.select(url).join(listing.select(url).distinct(), url, "left_anti").join(available, url)
    return listed.unionByName(closest, allowMissingColumns=True)


STATE = ("url", "sha256", "etag", "last_modified", "index_row", "gone")


def page_decisions(batch: DataFrame, state: DataFrame, latest: DataFrame) -> DataFrame:
    """batch plus decision: what became of each page reference, in order of precedence.

    batch (url, final, index_row, etag, last_modified, gone, sha256, content_key): one row an address; what an answer would
    say.  state (STATE) and latest (url, content_key): one row an address; the latest capture of a page.
    final: captured, and its county doesn't change pages any more, or its hearing is past.  index: captured, and its row
    in the index is as it was (or wasn't known).  not_modified: its validators are those held.  gone: it isn't there.
    unchanged: its visible content is the latest capture's.  stored: all else."""
    held = state.select("url", F.struct("etag", "last_modified", "index_row").alias("__s"))
    last = latest.select("url", F.struct("content_key").alias("__l"))
    joined = batch.join(held, "url", "left").join(last, "url", "left")
    captured = F.col("__l").isNotNull()
    same_row = F.col("index_row").isNotNull() & captured & F.coalesce(F.col("__s.index_row") == F.col("index_row"), F.lit(True))
    same_tag = F.when(F.col("__s.etag").isNotNull(), F.col("__s.etag") == F.col("etag")).otherwise(F.col("__s.last_modified") == F.col("last_modified"))
    decision = (
        F.when(captured & F.coalesce("final", F.lit(False)), "final")
        .when(same_row, "index")
        .when(captured & F.coalesce(same_tag, F.lit(False)), "not_modified")
        .when(F.coalesce("gone", F.lit(False)), "gone")
        .when(captured & F.col("__l.content_key").eqNullSafe(F.col("content_key")), "unchanged")
        .otherwise("stored")
    )
    return joined.select(*batch.columns, decision.alias("decision"))


def merge_pages(batch: DataFrame, state: DataFrame, latest: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(decisions, state, latest) after a batch, each written.

    Pages that weren't asked for keep their state; an index row that wasn't known yet is noted.  Pages that were there
    have the answer's validators, those that are gone only that; latest changes where a page is stored.  A batch that
    names an address more than once has a decision for each row, all by the state before it; one of them goes into state
    and latest (stored before unchanged, gone and index; of equal ones the greatest), which keep one row an address."""
    every = written(page_decisions(batch, state, latest), "decisions")
    rank = F.array_position(F.array(*map(F.lit, ("index", "gone", "unchanged", "stored"))), F.col("decision"))
    whole = F.struct("decision", *STATE[1:5], "content_key")
    decided = every.where(rank > 0).groupBy("url").agg(F.max_by(whole, F.struct(rank, *STATE[1:5], "content_key")).alias("__d")).select("url", "__d.*")
    told = decided.where(F.col("decision").isin("unchanged", "stored")).select("url", "sha256", "etag", "last_modified", "index_row", F.lit(False).alias("gone"))
    missing = decided.where("decision = 'gone'").select("url", *(F.lit(None).cast("string").alias(c) for c in STATE[1:5]), F.lit(True).alias("gone"))
    noted = decided.where("decision = 'index'").select("url", F.col("index_row").alias("__row"))
    changed = written(told.unionByName(missing), "changed")
    kept = state.join(changed.select("url"), "url", "left_anti").join(noted, "url", "left").withColumn("index_row", F.coalesce("index_row", "__row")).drop("__row")
    known = kept.unionByName(noted.join(state.select("url"), "url", "left_anti").select("url", *(F.lit(None).cast("string").alias(c) for c in STATE[1:4]), F.col("__row").alias("index_row"), F.lit(False).alias("gone")))
    stored = decided.where("decision = 'stored'").select("url", "content_key")
    newest = latest.join(stored.select("url"), "url", "left_anti").unionByName(stored)
    return every, written(known.select(*STATE).unionByName(changed.select(*STATE)), "state"), written(newest, "latest")


# Counties that put other files at the same addresses, and those that routine harvests leave out, with why.
VOLATILE = ("orange", "santa-clara", "shasta", "tuolumne")
NOT_ROUTINE = {"amador": "legacy dropdowns only expose 2020-2022 PDFs; current access moved after 2022-02-15"}


def upload_plan(refs: DataFrame, known: DataFrame, volatile: tuple[str, ...] = VOLATILE) -> DataFrame:
    """refs (county, url, wayback_ts, sha256) plus plan: upload, or already-captured.

    An address (with its archive time) that is known is captured already; in volatile counties only if it is known with
    the same file, whose hash the caller has fetched (sha256; null elsewhere).  known: url, wayback_ts, sha256; it is one
    row an address, or one an address and hash, before it is joined, so that often captured addresses are no burden."""
    key = ["url", "wayback_ts"]
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    addresses = known.select(F.col("url").alias("__u"), F.col("wayback_ts").alias("__w")).distinct().withColumn("__known", F.lit(True))
    files = known.where("sha256 IS NOT NULL").select(F.col("url").alias("__fu"), F.col("wayback_ts").alias("__fw"), F.col("sha256").alias("__f")).distinct().withColumn("__same", F.lit(True))
    joined = refs.join(addresses, (F.col(key[0]) == F.col("__u")) & same(key[1], "__w"), "left").join(files, (F.col(key[0]) == F.col("__fu")) & same(key[1], "__fw") & (F.col("sha256") == F.col("__f")), "left")
    captured = F.when(F.coalesce(F.col("county").isin(*volatile), F.lit(False)), F.col("__same").isNotNull()).otherwise(F.col("__known").isNotNull())
    return joined.select(*refs.columns, F.when(captured, "already-captured").otherwise("upload").alias("plan"))


def routine(counties: DataFrame, county: str = "county") -> DataFrame:
    """counties plus skipped: why a routine harvest of all counties leaves one out, else null."""
    why = F.create_map(*(F.lit(x) for pair in NOT_ROUTINE.items() for x in pair))
    return counties.withColumn("skipped", F.try_element_at(why, F.col(county)))


def recent_paths(captures: DataFrame, pages: DataFrame, parsed: DataFrame, cutoff: Column) -> DataFrame:
    """(county, path): archived files of the sources that no ruling names yet and that were fetched since cutoff.

    captures: county, source_sha256, archive_extension, fetched_at; of each, its file and its text layer's.  pages: county,
    source_sha256, archive_path, captured_at.  Times are ISO text, in UTC unless they name a zone; rows whose time is none
    are left out.  parsed: source_sha256."""
    seen = parsed.select("source_sha256").where("source_sha256 IS NOT NULL").distinct()
    late = lambda c: parse_time(F.col(c)) >= cutoff
    files = captures.where(late("fetched_at") & (blank(F.col("source_sha256")) != "")).join(seen, "source_sha256", "left_anti")
    folder = lambda *more: F.concat(F.lit("archive/"), "county", F.lit("/"), *more, F.left("source_sha256", F.lit(2)), F.lit("/"), "source_sha256", F.lit("."))
    paths = F.array(F.concat(folder(), first_filled(F.col("archive_extension"), F.lit("pdf"))), F.concat(folder(F.lit("ocr/")), F.lit("pdf")))
    shown = pages.where(late("captured_at") & (blank(F.col("archive_path")) != "")).join(seen, "source_sha256", "left_anti")
    return files.select("county", F.explode(paths).alias("path")).union(shown.select("county", F.col("archive_path").alias("path"))).distinct()
