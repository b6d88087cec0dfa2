"""Queries over harvests: folder walks, sweeps, page changes, run status, checked joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.functions import text
from docketeer.operators import captures, codes, status, sweeps, view, walk, warehouse
from docketeer.plans.registry import Tables, query
from docketeer.sources import html
from docketeer.sources.shared import shared_path, written

_HREFS = """SELECT page_id, h[1] AS parent, unnest(h[2:]) AS child FROM (SELECT page_id, list_filter(regexp_extract_all(coalesce(html, ''), '(?i)<(?:a|area|iframe|embed|object)\\s[^>]*?(?:href|src|data)\\s*=\\s*["'']([^"'']+)["'']', 1), lambda x: x <> '') AS h FROM pages)"""


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT parent, child FROM ({_HREFS})),
w(node, depth, path) AS (SELECT DISTINCT parent, 0, [parent] FROM ({_HREFS}) WHERE page_id % 50 = 0
  UNION SELECT child, depth + 1, path || [child] FROM w JOIN e ON node = parent WHERE depth < 4 AND depth = (SELECT min(depth) FROM w)),
d AS (SELECT node, depth, min(path) AS path FROM w GROUP BY node, depth)
SELECT node, depth::INTEGER AS depth FROM (SELECT node, min(depth) AS depth FROM d GROUP BY node)""")
def folder_walk(t: Tables) -> DataFrame:
    """What can be reached within four steps where the first link of a page leads to its other links."""
    links = F.filter(html.links(F.col("html")), lambda x: x != "")
    pages = t.pages.select("page_id", links.alias("h")).where(F.size("h") > 0)
    edges = pages.select(F.get("h", F.lit(0)).alias("parent"), F.explode(F.slice("h", F.lit(2), F.greatest(F.size("h"), F.lit(1)))).alias("child")).distinct().withColumn("name", F.col("child"))
    roots = pages.where((F.size("h") > 1) & (F.col("page_id") % 50 == 0)).select(F.get("h", F.lit(0)).alias("node")).distinct().withColumn("label", F.col("node"))
    return walk.walk(roots, edges).select("node", "depth")


@query("""SELECT strftime(d, '%Y-%m-%d') AS day, count(*)::BIGINT AS n_refs, min('https://api.example/' || o_custkey || '/doc/' || o_orderkey) AS first_url,
  count_if(o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW'))::BIGINT AS n_named, max(strftime(d, '%Y-%m-%d') || '-' || CASE WHEN o_orderkey % 4 = 0 THEN 'case' ELSE o_orderstatus || '-' || o_orderkey END || '-' || o_orderkey || '.pdf') AS last_filename
FROM (SELECT *, o_orderdate::DATE AS d FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY d""")
def date_sweep(t: Tables) -> DataFrame:
    """Every day of the orders asked for, with answers in JSON: references by day.  A fifth of the rows names no document."""
    orders = t.orders.select(F.to_date("o_orderdate").alias("d"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    ends = orders.agg(F.min("d"), F.max("d")).first()
    if ends[0] is None:
        ends = (F.lit("2000-01-01").cast("date"),) * 2
    asked = sweeps.dates(t.spark, F.lit(ends[0]), F.lit(ends[1]), "https://api.example/date?date={day}")
    key = F.col("o_orderkey")
    row = F.struct(
        F.col("o_custkey").alias("caseId"), F.when((key % 5 != 0) & (key % 2 == 0), key).alias("documentId"), F.when(key % 5 != 0, key.cast("string")).alias("documentVersionId"),
        F.when(key % 4 != 0, F.concat_ws(" ", "o_orderstatus", key)).alias("caseNumber"), F.concat(F.lit("Department "), F.left("o_orderpriority", F.lit(1))).alias("department"),
        F.when(F.left("o_orderpriority", F.lit(1)).isin("1", "3", "5"), F.col("o_orderpriority")).otherwise("").alias("description"))
    bodies = orders.groupBy("d").agg(F.to_json(F.struct(F.collect_list(row).alias("data"))).alias("body"))
    answers = bodies.select(F.concat(F.lit("https://api.example/date?date="), F.date_format("d", "yyyy-MM-dd")).alias("request"), "body")
    refs = sweeps.answered_refs(asked, answers, "https://api.example")
    return refs.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n_refs"), F.min("url").alias("first_url"), F.count_if(F.col("link_text") != "Tentative Ruling").alias("n_named"), F.max("filename").alias("last_filename"))


@query("""WITH f AS (SELECT page_id, url, least(coalesce(list_max(list_transform(regexp_extract_all(h, '[?&]page=([0-9]+)', 1), lambda x: x::INTEGER)), 0), 25) AS last
  FROM (SELECT page_id, url, coalesce(html, '') || '<a href="?page=' || (page_id % 40) || '">next</a> <a href="?x=1&page=2">' AS h FROM pages))
SELECT url, p::INTEGER AS page, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'page=' || p AS request FROM (SELECT url, unnest(range(1, last + 1)) AS p FROM f)""")
def page_sweep(t: Tables) -> DataFrame:
    """The further pages of each listing, by the page numbers that it links to."""
    linked = F.concat(F.coalesce("html", F.lit("")), F.lit('<a href="?page='), F.col("page_id") % 40, F.lit('">next</a> <a href="?x=1&page=2">'))
    return sweeps.page_requests(t.pages.select("url", linked.alias("html")))


@query("""WITH b AS (SELECT page_id, url, html, page_id % 6 AS k FROM pages)
SELECT 1 AS batch, page_id, 'stored' AS decision FROM b
UNION ALL SELECT 2, page_id, CASE k WHEN 0 THEN 'stored' WHEN 1 THEN 'unchanged' WHEN 2 THEN 'not_modified' WHEN 3 THEN 'index' WHEN 4 THEN 'gone' ELSE 'final' END FROM b
UNION ALL SELECT 3, page_id, CASE k WHEN 0 THEN 'unchanged' WHEN 3 THEN 'stored' WHEN 4 THEN 'unchanged' WHEN 5 THEN 'final' ELSE 'not_modified' END FROM b""")
def page_changes(t: Tables) -> DataFrame:
    """Three harvests of every page, each merged into the state that the one before left.

    Several pages of the table may have one url (or none); each is a page of its own, so that its id is part of its address."""
    kind, spark = F.col("page_id") % 6, t.spark
    address = F.concat_ws("#", "url", F.col("page_id").cast("string")).alias("url")
    state = spark.createDataFrame([], "url string, sha256 string, etag string, last_modified string, index_row string, gone boolean")
    latest, out = spark.createDataFrame([], "url string, content_key string"), None
    for number in (1, 2, 3):
        second, third = F.lit(number == 2), F.lit(number == 3)
        page = F.concat(F.coalesce("html", F.lit("")), F.when(F.lit(number > 1) & (kind == 0), "<p>more text</p>").when(third & (kind == 3), "<p>other text</p>").when(second & (kind == 1), "<!-- other markup -->").otherwise(""))
        tag = F.when((kind == 2) | (kind == 1) & F.lit(number > 1), "b").when((kind == 4) & third, "d").when(kind == 4, "c").otherwise(F.concat(F.lit("t"), F.lit(number)))
        row = F.when(kind == 3, F.when(third, "row 2").otherwise("row 1"))
        pages = t.pages.select(
            "page_id", address, ((kind == 5) & F.lit(number > 1)).alias("final"), row.alias("index_row"), F.when((kind != 2) & ~((kind == 4) & second), tag).alias("etag"), F.when(kind == 2, tag).alias("last_modified"),
            ((kind == 4) & second).alias("gone"), F.sha2(page, 256).alias("sha256"), html.content_key(page).alias("content_key"))
        decided, state, latest = captures.merge_pages(pages, state, latest)
        rows = decided.select(F.lit(number).alias("batch"), "page_id", "decision")
        out = rows if out is None else out.union(rows)
    return out


_COMMAND = "CASE event_type WHEN (SELECT min(event_type) FROM events) THEN 'start' WHEN (SELECT max(event_type) FROM events) THEN 'parse' ELSE 'capture' END"


@query(f"""WITH e AS (SELECT user_id, event_id, {_COMMAND} AS command, value >= 20 AS ok FROM events),
r AS (SELECT *, count(*) FILTER (command = 'start') OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM e),
c AS (SELECT *, count(*) FILTER (command = 'capture') OVER (PARTITION BY user_id, run ORDER BY event_id) AS captures FROM r),
p AS (SELECT *, count(*) FILTER (command = 'parse' AND captures > 0) OVER (PARTITION BY user_id, run ORDER BY event_id) AS parses FROM c),
g AS (SELECT *, run > 0 AND (command = 'start' OR (command = 'capture' AND captures = 1) OR (command = 'parse' AND captures > 0 AND parses = 1)) AS good FROM p),
s AS (SELECT user_id, run, bool_or(ok) FILTER (good AND command = 'capture') AS captured, bool_or(ok) FILTER (good AND command = 'parse') AS parsed, count(*) FILTER (NOT good) AS rejected FROM g GROUP BY ALL),
l AS (SELECT user_id, max(run) AS run, sum(CASE WHEN run > 0 THEN rejected ELSE 0 END)::BIGINT AS n_rejected FROM s GROUP BY user_id)
SELECT user_id, run, CASE WHEN parsed IS NOT NULL THEN 'done' WHEN captured IS NULL THEN 'capturing' WHEN captured THEN 'captured' ELSE 'failed' END AS stage,
  CASE WHEN captured IS NULL THEN 'running' WHEN captured THEN 'ok' ELSE 'failed' END AS capture, CASE WHEN parsed IS NULL THEN 'pending' WHEN parsed THEN 'ok' ELSE 'failed' END AS parse, n_rejected
FROM l JOIN s USING (user_id, run) WHERE run > 0""")
def run_status(t: Tables) -> DataFrame:
    """Every user's events as commands of harvest runs, replayed in two batches over the status table."""
    names = t.events.agg(F.min("event_type").alias("a"), F.max("event_type").alias("b")).first()
    command = F.when(F.col("event_type") == names["a"], "start").when(F.col("event_type") == names["b"], "parse").otherwise("capture")
    events = t.events.select("user_id", "event_id", command.alias("command"), (F.col("value") >= 20).alias("ok"), F.col("ts").alias("at"))
    half = t.events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    first = status.upserted(None, events.where(F.col("event_id") <= F.lit(half)), "user_id", "event_id")
    both = status.upserted(written(first, "status"), events.where(F.col("event_id") > F.lit(half)), "user_id", "event_id")
    return both.select("user_id", "run", "stage", "capture", "parse", "n_rejected")


@query("SELECT doc_id, lang, source, sha256(coalesce(text, '')) AS text_sha256 FROM documents")
def summaries_with_text(t: Tables) -> DataFrame:
    """Every summary with its text; a summary without a text, or with two, would fail the query."""
    details = t.documents.select(F.col("lang").alias("county"), F.col("doc_id").alias("ruling_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    rows = view.with_details(t.documents.select(F.col("lang").alias("county"), F.col("doc_id").alias("ruling_id"), "source"), details)
    return rows.select(F.col("ruling_id").alias("doc_id"), F.col("county").alias("lang"), "source", "text_sha256")


_AUDITED = """WITH r AS (SELECT doc_id, lang AS county, doc_id % 500 AS ruling_id, source AS source_sha256, doc_id % 40 AS ruling_index, DATE '2008-01-01' + (doc_id % 3000)::INTEGER AS hearing_date,
  CASE WHEN doc_id % 4 = 0 THEN ' ' ELSE lang END AS division, source AS dept, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'Motion' END AS motion_type,
  CASE WHEN doc_id % 6 = 0 THEN '' ELSE 'granted' END AS outcome_text, text || CASE WHEN doc_id % 7 = 0 THEN '(cid:12)' ELSE '' END AS body_text,
  CASE WHEN doc_id % 8 = 0 THEN chr(65533) WHEN doc_id % 8 = 1 THEN '' ELSE 'In re' END AS case_title, CASE WHEN doc_id % 9 = 0 THEN 'archive://x' ELSE 'https://x' END AS source_url FROM documents)"""


@query(_AUDITED + r""", i AS (SELECT county, sum(n)::BIGINT AS n FROM (SELECT county, ruling_id, count(*) AS n FROM r GROUP BY ALL HAVING count(*) > 1) GROUP BY county),
p AS (SELECT county, sum(n)::BIGINT AS n FROM (SELECT county, source_sha256, ruling_index, count(*) AS n FROM r GROUP BY ALL HAVING count(*) > 1) GROUP BY county)
SELECT r.county, count(*)::BIGINT AS n_rows, count(DISTINCT source_sha256)::BIGINT AS n_sources, min(hearing_date) AS first_date, max(hearing_date) AS last_date, count_if(hearing_date < DATE '2010-01-01')::BIGINT AS before_2010,
  count_if(trim(coalesce(division, '')) = '')::BIGINT AS blank_division, count_if(trim(coalesce(dept, '')) = '')::BIGINT AS blank_dept, count_if(trim(coalesce(motion_type, '')) = '')::BIGINT AS blank_motion_type,
  count_if(trim(coalesce(outcome_text, '')) = '')::BIGINT AS blank_outcome_text, count_if(NOT regexp_matches(coalesce(body_text, ''), '\S'))::BIGINT AS blank_body_text, count_if(trim(coalesce(case_title, '')) = '')::BIGINT AS blank_case_title,
  count_if(length(trim(coalesce(body_text, ''), ' ' || chr(10) || chr(9) || chr(13))) < 20)::BIGINT AS short_body_text, count_if(regexp_matches(concat_ws(' ', case_title, body_text), '\x{FFFD}|\(cid:[0-9]+\)|[\x00-\x08\x0E-\x1F]'))::BIGINT AS artifacts,
  count_if(NOT regexp_matches(source_url, '^https?://'))::BIGINT AS bad_url, count_if(ruling_id NOT IN (SELECT doc_id FROM labels))::BIGINT AS missing_slices,
  coalesce(any_value(i.n), 0)::BIGINT AS doubled_ids, coalesce(any_value(p.n), 0)::BIGINT AS doubled_places
FROM r LEFT JOIN i ON r.county IS NOT DISTINCT FROM i.county LEFT JOIN p ON r.county IS NOT DISTINCT FROM p.county GROUP BY r.county""")
def full_audit(t: Tables) -> DataFrame:
    """All counts of an audit, of whole documents as rulings with faults laid over them by id."""
    n = F.col("doc_id")
    rows = t.documents.select(
        F.col("lang").alias("county"), (n % 500).alias("ruling_id"), F.col("source").alias("source_sha256"), (n % 40).alias("ruling_index"), F.date_add(F.lit("2008-01-01").cast("date"), (n % 3000).cast("int")).alias("hearing_date"),
        F.when(n % 4 == 0, " ").otherwise(F.col("lang")).alias("division"), F.col("source").alias("dept"), F.when(n % 5 != 0, "Motion").alias("motion_type"), F.when(n % 6 == 0, "").otherwise("granted").alias("outcome_text"),
        F.concat("text", F.when(n % 7 == 0, "(cid:12)").otherwise("")).alias("body_text"), F.when(n % 8 == 0, "\ufffd").when(n % 8 == 1, "").otherwise("In re").alias("case_title"), F.when(n % 9 == 0, "archive://x").otherwise("https://x").alias("source_url"))
    return warehouse.full_audit(rows, t.labels.select(F.col("doc_id").alias("ruling_id")))


@query("""WITH l AS (SELECT upper(substr(c_mktsegment, 1, 2)) || '-' || strftime(o_orderdate, '%y%m%d') || '-D' || coalesce(nullif(o_orderstatus, ''), '?') || '-' || (o_orderkey % 50) || ',' || CASE WHEN c_mktsegment = 'MACHINERY' THEN 'MACHINERY' ELSE lower(c_mktsegment) END || ',' || o_orderstatus || ',,' || strftime(o_orderdate, '%Y-%m-%d') || ',' || o_custkey || ',"a, ' || c_name || '",,' || o_orderpriority || ',false,,,,' AS line FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT line FROM l UNION ALL SELECT 'id,county,dept,judge,hearing_date,case_number,case_title,motion_type,outcome,conditional,continued_to,page_start,page_end,source_url'""")
def export_file(t: Tables) -> DataFrame:
    """The lines of a written export of every row, its head with it (readers drop the mark before it); a county without a label keeps its name."""
    segments = t.customer.select(F.col("c_mktsegment").alias("slug")).distinct()
    counties = segments.select("slug", F.when(F.col("slug") != "MACHINERY", F.lower("slug")).alias("label"), F.upper(F.left("slug", F.lit(2))).alias("code"))
    named = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("county"), F.concat(F.lit("a, "), "c_name").alias("case_title"))
    rows = t.orders.join(named, "o_custkey").select(
        F.col("o_orderkey").alias("ruling_id"), "county", F.to_date("o_orderdate").alias("hearing_date"), F.col("o_orderstatus").alias("dept"), (F.col("o_orderkey") % 50).cast("int").alias("ruling_index"),
        F.col("o_custkey").cast("string").alias("case_number"), "case_title", F.col("o_orderpriority").alias("outcome"))
    path = shared_path(t.spark, "export")
    view.write_export(view.export_rows(rows, counties), path, "hearing_date", "ruling_id")
    return t.spark.read.option("lineSep", "\r\n").text(path).select(F.col("value").alias("line"))


def name_slugs(t: Tables) -> DataFrame:
    """The names of several tables as slugs."""
    names = [t.region.select("r_name"), t.nation.select("n_name"), t.supplier.select("s_name"), t.customer.select("c_name"), t.part.select("p_name")]
    union = names[0]
    for more in names[1:]:
        union = union.union(more)
    return union.select(text.class_token(F.col("r_name")).alias("slug"))


@query()
def unique_codes(t: Tables) -> DataFrame:
    """A code of its own for every name of five tables."""
    found = codes.unique_codes(name_slugs(t))
    return found.withColumn("label", codes.label(F.col("slug")))


_UPLOADS = """WITH r AS (SELECT event_id, ['orange', 'yolo', 'tuolumne', NULL][(event_id % 4)::INTEGER + 1] AS county, 'u' || (event_id % 97) AS url, CASE WHEN event_id % 3 = 0 THEN 't' || (event_id % 5) END AS wayback_ts,
  CASE WHEN event_id % 2 = 0 THEN 'h' || (event_id % 11) END AS sha256, user_id FROM events),
k AS (SELECT * FROM r WHERE user_id % 2 = 0)"""


@query(_UPLOADS + """ SELECT event_id, CASE WHEN CASE WHEN coalesce(county IN ('orange', 'santa-clara', 'shasta', 'tuolumne'), FALSE)
    THEN EXISTS (SELECT 1 FROM k WHERE k.url = r.url AND k.wayback_ts IS NOT DISTINCT FROM r.wayback_ts AND k.sha256 = r.sha256)
    ELSE EXISTS (SELECT 1 FROM k WHERE k.url = r.url AND k.wayback_ts IS NOT DISTINCT FROM r.wayback_ts) END THEN 'already-captured' ELSE 'upload' END AS plan FROM r""")
def upload_plan(t: Tables) -> DataFrame:
    """What is to be done with every event as a reference, when those of half the users are captured already."""
    n = F.col("event_id")
    county = F.when(n % 4 == 0, "orange").when(n % 4 == 1, "yolo").when(n % 4 == 2, "tuolumne")
    refs = t.events.select("event_id", "user_id", county.alias("county"), F.concat(F.lit("u"), n % 97).alias("url"), F.when(n % 3 == 0, F.concat(F.lit("t"), n % 5)).alias("wayback_ts"), F.when(n % 2 == 0, F.concat(F.lit("h"), n % 11)).alias("sha256"))
    return captures.upload_plan(refs, refs.where("user_id % 2 = 0")).select("event_id", "plan")


@query("""WITH d AS (SELECT doc_id, lang, source, md5(doc_id::VARCHAR) AS sha, TIMESTAMP '2024-01-01 00:00:00' + to_hours((doc_id % 1000)::INTEGER) AS moment FROM documents),
w AS (SELECT *, moment - CASE WHEN doc_id % 5 = 1 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS utc FROM d WHERE doc_id % 5 <> 4),
l AS (SELECT * FROM w WHERE utc >= TIMESTAMP '2024-01-20 12:00:00' AND doc_id NOT IN (SELECT doc_id FROM labels))
SELECT DISTINCT lang AS county, 'archive/' || lang || '/' || p || substr(sha, 1, 2) || '/' || sha || CASE WHEN p = '' AND doc_id % 3 = 0 THEN '.docx' ELSE '.pdf' END AS path FROM l, (SELECT unnest(['', 'ocr/']) AS p)
UNION SELECT lang, 'archive/' || lang || '/pages/' || sha || '.html' FROM l WHERE doc_id % 2 = 0""")
def recent_paths(t: Tables) -> DataFrame:
    """Archived files of recent sources that no label names, with times written in five ways, one of them none."""
    n = F.col("doc_id")
    at = F.timestamp_seconds(F.lit(1704067200) + n % 1000 * 3600)
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    told = F.when(n % 5 == 0, F.concat(iso, F.lit("Z"))).when(n % 5 == 1, F.concat(iso, F.lit("+02:00"))).when(n % 5 == 2, iso).when(n % 5 == 3, F.replace(iso, F.lit("T"), F.lit(" "))).otherwise("some day")
    sha = F.md5(n.cast("string").cast("binary"))
    rows = t.documents.select(F.col("lang").alias("county"), "doc_id", sha.alias("source_sha256"), told.alias("fetched_at"), F.when(n % 3 == 0, "docx").alias("archive_extension"))
    pages = rows.where("doc_id % 2 = 0").select("county", "source_sha256", F.col("fetched_at").alias("captured_at"), F.concat(F.lit("archive/"), "county", F.lit("/pages/"), "source_sha256", F.lit(".html")).alias("archive_path"))
    parsed = t.labels.select(F.md5(F.col("doc_id").cast("string").cast("binary")).alias("source_sha256"))
    return captures.recent_paths(rows, pages, parsed, F.lit("2024-01-20 12:00:00").cast("timestamp"))
