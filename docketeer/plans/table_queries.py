"""Queries over pages, conversations and the order tables, which stand for page captures, versions and viewer rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.functions import text, urls
from docketeer.operators import blocks, view
from docketeer.plans.registry import Tables, query
from docketeer.sources import html

_HREF = r"""(?i)<(?:a|area|iframe|embed|object)\s[^>]*?(?:href|src|data)\s*=\s*["'']([^"'']+)["'']"""
_LINKS = f"regexp_extract_all(coalesce(html, ''), '{_HREF}', 1)"
_VISIBLE = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
 '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?is)<noscript\b.*?</noscript>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"""


@query(f"SELECT page_id, (unnest(range(len({_LINKS}))))::INTEGER AS position, unnest({_LINKS}) AS url FROM pages")
def page_links(t: Tables) -> DataFrame:
    return html.exploded_links(t.pages)


@query(f"SELECT page_id, sha256({_VISIBLE} || chr(10) || array_to_string({_LINKS}, chr(10))) AS content_key FROM pages")
def page_content_key(t: Tables) -> DataFrame:
    return t.pages.select("page_id", html.content_key(F.col("html")).alias("content_key"))


@query()
def page_refs(t: Tables) -> DataFrame:
    """Anchors, options and Markdown links of every page, with absolute addresses and texts."""
    return html.page_links(t.pages)


_HOST = r"lower(regexp_extract(url, '^https?://(?:[^/@]*@)?([^/:?#]+)', 1))"


@query(f"""SELECT page_id, url, {_HOST} AS host, coalesce(regexp_matches(url, '^https?://') AND NOT regexp_matches(url, '^https?://[^/@]*@')
  AND ({_HOST} = 'example.com' OR {_HOST} LIKE '%.example.com' OR {_HOST} = 'example.org' OR {_HOST} LIKE '%.example.org'), false) AS allowed FROM pages""")
def page_link_hosts_allowed(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "url", urls.host_of(F.col("url")).alias("host"), urls.host_allowed(F.col("url"), ["example.com", "example.org"]).alias("allowed"))


_YEAR = r"nullif(regexp_extract(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/((?:19|20)[0-9]{2})(?:/|$)', 1), '')"


@query(f"""SELECT page_id, {_YEAR}::INTEGER AS year FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url ELSE url || '/' || (2015 + page_id % 12) || '/x.pdf' END AS u FROM pages)
WHERE {_YEAR} IS NULL OR {_YEAR}::INTEGER BETWEEN 2018 AND 2022""")
def url_year_filter(t: Tables) -> DataFrame:
    address = F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.concat("url", F.lit("/"), (2015 + F.col("page_id") % 12).cast("string"), F.lit("/x.pdf")))
    named = t.pages.select("page_id", address.alias("u"))
    return named.where(urls.in_years(F.col("u"), 2018, 2022)).select("page_id", urls.url_year(F.col("u")).alias("year"))


_PATH = "CASE page_id % 4 WHEN 0 THEN '/data/yolo/summary.json' WHEN 1 THEN '/data/yolo/ruling-text/' || substr(h, 1, 2) || '/' || h || '.json' WHEN 2 THEN '/data/yolo/ruling-text/zz/' || h || '.json' ELSE '/data/yolo/ruling-text/' || substr(h, 3, 2) || '/' || h || '.json' END"
_DETAIL = "'^/data/[a-z_]+/ruling-text/([0-9a-f]{2})/([0-9a-f]{32})\\.json$'"


@query(f"""SELECT page_id, regexp_matches(p, '^/(?:data/[a-z_]+/(?:summary|_viewer)\\.json|counties\\.json)$') OR (regexp_extract(p, {_DETAIL}, 2) <> '' AND regexp_extract(p, {_DETAIL}, 1) = substr(regexp_extract(p, {_DETAIL}, 2), 1, 2)) AS served
FROM (SELECT page_id, {_PATH} AS p FROM (SELECT page_id, md5(url) AS h FROM pages))""")
def route_allowlist(t: Tables) -> DataFrame:
    h = F.md5(F.col("url").cast("binary"))
    detail = lambda prefix: F.concat(F.lit("/data/yolo/ruling-text/"), prefix, F.lit("/"), h, F.lit(".json"))
    kind = F.col("page_id") % 4
    path = F.when(kind == 0, "/data/yolo/summary.json").when(kind == 1, detail(F.substring(h, 1, 2))).when(kind == 2, detail(F.lit("zz"))).otherwise(detail(F.substring(h, 3, 2)))
    return t.pages.select("page_id", urls.is_route(path).alias("served"))


_MASK = r"substr(regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(coalesce({0}, ''), '\s+', ' ', 'g'))), '\b[0-9a-f]{{16,}}\b', '{{hash}}', 'g'), '\b[0-9]{{1,4}}[-/_.][0-9]{{1,2}}[-/_.][0-9]{{1,4}}\b', '{{date}}', 'g'), '[0-9]+', '{{number}}', 'g'), 1, 180)"


@query(f"""SELECT sha256(array_to_string(list_sort(list_distinct(list_transform({_LINKS}, lambda x: {_MASK.format("regexp_replace(x, '^https?://[^/]*', '')")})))[1:40], chr(10))) AS layout, count(*)::BIGINT AS n_pages FROM pages GROUP BY 1""")
def layout_fingerprint(t: Tables) -> DataFrame:
    """Pages by the masked forms of their links."""
    return t.pages.groupBy(F.sha2(F.array_join(html.layout(F.col("html"))["paths"], "\n"), 256).alias("layout")).agg(F.count("*").alias("n_pages"))


@query(r"""SELECT page_id, (length(coalesce(html, '')) - length(replace(coalesce(html, ''), '<', '')))::BIGINT AS tags,
 length(replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?s)<(script|style)\b.*?</(script|style)>', '', 'g'), '<[^>]*>', '', 'g'), ' ', ''))::BIGINT AS chars,
 chars < 40 AS empty FROM pages""")
def empty_pages(t: Tables) -> DataFrame:
    """Each page's tags and characters outside of tags, and whether these are too few for a page with text."""
    markup = F.coalesce("html", F.lit(""))
    shown = F.regexp_replace(F.regexp_replace(markup, r"(?s)<(script|style)\b.*?</(script|style)>", ""), "<[^>]*>", "")
    counted = t.pages.select("page_id", (F.length(markup) - F.length(F.replace(markup, F.lit("<"), F.lit("")))).cast("long").alias("tags"), F.length(F.replace(shown, F.lit(" "), F.lit(""))).cast("long").alias("chars"))
    return counted.withColumn("empty", F.col("chars") < 40)


@query()
def html_to_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", html.html_to_text("html").alias("text"))


_CHAIN = """WITH RECURSIVE chain AS (
  SELECT conv_id, turn, turn - 1 AS ancestor, 1 AS distance FROM conversations WHERE turn > 0
  UNION ALL SELECT conv_id, turn, ancestor - 1, distance + 1 FROM chain WHERE ancestor > 0)"""


@query(_CHAIN + " SELECT conv_id, turn, max(distance)::BIGINT AS n_versions FROM chain GROUP BY conv_id, turn")
def version_chain(t: Tables) -> DataFrame:
    """Turns as versions of one another: how many each one has before it."""
    ident = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))
    rows = t.conversations.select(ident(F.col("turn")).alias("id"), F.when(F.col("turn") > 0, ident(F.col("turn") - 1)).alias("previous"))
    parts = F.split("id", ":")
    return view.version_depths(rows, "id", "previous").select(F.element_at(parts, 1).cast("long").alias("conv_id"), F.element_at(parts, 2).cast("long").alias("turn"), "n_versions")


@query("SELECT conv_id, turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations d WHERE d.conv_id = c.conv_id AND d.turn = c.turn + 1)")
def hide_previous_versions(t: Tables) -> DataFrame:
    rows = t.conversations.select("conv_id", "turn", F.struct("conv_id", "turn").alias("ruling_id"))
    named = rows.select("conv_id", "turn", F.to_json("ruling_id").alias("ruling_id"), F.to_json(F.struct("conv_id", (F.col("turn") - 1).alias("turn"))).alias("previous_version_id"))
    return view.hide_previous(named).select("conv_id", "turn")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM conversations""")
def carry_forward_role(t: Tables) -> DataFrame:
    return blocks.carried(t.conversations, "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")), "heading").select("conv_id", "turn", "heading")


@query("SELECT o_orderpriority AS priority, o_orderstatus AS status, count(*)::BIGINT AS n FROM orders GROUP BY ALL")
def facet_priority_status(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


def _viewer_rows(t: Tables) -> DataFrame:
    named = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("county"), F.col("c_name").alias("case_title"))
    return t.orders.join(named, "o_custkey").select(
        F.col("o_orderkey").alias("ruling_id"), "county", F.date_format("o_orderdate", "yyyy-MM-dd").alias("hearing_date"), F.col("o_orderpriority").alias("outcome"), "case_title", F.col("o_custkey").cast("string").alias("case_number"))


@query("""SELECT o_orderkey AS ruling_id, c_mktsegment AS county, strftime(o_orderdate, '%Y-%m-%d') AS hearing_date, o_orderpriority AS outcome, c_name AS case_title
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE strftime(o_orderdate, '%Y-%m-%d') BETWEEN '1993-01-01' AND '1997-12-31' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND contains(lower(concat_ws(' ', o_custkey::VARCHAR, c_name, o_orderpriority)), '9')
ORDER BY 3 DESC, o_orderkey LIMIT 100 OFFSET 200""")
def view_filter_sort_page(t: Tables) -> DataFrame:
    """The third page of a filtered, searched and sorted view."""
    state = view.ViewQuery(first="1993-01-01", last="1997-12-31", filters={"outcome": ["1-URGENT", "2-HIGH"]}, q="9", page=3)
    return state.rows(_viewer_rows(t)).select("ruling_id", "county", "hearing_date", "outcome", "case_title")


@query("""SELECT count(*)::BIGINT AS n_rows, count(DISTINCT c_mktsegment)::BIGINT AS n_counties, greatest(1, ceil(count(*) / 250.0))::BIGINT AS n_pages
FROM orders JOIN customer ON o_custkey = c_custkey WHERE strftime(o_orderdate, '%Y-%m-%d') >= '1995-06-01'""")
def view_counts(t: Tables) -> DataFrame:
    return view.ViewQuery(first="1995-06-01", page_size=250).counts(_viewer_rows(t))


@query("SELECT o_orderkey AS ruling_id FROM orders WHERE false")
def empty_filter_matches_nothing(t: Tables) -> DataFrame:
    return view.ViewQuery(filters={"outcome": []}).filtered(_viewer_rows(t)).select("ruling_id")


@query("""WITH x AS (SELECT c_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS d FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey)
SELECT count_if(coalesce(d, '') >= '1996-01-01')::BIGINT AS since, count_if(coalesce(d, '') <= '1996-01-01')::BIGINT AS until FROM x""")
def date_filter_null_semantics(t: Tables) -> DataFrame:
    """Rows without a date are outside a lower bound and inside an upper one."""
    last = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("d"))
    rows = t.customer.select("c_custkey").join(last, "c_custkey", "left")
    return rows.agg(F.count_if(view.date_matches(F.col("d"), "1996-01-01", None)).alias("since"), F.count_if(view.date_matches(F.col("d"), None, "1996-01-01")).alias("until"))


_DEPT = "CASE p_partkey % 4 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN '' WHEN 2 THEN p_brand ELSE (p_size + 0.5)::VARCHAR END"


@query(f"""SELECT p_partkey AS ruling_id, d AS dept FROM (SELECT p_partkey, {_DEPT} AS d FROM part)
ORDER BY CASE WHEN trim(d) = '' THEN 0 WHEN TRY_CAST(d AS DOUBLE) IS NULL THEN 1 ELSE 0 END, CASE WHEN trim(d) = '' THEN 0.0 ELSE TRY_CAST(d AS DOUBLE) END, d, p_partkey""")
def dept_numeric_sort_key(t: Tables) -> DataFrame:
    kind = F.col("p_partkey") % 4
    dept = F.when(kind == 0, F.col("p_size").cast("string")).when(kind == 1, "").when(kind == 2, F.col("p_brand")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5")))
    rows = t.part.select(F.col("p_partkey").alias("ruling_id"), dept.alias("dept"))
    return rows.orderBy(*view.sort_keys("dept", "asc", ["ruling_id"]))


@query("""SELECT o_orderkey AS ruling_id, o_custkey::VARCHAR AS case_number, count(*) OVER (PARTITION BY o_custkey) AS n_history FROM orders JOIN customer ON o_custkey = c_custkey""")
def case_history(t: Tables) -> DataFrame:
    return view.case_history(_viewer_rows(t)).select("ruling_id", "case_number", "n_history")


@query("""SELECT o_orderkey AS ruling_id, o_custkey::VARCHAR AS case_number,
 row_number() OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y-%m-%d') || ' ' || coalesce(o_orderpriority, '') DESC, o_orderkey)::INTEGER AS place
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey % 10 > 1""")
def case_history_order(t: Tables) -> DataFrame:
    """Every case's rows with their places in its history; rows whose case number is null or blank have none."""
    number = F.when(F.col("case_number").cast("long") % 10 == 1, "").when(F.col("case_number").cast("long") % 10 > 1, F.col("case_number"))
    rows = _viewer_rows(t).withColumn("dept", F.col("outcome")).withColumn("case_number", number)
    return view.ordered_history(rows).select("ruling_id", "case_number", "place")


@query("""SELECT o_orderkey || ',' || c_mktsegment || ',,,' || strftime(o_orderdate, '%Y-%m-%d') || ',' || o_custkey || ',' || CASE WHEN regexp_matches(c_name, '[",]') THEN '"' || replace(c_name, '"', '""') || '"' ELSE c_name END
 || ',,' || o_orderpriority || ',false,,,,' AS line FROM orders JOIN customer ON o_custkey = c_custkey""")
def csv_export(t: Tables) -> DataFrame:
    """Every viewer row as a line of an export."""
    return view.export_lines(_viewer_rows(t).withColumnRenamed("ruling_id", "id"))


@query("SELECT coalesce(p_type, '') AS value, count(*)::BIGINT AS n FROM part WHERE contains(lower(coalesce(p_type, '')), 'st') GROUP BY 1 ORDER BY n DESC, value LIMIT 200")
def top200_titles(t: Tables) -> DataFrame:
    return view.facet_list(t.part, "p_type", "ST")


@query("""SELECT count(*)::BIGINT AS n_rows, count_if(l_linenumber < 1 OR l_linenumber + l_quantity % 3 - 1 < l_linenumber)::BIGINT AS bad_spans,
  count_if(o_orderkey IS NULL)::BIGINT AS missing_targets FROM lineitem LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0) ON l_orderkey = o_orderkey""")
def integrity_spans(t: Tables) -> DataFrame:
    """Spans that end before they start, and rows whose target is missing."""
    spans = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("page_start"), (F.col("l_linenumber") + F.col("l_quantity") % 3 - 1).alias("page_end"))
    targets = t.orders.where("o_orderkey % 10 <> 0").select(F.col("o_orderkey").alias("l_orderkey")).distinct().withColumn("there", F.lit(True))
    joined = spans.join(targets, "l_orderkey", "left")
    return joined.agg(F.count("*").alias("n_rows"), F.count_if((F.col("page_start") < 1) | (F.col("page_end") < F.col("page_start"))).alias("bad_spans"), F.count_if(F.col("there").isNull()).alias("missing_targets"))


@query("SELECT n_name AS label, lower(regexp_replace(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS token, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def county_dimension(t: Tables) -> DataFrame:
    """Rows of one small dimension joined to another; Spark broadcasts what its size check allows."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("label"), text.class_token(F.col("n_name")).alias("token"), F.col("r_name").alias("region"))
