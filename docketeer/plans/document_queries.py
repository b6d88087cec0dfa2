"""Queries over documents, which stand for rulings: lang for county, source for department, a date from the id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketeer.functions import classify, dates, ids, text
from docketeer.operators import blocks, dedupe, parsing, view, warehouse
from docketeer.plans.registry import Tables, query

_DAY = "(DATE '2024-01-01' + (doc_id % 365)::INTEGER)"
_COLLAPSED = r"trim(regexp_replace(coalesce({0}, ''), '\s+', ' ', 'g'))"


def clip_sql(c: str, n: int) -> str:
    """The clip expression in SQL."""
    t = _COLLAPSED.format(c)
    h = f"substr({t}, 1, {n})"
    cut = f"(length({h}) - length(string_split({h}, ' ')[-1]) - 1)"
    return f"CASE WHEN length({t}) <= {n} THEN {t} ELSE rtrim(CASE WHEN {cut} > {n // 2} THEN substr({h}, 1, {cut}) ELSE {h} END) || '…' END"


def rulings(docs: DataFrame) -> DataFrame:
    """Documents as rulings."""
    first_line = F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)
    return docs.select(
        ids.ruling_id(F.sha2("text", 256), F.col("doc_id"), F.col("source")).alias("ruling_id"),
        F.col("doc_id"),
        F.col("lang").alias("county"),
        F.col("source").alias("dept"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(365)).cast("int")).alias("hearing_date"),
        F.pmod("doc_id", F.lit(50)).cast("int").alias("ruling_index"),
        F.concat(F.lit("CV"), F.lpad(F.pmod("doc_id", F.lit(1000)).cast("string"), 5, "0")).alias("case_number"),
        first_line.alias("case_title"),
        F.element_at(F.split(F.coalesce("text", F.lit("")), " "), 1).alias("motion_type"),
        classify.SHARED.outcome(F.col("text")).alias("outcome"),
        F.substring_index(F.coalesce("text", F.lit("")), "\n", -1).alias("outcome_text"),
        F.col("text").alias("body_text"),
        F.col("text").alias("full_text"),
        F.sha2("text", 256).alias("source_sha256"),
    )


@query("SELECT coalesce(lang, '') AS value, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def facet_lang(t: Tables) -> DataFrame:
    return view.facet(t.documents, "lang")


_OUT = classify.SHARED.sql_outcome("coalesce(text, '')")


@query(f"""SELECT lang, outcome, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY lang), 6)::DOUBLE AS share
FROM (SELECT lang, {_OUT} AS outcome FROM documents) GROUP BY lang, outcome""")
def outcome_distribution(t: Tables) -> DataFrame:
    counted = t.documents.select("lang", classify.SHARED.outcome(F.col("text")).alias("outcome")).groupBy("lang", "outcome").agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("lang")), 6))


#: Phrases that the tables of rulings know, laid over the documents by id so that every branch is met.
PHRASES = (
    "The motion is GRANTED.", "The demurrer is OVERRULED and the motion DENIED in part, GRANTED in part.", "The matter is continued to March 4, 2025.",
    "Hearing taken off calendar.", "Appearances are required.", "No appearance is necessary. Appearance required.", "There is no tentative ruling.",
    "VACATED. Dropped from calendar as moot.", "Absent objection, the petition is approved.", "Matter continued until 3/4/25; parties shall appear.", "Set for hearing.", "Motion is overruled.",
)
_PHRASE_SQL = "[" + ", ".join("'" + p + "'" for p in PHRASES) + f"][(doc_id % {len(PHRASES)})::INTEGER + 1]"


def _phrase():
    return F.element_at(F.array(*(F.lit(p) for p in PHRASES)), F.pmod("doc_id", F.lit(len(PHRASES))).cast("int") + 1)


_ALL_RULES = {"shared": classify.SHARED, **classify.COUNTY_RULES}
#: Whole texts, each with a phrase after it.
_PHRASED_SQL = f"(SELECT doc_id, coalesce(text, '') || chr(10) || {_PHRASE_SQL} AS x FROM documents)"


def _phrased(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), _phrase()).alias("x"))


@query("SELECT doc_id, " + ", ".join(f"{r.sql_outcome('x')} AS {n}" for n, r in _ALL_RULES.items()) + f" FROM {_PHRASED_SQL}")
def classify_precedence_variants(t: Tables) -> DataFrame:
    """Every document's outcome by the rules of every county."""
    return classify.outcomes(_phrased(t), F.col("x"), _ALL_RULES).drop("x")


@query(f"""SELECT doc_id, regexp_matches(lower(x), '\\b(?:absent|unless|if)\\b.{{0,80}}\\bobjection') AS conditional,
  CASE WHEN regexp_matches(x, '(?i)continued\\s+(?:to|until)\\s+March 4, 2025') THEN '2025-03-04'
       WHEN regexp_matches(x, '(?i)continued\\s+(?:to|until)\\s+3/4/25') THEN '2025-03-04' END AS continued_to FROM {_PHRASED_SQL}""")
def conditional_and_continued(t: Tables) -> DataFrame:
    """Every document's condition and new date."""
    return _phrased(t).select("doc_id", classify.SHARED.is_conditional(F.col("x")).alias("conditional"), classify.SHARED.continued_to(F.col("x")).cast("string").alias("continued_to"))


@query(f"SELECT doc_id, {clip_sql('text', 300)} AS clip_300, {clip_sql('text', 600)} AS clip_600 FROM documents")
def clip_excerpt(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.clip(F.col("text"), 300).alias("clip_300"), text.clip(F.col("text"), 600).alias("clip_600"))


_RID = "substr(sha256(coalesce(sha256(text), '') || ':' || doc_id || ':' || coalesce(source, '')), 1, 32)"
_TITLE = "string_split(coalesce(text, ''), chr(10))[1]"
_LAST = "string_split(coalesce(text, ''), chr(10))[-1]"


@query(f"""SELECT {_RID} AS ruling_id, lang AS county, source AS dept, {_DAY} AS hearing_date,
  CASE WHEN length({_TITLE}) > 512 THEN '' ELSE {_TITLE} END AS case_title,
  CASE WHEN length(string_split(coalesce(text, ''), ' ')[1]) > 256 THEN '' ELSE string_split(coalesce(text, ''), ' ')[1] END AS motion_type,
  'published' AS status, nullif({clip_sql(_LAST, 600)}, '') AS outcome_text, nullif({clip_sql('text', 300)}, '') AS body_text FROM documents""")
def summary_projection(t: Tables) -> DataFrame:
    out = warehouse.summary(rulings(t.documents))
    return out.select("ruling_id", "county", "dept", "hearing_date", "case_title", "motion_type", "status", "outcome_text", "body_text")


_NOTE = "Calendar notes are not yet\navailable.\nCheck back for updated  notes."
_NOTED = f"(coalesce(text, '') || CASE WHEN doc_id % 3 = 0 THEN '{_NOTE}' WHEN doc_id % 3 = 1 THEN 'Calendar notes are not yet available.' ELSE '' END)"


@query(f"""SELECT doc_id, CASE WHEN regexp_matches({_NOTED}, '(?is)calendar\\s+notes\\s+are\\s+not\\s+yet\\s+available.*check\\s+back\\s+for\\s+updated\\s+notes') THEN 'pending' ELSE 'published' END AS status FROM documents""")
def pending_status(t: Tables) -> DataFrame:
    """Every document's status; a third of the texts end with the whole note, a third with its start alone."""
    note = F.when(F.col("doc_id") % 3 == 0, _NOTE).when(F.col("doc_id") % 3 == 1, "Calendar notes are not yet available.").otherwise("")
    noted = F.concat(F.coalesce("text", F.lit("")), note)
    return t.documents.select("doc_id", warehouse.status_of(F.lit(None), F.lit(None), noted, F.lit(None)).alias("status"))


@query(f"SELECT doc_id, {_RID} AS ruling_id FROM documents")
def ruling_ids(t: Tables) -> DataFrame:
    return rulings(t.documents).select("doc_id", "ruling_id")


@query(f"""SELECT doc_id, upper(substr(lang, 1, 3)) || '-' || strftime({_DAY}, '%y%m%d') || '-D' || coalesce(nullif(source, ''), '?') || '-' || (doc_id % 50) AS short_id FROM documents""")
def short_ids(t: Tables) -> DataFrame:
    return rulings(t.documents).select("doc_id", ids.short_id(F.substring("county", 1, 3), F.col("hearing_date"), F.col("dept"), F.col("ruling_index")).alias("short_id"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows of up to 8 sources in order of id, with a logical key."""
    return docs.select("doc_id", (F.col("doc_id") % 8).alias("source_ord"), "lang", "text")


_KEY = f"coalesce(lang, '') || chr(1) || {_COLLAPSED.format('text')}"


def _logical():
    return F.concat(text.blank(F.col("lang")), F.lit("\x01"), text.collapse(F.col("text")))


@query(f"""SELECT doc_id, source_ord FROM (SELECT doc_id, doc_id % 8 AS source_ord, min(doc_id % 8) OVER (PARTITION BY {_KEY}) AS first FROM documents) WHERE source_ord = first""")
def logical_dedupe_first_source(t: Tables) -> DataFrame:
    return dedupe.first_source_wins(_keyed(t.documents), _logical(), "source_ord").select("doc_id", "source_ord")


@query(f"SELECT sha256({_KEY}) AS key, min(doc_id) AS first_id, count(*)::BIGINT AS n_rows FROM documents GROUP BY 1")
def logical_key_groups(t: Tables) -> DataFrame:
    return dedupe.key_groups(t.documents, F.sha2(_logical(), 256), "doc_id")


@query("SELECT doc_id % 500 AS id, count(*)::BIGINT AS n_rows FROM documents GROUP BY 1 HAVING count(DISTINCT text) > 1")
def id_conflicts(t: Tables) -> DataFrame:
    return dedupe.id_conflicts(t.documents.select((F.col("doc_id") % 500).alias("id"), "text"), "id", "text")


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unparsed_sources(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source").join(t.labels.select("doc_id"), "doc_id", "left_anti")


@query("""SELECT CASE WHEN length(coalesce(text, '')) < 200 THEN 'short' WHEN contains(text, ' | ') THEN 'table'
  WHEN EXISTS (SELECT 1 FROM benchmark b WHERE b.text <> '' AND contains(documents.text, b.text)) THEN 'boilerplate' ELSE 'likely' END AS bucket,
  count(*)::BIGINT AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""")
def coverage_buckets(t: Tables) -> DataFrame:
    """Unparsed documents by what they look like; boilerplate is text that holds a whole benchmark item."""
    left = unparsed_sources(t).select("doc_id").join(t.documents.select("doc_id", "text"), "doc_id")
    boiler = blocks.holding_any(left, t.benchmark.select(F.col("text").alias("phrase")), "doc_id", "text")
    bucket = F.when(F.length(F.coalesce("text", F.lit(""))) < 200, "short").when(F.contains("text", F.lit(" | ")), "table").when(F.col("holds"), "boilerplate").otherwise("likely")
    return boiler.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM documents WHERE contains(lower(concat_ws(' ', nullif(lang, ''), nullif(source, ''), nullif(text, ''))), 'tion the')")
def search_substring(t: Tables) -> DataFrame:
    return t.documents.where(view.search_matches(view.search_text("lang", "source", "text"), "TION the")).select("doc_id")


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(lower(concat_ws(' ', nullif(lang, ''), nullif(source, ''), nullif(text, ''))), 'th.*\. a.d')")
def search_wildcard(t: Tables) -> DataFrame:
    return t.documents.where(view.search_matches(view.search_text("lang", "source", "text"), "th*. a?d")).select("doc_id")


@query("""SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i))::INTEGER AS position, start::BIGINT AS start, length(block)::BIGINT AS n_chars FROM (
  SELECT doc_id, i, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, line AS block
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents))
WHERE regexp_matches(line, '^The ')""")
def anchored_lines(t: Tables) -> DataFrame:
    """Lines that open with the anchor, with their number among those and their offset."""
    hits = F.filter(blocks.lines_with_starts(F.col("text")), lambda x: x["line"].rlike("^The "))
    found = t.documents.select("doc_id", F.posexplode(hits).alias("i", "x"))
    return found.select("doc_id", (F.col("i") + 1).alias("position"), F.col("x.start").cast("long").alias("start"), F.length("x.line").cast("long").alias("n_chars"))


_ANCHORS = r"""WITH l AS (SELECT doc_id, length(text) AS total, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
p AS (SELECT doc_id, total, i, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM l)"""


@query(_ANCHORS + r""" SELECT doc_id, start, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY start), total)::BIGINT AS "end" FROM p WHERE regexp_matches(line, '^(?:The|Th[a-z]+) ')""")
def block_boundaries(t: Tables) -> DataFrame:
    """Blocks between anchors: from an anchor's line to the next one's, or to the end of the text."""
    found = blocks.split_at(t.documents, "(?:The|Th[a-z]+) ", ["doc_id"])
    return found.select("doc_id", F.col("start").cast("long").alias("start"), (F.col("start") + F.length("block")).cast("long").alias("end"))


@query(_ANCHORS + r""" SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY start))::INTEGER AS ruling_index, start FROM p WHERE regexp_matches(line, '^(?:The|Th[a-z]+) ') AND length(line) > 60""")
def block_index_after_filter(t: Tables) -> DataFrame:
    kept = F.filter(blocks.lines_with_starts(F.col("text")), lambda x: x["line"].rlike("^(?:The|Th[a-z]+) ") & (F.length(x["line"]) > 60))
    found = t.documents.select("doc_id", F.posexplode(F.transform(kept, lambda x: x["start"])).alias("i", "start"))
    return found.select("doc_id", (F.col("i") + 1).alias("ruling_index"), F.col("start").cast("long").alias("start"))


@query("""SELECT doc_id, greatest(1, len(list_filter(list_transform(range(len(string_split(text, chr(10)))), lambda i: i * 400), lambda s: s <= length(text) // 2)))::INTEGER AS page FROM documents WHERE text IS NOT NULL""")
def page_for_offset(t: Tables) -> DataFrame:
    """The page of the middle of each text, with a page every 400 characters and as many pages as lines."""
    starts = F.transform(F.sequence(F.lit(0), F.size(F.split("text", "\n")) - 1), lambda i: i * 400)
    return t.documents.where("text is not null").select("doc_id", blocks.page_for_offset(starts, F.floor(F.length("text") / 2)).alias("page"))


@query(f"SELECT count(*)::BIGINT AS rulings, count(DISTINCT lang)::BIGINT AS counties, count(DISTINCT sha256(text))::BIGINT AS sources, min({_DAY}) AS first_date, max({_DAY}) AS last_date FROM documents")
def live_stats(t: Tables) -> DataFrame:
    return warehouse.live_stats(rulings(t.documents))


@query(f"""WITH r AS (SELECT *, {_RID} AS rid, {_DAY} AS day FROM documents),
d AS (SELECT lang, sum(n)::BIGINT AS dup FROM (SELECT lang, rid, count(*) AS n FROM r GROUP BY ALL HAVING count(*) > 1) GROUP BY lang)
SELECT r.lang AS county, count(*)::BIGINT AS n_rows, count(DISTINCT sha256(text))::BIGINT AS n_sources, min(day) AS first_date, max(day) AS last_date,
  count_if(coalesce(text, '') = '')::BIGINT AS blank_body, count_if(length(text) < 40)::BIGINT AS short_body, count_if(doc_id % 7 = 0)::BIGINT AS bad_url, coalesce(any_value(d.dup), 0)::BIGINT AS dup_id_rows
FROM r LEFT JOIN d ON r.lang IS NOT DISTINCT FROM d.lang GROUP BY r.lang""")
def audit_by_county(t: Tables) -> DataFrame:
    url = F.when(F.col("doc_id") % 7 == 0, F.lit("ftp://x")).otherwise(F.lit("https://court.example/x.pdf"))
    return warehouse.audit(rulings(t.documents).withColumn("source_url", url))


@query("""SELECT doc_id, lang, NULL::INTEGER AS quality FROM documents UNION ALL SELECT doc_id, NULL, quality FROM labels""")
def schema_merge_union(t: Tables) -> DataFrame:
    """Rows of two tables of different columns; one column of the older table has only nulls so far."""
    older = t.documents.select("doc_id", "lang", F.lit(None).alias("quality"))
    return warehouse.merged(older, t.labels.select("doc_id", "quality"))


@query("SELECT 'append' AS mode, lang, (2 * count(*))::BIGINT AS n FROM documents GROUP BY lang UNION ALL SELECT 'replace', lang, count(*)::BIGINT FROM documents GROUP BY lang")
def replace_vs_append(t: Tables) -> DataFrame:
    """Rows by language if new rows are added to, or put in place of, those of their language."""
    old, new = t.documents.select("lang", "doc_id"), t.documents.select("lang", (-F.col("doc_id")).alias("doc_id"))
    replaced = old.join(new.select("lang").distinct(), old["lang"].eqNullSafe(new.select("lang").distinct()["lang"]), "left_anti").union(new)
    count = lambda mode, rows: rows.groupBy("lang").agg(F.count("*").alias("n")).select(F.lit(mode).alias("mode"), "lang", "n")
    return count("append", old.union(new)).union(count("replace", replaced))


@query("""SELECT coalesce(m.path, o.path) AS path, CASE WHEN o.path IS NULL THEN 'missing' WHEN m.path IS NULL THEN 'unlisted' WHEN m.bytes <> o.bytes THEN 'bytes' ELSE 'hash' END AS reason
FROM (SELECT doc_id::VARCHAR AS path, n_chars AS bytes, sha256(text) AS sha256 FROM documents) m
FULL JOIN (SELECT page_id::VARCHAR AS path, length(html) AS bytes, sha256(html) AS sha256 FROM pages) o ON m.path = o.path
WHERE o.path IS NULL OR m.path IS NULL OR m.bytes <> o.bytes OR m.sha256 <> o.sha256""")
def manifest_staleness(t: Tables) -> DataFrame:
    manifest = t.documents.select(F.col("doc_id").cast("string").alias("path"), F.col("n_chars").alias("bytes"), F.sha2("text", 256).alias("sha256"))
    outputs = t.pages.select(F.col("page_id").cast("string").alias("path"), F.length("html").cast("long").alias("bytes"), F.sha2("html", 256).alias("sha256"))
    return warehouse.stale_outputs(manifest, outputs)


_CELL = "(CASE doc_id % 4 WHEN 0 THEN '=' WHEN 1 THEN '@' WHEN 2 THEN '-\"' ELSE '' END || coalesce(text, ''))"
_GUARDED = f"(CASE WHEN regexp_matches({_CELL}, '^[=+\\-@\\t\\r]') THEN '''' || {_CELL} ELSE {_CELL} END)"


@query(f"""SELECT doc_id, CASE WHEN regexp_matches({_GUARDED}, '[",\\r\\n]') THEN '"' || replace({_GUARDED}, '"', '""') || '"' ELSE {_GUARDED} END AS cell FROM documents""")
def csv_guard(t: Tables) -> DataFrame:
    cell = F.concat(F.when(F.col("doc_id") % 4 == 0, "=").when(F.col("doc_id") % 4 == 1, "@").when(F.col("doc_id") % 4 == 2, '-"').otherwise(""), text.blank(F.col("text")))
    return t.documents.select("doc_id", text.csv_cell(cell).alias("cell"))


@query("""SELECT doc_id, least(greatest((doc_id % 9 - 2), 1), n)::INTEGER AS first_page, len(list_slice(pages, least(greatest(doc_id % 9 - 2, 1), n), least(greatest(doc_id % 12, least(greatest(doc_id % 9 - 2, 1), n)), n)))::INTEGER AS n_pages
FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS pages, len(string_split(coalesce(text, ''), chr(10))) AS n FROM documents)""")
def slice_span_clamp(t: Tables) -> DataFrame:
    pages = F.split(F.coalesce("text", F.lit("")), "\n")
    start, end = (F.col("doc_id") % 9 - 2).cast("int"), (F.col("doc_id") % 12).cast("int")
    return t.documents.select("doc_id", F.least(F.greatest(start, F.lit(1)), F.size(pages)).alias("first_page"), F.size(blocks.page_slice(pages, start, end)).alias("n_pages"))


@query("""SELECT doc_id, CASE WHEN coalesce(source, '') = '' THEN NULL WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'skip'
  WHEN source NOT IN (SELECT DISTINCT source FROM documents WHERE lang = 'fr') THEN 'text' WHEN doc_id % 6 = 0 THEN 'missing' ELSE 'slice' END AS plan FROM documents""")
def slice_plan(t: Tables) -> DataFrame:
    """What is to be done for each document's own file: labels stand for slices that are there, sources of French
    documents for PDF files."""
    rows = t.documents.select(F.col("doc_id").cast("string").alias("ruling_id"), F.col("source").alias("source_sha256"), F.when(F.col("doc_id") % 6 != 0, 1).alias("page_start"), F.lit(2).alias("page_end"))
    slices = t.labels.select(F.col("doc_id").cast("string").alias("ruling_id"))
    sources = t.documents.where("lang = 'fr'").select(F.col("source").alias("source_sha256"), F.lit("pdf").alias("extension"))
    return warehouse.slice_plan(rows, slices, sources).select(F.col("ruling_id").cast("long").alias("doc_id"), "plan")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN NULL ELSE strftime(DATE '2000-01-01' + (doc_id % 9000)::INTEGER, '%Y-%m-%d') END AS found FROM documents")
def date_formats(t: Tables) -> DataFrame:
    """Dates written in three ways, and one that the calendar lacks, parsed back."""
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.pmod("doc_id", F.lit(9000)).cast("int"))
    written = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("Heard on Friday, "), F.date_format(day, "MMMM d, yyyy"), F.lit(" at 9"))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("on "), F.date_format(day, "M/d/yyyy"))).when(F.col("doc_id") % 4 == 2, F.date_format(day, "yyyy-MM-dd")).otherwise("2/30/2024")
    return t.documents.select("doc_id", dates.find_date(written).cast("string").alias("found"))


@query()
def adjacent_page_dedupe(t: Tables) -> DataFrame:
    """Texts as pages of one line each, with pages dropped whose next one is nearly the same."""
    pages = t.documents.select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n").alias("pages"))
    return blocks.collapse_similar(pages).select("doc_id", F.size("pages").alias("n_pages"))


_PAGES_SQL = """WITH g AS (SELECT doc_id, list_transform(range(0, len(l), 6), lambda i: ['Superior Court', 'Department ' || coalesce(source, '')] || l[i + 1:i + 6] || ['- ' || (i // 6 + 1) || ' -']) AS pages
  FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
k AS (SELECT *, list_transform(pages, lambda p: list_transform(p, lambda x: CASE WHEN regexp_matches(x, '^[\\s–—-]*[0-9]+[\\s–—-]*$') THEN chr(10) ELSE trim(x) END)) AS kinds,
  CASE WHEN len(pages) < 2 THEN 0 ELSE list_min(list_transform(pages, lambda p: len(p))) END AS least FROM g),
a AS (SELECT *, coalesce(list_min(list_filter(range(least), lambda i: len(list_distinct(list_transform(kinds, lambda p: p[i + 1]))) > 1)), least) AS prefix FROM k),
b AS (SELECT *, coalesce(list_min(list_filter(range(least - prefix), lambda i: len(list_distinct(list_transform(kinds, lambda p: p[len(p) - i]))) > 1)), least - prefix) AS suffix FROM a)"""


def _headed_pages(t: Tables) -> DataFrame:
    """Whole texts as pages of six lines, each with a header of two lines and a page number below."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    head = F.concat(F.lit("Superior Court\nDepartment "), F.coalesce("source", F.lit("")), F.lit("\n"))
    page = lambda i: F.concat(head, F.array_join(F.slice("lines", i + 1, F.lit(6)), "\n"), F.lit("\n- "), F.floor(i / 6) + 1, F.lit(" -"))
    cut = t.documents.select("doc_id", "source", lines.alias("lines"))
    return cut.select("doc_id", F.transform(F.sequence(F.lit(0), F.size("lines") - 1, F.lit(6)), page).alias("pages"))


@query(_PAGES_SQL + " SELECT doc_id, prefix::INTEGER AS prefix, suffix::INTEGER AS suffix FROM b")
def shared_page_lines(t: Tables) -> DataFrame:
    """How many lines the pages of each document share at their starts and ends; page numbers count as alike."""
    return blocks.common_lines(_headed_pages(t), "doc_id")


@query(_PAGES_SQL + """ SELECT doc_id, len(pages)::INTEGER AS n_pages, sha256(array_to_string(list_transform(pages, lambda p: array_to_string(p[prefix + 1:len(p) - suffix], chr(10))), chr(12))) AS body_sha256 FROM b""")
def stripped_pages(t: Tables) -> DataFrame:
    """Whole pages without the header and footer lines that all pages of their document share."""
    body = F.array_join(blocks.without_shared_lines(F.col("pages")), "\x0c")
    return _headed_pages(t).select("doc_id", F.size("pages").alias("n_pages"), F.sha2(body, 256).alias("body_sha256"))


@query("""SELECT doc_id, CASE WHEN contains(c, 'PR') THEN 'Probate' WHEN contains(c, 'FL') THEN 'Family Law'
  WHEN contains(c, 'CV') OR contains(c, 'CU') OR contains(c, 'CLJ') OR contains(c, 'CIV') THEN 'Civil Law and Motion' ELSE lang END AS division
FROM (SELECT doc_id, lang, upper(substr(coalesce(text, ''), 1, 40)) AS c FROM documents)""")
def case_divisions(t: Tables) -> DataFrame:
    """Divisions by the letters of case numbers, for which the texts' first letters stand; else the language."""
    number = F.substring(F.coalesce("text", F.lit("")), 1, 40)
    return t.documents.select("doc_id", parsing.case_division(number, F.col("lang")).alias("division"))
