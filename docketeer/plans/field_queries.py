"""Queries over what stands in texts: spans cut out, labelled values, headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.functions import fields, spans
from docketeer.functions.text import let
from docketeer.operators import blocks
from docketeer.plans.registry import Tables, query


@query(r"""WITH l AS (SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
p AS (SELECT doc_id, text, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM l),
s AS (SELECT doc_id, text, a, a + length(line) + 12 AS b, max(a + length(line) + 12) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM p WHERE length(line) % 3 = 0),
g AS (SELECT doc_id, text, coalesce(before, 0) AS a, a AS b FROM s WHERE coalesce(before, 0) < a UNION ALL SELECT doc_id, any_value(text), max(b), length(any_value(text)) FROM s GROUP BY doc_id HAVING max(b) < length(any_value(text))),
k AS (SELECT doc_id, text, a, b, trim(substr(text, a + 1, b - a), chr(10)) AS body FROM g WHERE regexp_matches(substr(text, a + 1, b - a), '\S')),
o AS (SELECT doc_id, string_agg(body, chr(10) ORDER BY a) AS left_text, max(CASE WHEN b = length(text) THEN length(regexp_replace(text, '\s+$', '')) ELSE b END) AS kept_end, count(*) AS n_pieces FROM k GROUP BY doc_id)
SELECT d.doc_id, sha256(CASE WHEN d.doc_id IN (SELECT doc_id FROM s) THEN coalesce(left_text, '') ELSE coalesce(d.text, '') END) AS left_sha256,
  (CASE WHEN d.doc_id IN (SELECT doc_id FROM s) THEN coalesce(kept_end, 0) ELSE length(regexp_replace(coalesce(d.text, ''), '\s+$', '')) END)::INTEGER AS kept_end,
  (CASE WHEN d.doc_id IN (SELECT doc_id FROM s) THEN coalesce(n_pieces, 0) WHEN coalesce(d.text, '') = '' THEN 0 ELSE 1 END)::INTEGER AS n_pieces
FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id""")
def cut_spans(t: Tables) -> DataFrame:
    """Whole texts without some of their lines and what follows these closely, and where the last stretch ends that stays."""
    some = F.filter(blocks.lines_with_starts(F.col("text")), lambda x: F.length(x["line"]) % 3 == 0)
    cuts = F.transform(some, lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["line"]) + 12).alias("end")))
    cut = t.documents.select("doc_id", let(cuts, lambda c: spans.without_spans(F.col("text"), c)).alias("c"))
    return cut.select("doc_id", F.sha2("c.text", 256).alias("left_sha256"), "c.kept_end", F.size("c.pieces").alias("n_pieces"))


#: Words that stand for labels.
LABELS = ["the", "of", "and", "la", "de", "le", "in", "der"]
_LABELS_SQL = "[" + ", ".join(f"'{x}'" for x in LABELS) + "]"
_FIELD_SQL = "CASE WHEN coalesce(list_position(l, '{0}'), 0) = 0 THEN '' ELSE array_to_string(l[list_position(l, '{0}') + 1:coalesce(list_min(list_filter(m, lambda i: i >= list_position(l, '{0}'))), len(l))], chr(10)) END AS {0}_text"


@query(f"""SELECT doc_id, {', '.join(_FIELD_SQL.format(x) for x in LABELS)} FROM (
  SELECT doc_id, l, list_filter(range(len(l)), lambda i: list_contains({_LABELS_SQL}, l[i + 1])) AS m FROM (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS l FROM documents))""")
def labelled_fields(t: Tables) -> DataFrame:
    """Whole texts read as forms, one word a line: what follows the first of each label up to the next label."""
    read = t.documents.select("doc_id", fields.labelled_values(F.split(F.coalesce("text", F.lit("")), " "), LABELS).alias("f"))
    return read.select("doc_id", *(F.col("f")[x].alias(f"{x}_text") for x in LABELS))


_HEADERS = ("Probate  Calendar", "law & motion", "LAW\nAND   Motion", "Family", "the civil calendar", "CRIMINAL", "")
_HEADER_SQL = "concat_ws(' ', text, [" + ", ".join(f"'{h}'" for h in _HEADERS) + f"][(doc_id % {len(_HEADERS)})::INTEGER + 1])"
_DEPT_SQL = "CASE WHEN doc_id % 3 = 0 THEN string_split(trim(coalesce(text, '')), ' ')[1] WHEN doc_id % 3 = 1 THEN ' ' || [" + ", ".join(f"'{w.title()}'" for w in fields.DEPARTMENT_WORDS) + f"][(doc_id % {len(fields.DEPARTMENT_WORDS)})::INTEGER + 1] || '. ' ELSE source END"
_NUMBER_SQL = "(' ' || substr(coalesce(text, ''), 1, 30) || ' –  ' || doc_id || '- -')"


def _words_sql(county: str, text: str) -> str:
    cases = " ".join(f"WHEN {' OR '.join(f'contains({text}, {w!r})' for w in words)} THEN {name!r}" for words, name in fields.DIVISION_WORDS[county])
    return f"CASE {cases} ELSE lang END"


@query(rf"""WITH h AS (SELECT doc_id, lang, upper({_HEADER_SQL}) AS up, {_DEPT_SQL} AS d, {_NUMBER_SQL} AS n FROM documents),
x AS (SELECT *, regexp_replace(up, '\s+', ' ', 'g') AS flat, regexp_replace(trim(regexp_replace(d, '\s+', ' ', 'g')), '^[ .]+|[ .]+$', '', 'g') AS dt FROM h)
SELECT doc_id, {_words_sql('el_dorado', 'flat')} AS division_el_dorado, {_words_sql('orange', 'up')} AS division_orange,
  CASE WHEN coalesce(d, '') = '' THEN NULL ELSE coalesce((list_position([{', '.join(f"'{w}'" for w in fields.DEPARTMENT_WORDS)}], lower(dt)))::VARCHAR, dt) END AS dept,
  regexp_replace(trim(n, ' ' || chr(10)), '\s+', '-', 'g') AS number_amador,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(trim(n, ' ' || chr(10)), '–', '-'), '\s*-\s*', '-', 'g'), '\s+', '', 'g'), '-+', '-', 'g'), '-+$', '') AS number_orange,
  upper(replace(regexp_replace(n, '\s+', '', 'g'), 'ß', 'SS')) AS number_san_bernardino FROM x""")
def court_headers(t: Tables) -> DataFrame:
    """Divisions, departments and case numbers as the counties write them; whole texts stand for headers."""
    header = F.concat_ws(" ", "text", F.element_at(F.array(*map(F.lit, _HEADERS)), (F.col("doc_id") % len(_HEADERS)).cast("int") + 1))
    word = F.element_at(F.array(*(F.lit(w.title()) for w in fields.DEPARTMENT_WORDS)), (F.col("doc_id") % len(fields.DEPARTMENT_WORDS)).cast("int") + 1)
    first = F.element_at(F.split(F.trim(F.coalesce("text", F.lit(""))), " "), 1)
    dept = F.when(F.col("doc_id") % 3 == 0, first).when(F.col("doc_id") % 3 == 1, F.concat(F.lit(" "), word, F.lit(". "))).otherwise(F.col("source"))
    number = F.concat(F.lit(" "), F.substring(F.coalesce("text", F.lit("")), 1, 30), F.lit(" –  "), F.col("doc_id"), F.lit("- -"))
    return t.documents.select(
        "doc_id",
        fields.header_division(header, "el_dorado", F.col("lang")).alias("division_el_dorado"),
        fields.header_division(header, "orange", F.col("lang")).alias("division_orange"),
        fields.department(dept).alias("dept"),
        *(fields.case_number(number, county).alias(f"number_{county}") for county in ("amador", "orange", "san_bernardino")),
    )
