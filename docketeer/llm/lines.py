"""Line dedup: winnowing over line hashes.

Lines are compared without surrounding ASCII white space; blank lines don't count.  The minimum of each window of
MIN_LINES line hashes is a fingerprint, so any repeated run of MIN_LINES lines or more shares one.  Documents that
hold a fingerprint of two places are joined on it; from there runs are extended both ways, as windows of MIN_LINES
lines around the fingerprint, compared by hash.  A line goes if it lies in a window that has an equal one earlier (by
doc_id, then position), overlapping or not; the first occurrence stays.

Defined results: null text is empty and stays null; blank lines stay where they are; documents under MIN_LINES lines
don't change; rows equal in doc_id and text count once, and both lose the same lines; a null doc_id comes
before all others; a text that loses all its lines
keeps its blank lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketeer.llm.common import slices, written
from docketeer.llm.repeats import gram_hashes, repeated_seeds, repeated_windows, selected

MIN_LINES = 3
_WHITE = b" \t\n\x0b\x0c\r"


def line_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each line that isn't blank."""
    import xxhash

    lines = (line.strip(_WHITE) for line in text.encode("utf-8", "surrogatepass").split(b"\n"))
    return np.array([xxhash.xxh64_intdigest(line) for line in lines if line], np.uint64)


def _rid():
    return F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")))


def hashed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, lines): the line hashes of each document with MIN_LINES lines or more."""
    source = docs.select("doc_id", _rid().alias("rid"), F.col("text").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [line_hashes(t or "") for t in part.column(2).to_pylist()]
            rows = [i for i, x in enumerate(found) if len(x) >= MIN_LINES]
            take = pa.array(rows, pa.int64())
            offsets = np.concatenate(([0], np.cumsum([len(found[i]) for i in rows]))).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.uint64), *(found[i] for i in rows)]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), lists], names=["doc_id", "rid", "lines"])

    return source.mapInArrow(run, f"doc_id {kind}, rid long, lines array<long>").dropDuplicates(["doc_id", "rid"])


def _lists(column: pa.Array) -> list[np.ndarray]:
    values, offsets = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def fingerprints(lines: DataFrame, length: int = MIN_LINES) -> DataFrame:
    """(seed, doc_id, owner, pos): the window minima of each document; owner is its rid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            seeds, places, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, units in enumerate(_lists(part.column(2))):
                grams, chosen = selected(units, length, 1)
                chosen = np.unique(chosen)
                seeds.append(grams[chosen])
                places.append(chosen)
                rows.append(np.full(len(chosen), i))
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(seeds).view(np.int64)), part.column(0).take(take), part.column(1).take(take), pa.array(np.concatenate(places).astype(np.int32))], names=["seed", "doc_id", "owner", "pos"])

    kind = lines.schema["doc_id"].dataType.simpleString()
    return lines.select("doc_id", "rid", "lines").mapInArrow(run, f"seed long, doc_id {kind}, owner long, pos int")


def _windows(lines: DataFrame, length: int) -> DataFrame:
    """lines (doc_id, rid, lines, places) to the windows (w, doc_id, rid, s) whose minimum is in places."""
    kind = lines.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            hashes, starts, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, (units, places) in enumerate(zip(_lists(part.column(2)), part.column(3).to_pylist(), strict=True)):
                _, chosen = selected(units, length, 1)
                s = np.flatnonzero(np.isin(chosen, places))
                hashes.append(gram_hashes(units, length)[s])
                starts.append(s)
                rows.append(np.full(len(s), i))
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), part.column(0).take(take), part.column(1).take(take), pa.array(np.concatenate(starts).astype(np.int32))], names=["w", "doc_id", "rid", "s"])

    return lines.select("doc_id", "rid", "lines", "places").mapInArrow(run, f"w long, doc_id {kind}, rid long, s int")


def later_runs(docs: DataFrame, length: int = MIN_LINES) -> DataFrame:
    """(doc_id, rid, starts): of each document the windows of length lines, by number of non-blank line, that occur earlier."""
    lines = written(hashed_lines(docs), "lines")
    marks = written(fingerprints(lines, length), "fingerprints")
    places = marks.join(repeated_seeds(marks), "seed").groupBy(F.col("doc_id").alias("__doc"), F.col("owner").alias("__rid")).agg(F.collect_set("pos").alias("places"))
    placed = lines.join(places, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("rid") == F.col("__rid")))
    found = repeated_windows(written(_windows(placed, length), "windows"))
    return found.where("later").groupBy("doc_id", "rid").agg(F.sort_array(F.collect_list("s")).alias("starts"))


def without_lines(text: str | None, starts: list[int] | None, length: int = MIN_LINES) -> tuple[str | None, int, int]:
    """The text without the lines of the windows, its non-blank lines, and how many of these went."""
    lines = (text or "").split("\n")
    gone, number, kept = {s + k for s in starts or () for k in range(length)}, 0, []
    for line in lines:
        if line.strip(_WHITE.decode()):
            if number not in gone:
                kept.append(line)
            number += 1
        else:
            kept.append(line)
    return (text if not gone else "\n".join(kept)), number, len(gone)


def dedup_lines(docs: DataFrame, length: int = MIN_LINES) -> DataFrame:
    """docs with later repeated runs deleted from text, plus n_lines and n_deleted (earlier columns of these names go)."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    runs = written(later_runs(docs, length), "runs").select(F.col("doc_id").alias("__doc"), F.col("rid").alias("__run"), F.col("starts").alias("__starts"))
    # hashed, not sorted: texts are moved once, and the side with runs (one row a document, numbers alone) fits a task
    joined = docs.select(*names, _rid().alias("__rid")).join(runs.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__rid") == F.col("__run")), "left").select(*names, "__starts")
    schema = T.StructType([*docs.select(*names).schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_deleted", T.LongType())])
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for part in slices(batches):
            made = [without_lines(t, s, length) for t, s in zip(part.column(at).to_pylist(), part.column(len(names)).to_pylist(), strict=True)]
            columns = [*part.columns[: len(names)], *(pa.array([m[k] for m in made], pa.int64()) for k in (1, 2))]
            columns[at] = pa.array([m[0] for m in made], arrow.field(at).type)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return joined.mapInArrow(run, schema)


def document_lines(docs: DataFrame) -> DataFrame:
    """The columns of op8_line_dedup."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def keep_lines(docs: DataFrame) -> DataFrame:
    """docs after line dedup, without the documents that lost all their lines."""
    out = dedup_lines(docs)
    return out.where("n_deleted = 0 or n_deleted < n_lines").select(docs.columns)


#: The same rows from the definition alone: every window of three lines by its whole text.
ORACLE_SQL = r"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
marked AS (
  SELECT doc_id, i, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM parts),
filled AS (
  SELECT doc_id, i, line, t, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k FROM marked WHERE t <> ''),
windows AS (
  SELECT * FROM (
    SELECT doc_id, k, t AS a, lead(t, 1) OVER w AS b, lead(t, 2) OVER w AS c FROM filled
    WINDOW w AS (PARTITION BY doc_id ORDER BY k)) WHERE c IS NOT NULL),
ranked AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS n FROM windows),
gone AS (
  SELECT DISTINCT doc_id, k + j AS k FROM ranked, range(3) r(j) WHERE n > 1),
kept AS (
  SELECT m.doc_id, m.i, m.line, f.k IS NOT NULL AS filled, g.k IS NOT NULL AS gone
  FROM marked m LEFT JOIN filled f ON m.doc_id = f.doc_id AND m.i = f.i
  LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.k = g.k)
SELECT doc_id, count_if(filled)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_deleted,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS text_sha256
FROM kept GROUP BY doc_id
"""
