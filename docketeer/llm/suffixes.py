"""Suffix-array dedup of word passages with a sparse suffix array.

Suffixes are kept only at minimiser positions: for each window of MIN_WORDS words the leftmost minimum of its
GRAM-word hashes; equal windows keep the same position of theirs.  The kept suffixes are ordered by their leading GRAM
words (16 bits of each word's hash, so that the order is one of sequences): they are dealt out by range, sorted, and
each is compared with its neighbours; one that shares its leading words with neither goes.

What is left is extended: a suffix's right context and its left context are taken as far as each window that keeps it
reaches.  These (right, left) pairs are ordered in turn, right context first, so that those alike on the right lie
together and are ordered by what precedes them; again neighbours are compared.  A third suffix that is alike on the
right alone therefore never parts two that match on both sides.  Equal neighbouring windows join to maximal passages.

Ranges are cut by place too, so that the copies of a frequent passage spread over tasks; where two ranges meet, the
first and the last row of each are compared with one another.

Exact copies of a text are grouped first and take no part but for the smallest doc_id: of a copied text of MIN_WORDS
words or more all of it is repeated, and it is kept in the smallest doc_id only.

Defined results: null text is empty; texts under MIN_WORDS words have no passages; rows equal in doc_id and text
count once; a null doc_id comes before all others; a passage that repeats inside one document is found too; an empty
table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docketeer.llm.common import slices, written
from docketeer.llm.repeats import hash_words, mix, powers, selected, spans_of

MIN_WORDS, GRAM = 50, 12
#: A word in the order of suffixes.
CODE = np.dtype(">u2")


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, rid (of doc_id and text), tid and tid2 (of the text), n_words and text.  (doc_id, rid) names a row, (tid,
    tid2) a text."""
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return text.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"), F.xxhash64("text").alias("tid"), F.xxhash64(F.lit(1), "text").alias("tid2"), words.alias("n_words"), "text")


def _with_row(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """left joined with right (doc_id, rid and more) by both, null doc_ids included."""
    other = right.withColumnRenamed("doc_id", "__doc").withColumnRenamed("rid", "__rid")
    joined = left.join(other, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("rid") == F.col("__rid")), how)
    return joined if how == "left_semi" else joined.drop("__doc", "__rid")


def _arrow(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64) if x.dtype == np.uint64 else x)


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary value of each row of a byte matrix."""
    offsets = (np.arange(len(rows) + 1) * rows.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


# --- the order of suffixes ------------------------------------------------------------------------------------------


def sparse_suffixes(source: DataFrame, length: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """source (doc_id, rid, text) to (lead, doc_id, rid, pos): the kept suffixes, with the codes of their leading words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            leads, places, rows = [np.zeros((0, 2 * gram), np.uint8)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for i, text in enumerate(part.column(2).to_pylist()):
                units = hash_words(text.encode("utf-8", "surrogatepass"))
                chosen = np.unique(selected(units, length, gram)[1])
                if len(chosen):
                    codes = (units >> np.uint64(48)).astype(CODE)
                    leads.append(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, gram)[chosen]).view(np.uint8))
                    places.append(chosen.astype(np.int32))
                    rows.append(np.full(len(chosen), i))
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([_binary(np.concatenate(leads)), part.column(0).take(take), part.column(1).take(take), _arrow(np.concatenate(places))], names=["lead", "doc_id", "rid", "pos"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.select("doc_id", "rid", "text").mapInArrow(run, f"lead binary, doc_id {kind}, rid long, pos int")


def _equal_next(batch: pa.RecordBatch, columns: range) -> np.ndarray:
    """Whether each row but the last has the next one's values in the columns; nulls are equal."""
    out = np.ones(max(0, batch.num_rows - 1), bool)
    for k in columns:
        a, b = batch.column(k).slice(0, batch.num_rows - 1), batch.column(k).slice(1)
        same = pc.fill_null(pc.equal(a, b), False)
        if batch.column(k).null_count:
            same = pc.or_(same, pc.and_(pc.is_null(a), pc.is_null(b)))
        out &= same.to_numpy(zero_copy_only=False)
    return out


def compared(rows: DataFrame, key: list[str], place: list[str]) -> DataFrame:
    """rows (key and place columns) in the order of key, then place, each compared with its neighbours.

    Rows that share their key with a neighbour stay, and the first and the last row of each range: key, place, later
    (the row before has the same key), repeated (a neighbour has it), part (number of the range) and edge (1 first, 2
    last, 3 both, else 0).  Rows equal in key and place count once.  Nothing is held but one batch and one row.
    """
    ordered = rows.select(*key, *place).repartitionByRange(*key, *place).sortWithinPartitions(*key, *place)
    schema = T.StructType([*ordered.schema.fields, T.StructField("later", T.BooleanType()), T.StructField("repeated", T.BooleanType()), T.StructField("edge", T.IntegerType()), T.StructField("part", T.IntegerType())])
    keys, everything = range(len(key)), range(len(key) + len(place))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, part, held, before, start = to_arrow_schema(schema), TaskContext.get().partitionId(), None, False, True

        def out(batch: pa.RecordBatch, later: np.ndarray, repeated: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
            stay = pa.array(np.flatnonzero(repeated | (edge > 0)))
            made = [*batch.columns, pa.array(later), pa.array(repeated), pa.array(edge.astype(np.int32)), pa.array(np.full(batch.num_rows, part, np.int32))]
            return pa.RecordBatch.from_arrays([c.take(stay).cast(f.type) for c, f in zip(made, arrow, strict=True)], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.concat_batches([held, batch.cast(held.schema)])
            new = np.concatenate(([True], ~_equal_next(batch, everything)))
            batch = batch.take(pa.array(np.flatnonzero(new)))
            same = _equal_next(batch, keys)
            later = np.concatenate(([before], same))
            if batch.num_rows > 1:
                edge = np.zeros(batch.num_rows - 1, np.int64)
                edge[0] = int(start)
                yield out(batch.slice(0, batch.num_rows - 1), later[:-1], later[:-1] | same, edge)
                start = False
            held, before = batch.slice(batch.num_rows - 1), bool(later[-1])
        if held is not None:
            yield out(held, np.array([before]), np.array([before]), np.array([3 if start else 2]))

    return ordered.mapInArrow(run, schema)


def with_edges(found: DataFrame, key: list[str], place: list[str]) -> DataFrame:
    """compared() rows (written) to (place, later) of those that are repeated: what the ends of ranges share is added.

    The ends are at most two rows a range; they alone come together, in the order of the ranges.
    """
    ends = Window.orderBy("part", "edge")
    meets = lambda side: reduce(and_, (F.coalesce(side(k).over(ends) == F.col(k), F.lit(False)) for k in key))
    marked = found.where("edge > 0").withColumn("__before", meets(F.lag)).withColumn("__after", meets(F.lead))
    opens, closes = F.col("edge").isin(1, 3) & F.col("__before"), F.col("edge").isin(2, 3) & F.col("__after")
    settled = marked.select(*place, (F.col("later") | opens).alias("later"), (F.col("repeated") | opens | closes).alias("repeated"))
    return found.where("edge = 0").select(*place, "later", "repeated").union(settled).where("repeated").drop("repeated")


# --- both contexts --------------------------------------------------------------------------------------------------


def contexts(units: np.ndarray, starts: np.ndarray, middles: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words from each middle to the end of its window, and of those from the window's start to it."""
    up, down = powers("up", len(units)), powers("down", len(units) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(units * up, dtype=np.uint64)))
    right = mix((sums[starts + length] - sums[middles]) * down[middles] + np.uint64(1))
    left = mix((sums[middles] - sums[starts]) * down[starts] + np.uint64(2))
    return right, left


def _extended(source: DataFrame, length: int, gram: int) -> DataFrame:
    """source (doc_id, rid, text, places) to (right, left, doc_id, rid, s) of each window whose kept position is in places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 200):
            rights, lefts, starts, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, (text, places) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                units = hash_words(text.encode("utf-8", "surrogatepass"))
                chosen = selected(units, length, gram)[1]
                s = np.flatnonzero(np.isin(chosen, places))
                right, left = contexts(units, s, chosen[s], length)
                for held, now in ((rights, right), (lefts, left), (starts, s), (rows, np.full(len(s), i))):
                    held.append(now)
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([_arrow(np.concatenate(rights)), _arrow(np.concatenate(lefts)), part.column(0).take(take), part.column(1).take(take), _arrow(np.concatenate(starts).astype(np.int32))], names=["right", "left", "doc_id", "rid", "s"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.select("doc_id", "rid", "text", "places").mapInArrow(run, f"right long, left long, doc_id {kind}, rid long, s int")


def _merged(found: DataFrame, length: int) -> DataFrame:
    """Repeated windows of each document to its spans: (doc_id, rid, spans, removed)."""
    grouped = found.groupBy("doc_id", "rid").agg(F.sort_array(F.collect_list("s")).alias("all"), F.sort_array(F.collect_list(F.when(F.col("later"), F.col("s")))).alias("later"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = [[[{"start": a, "end": b} for a, b in spans_of(np.array(x, np.int64), length)] for x in part.column(k).to_pylist()] for k in (2, 3)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(m, kind) for m in made)], names=["doc_id", "rid", "spans", "removed"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return grouped.mapInArrow(run, f"doc_id {kind}, rid long, spans array<struct<start:int,end:int>>, removed array<struct<start:int,end:int>>")


def repeated_passages(docs: DataFrame, length: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """One row per document with a passage of length words or more that occurs twice or more in the table.

    doc_id, rid, n_words, spans (word offsets of all repeated passages), removed (those that are not their first
    occurrence, by doc_id), copy_of (the smallest doc_id with the same text, for exact copies only).
    """
    source = _identified(docs)
    rows = written(source.where(F.col("n_words") >= length).select("doc_id", "rid", "tid", "tid2", "n_words").distinct(), "rows")
    texts = written(rows.groupBy("tid", "tid2").agg(F.min(F.struct("doc_id", "rid")).alias("first"), F.count("*").alias("copies")), "texts")  # written: a text of many copies is a hot key
    first = F.struct("doc_id", "rid")
    marked = written(rows.join(texts, ["tid", "tid2"]).select("doc_id", "rid", "n_words", F.col("first.doc_id").alias("copy_of"), first.eqNullSafe(F.col("first")).alias("leads"), "copies"), "marked")

    leading = _with_row(source.select("doc_id", "rid", "text"), marked.where("leads").select("doc_id", "rid"), "left_semi")
    suffixes = written(sparse_suffixes(leading, length, gram), "suffixes")
    shared = compared(suffixes, ["lead"], ["doc_id", "rid", "pos"])  # with the ends of ranges, which do no harm here
    places = written(shared.groupBy("doc_id", "rid").agg(F.collect_set("pos").alias("places")), "places")
    windows = written(_extended(_with_row(source.select("doc_id", "rid", "text"), places), length, gram), "windows")
    found = written(compared(windows, ["right", "left"], ["doc_id", "rid", "s"]), "compared")
    partial = _merged(with_edges(found, ["right", "left"], ["doc_id", "rid", "s"]), length)

    full = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end")))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    out = _with_row(marked, partial, "left").where("copies > 1 or spans is not null")
    copied = F.col("copies") > 1
    return out.select(
        "doc_id",
        "rid",
        F.col("n_words").cast("long").alias("n_words"),
        F.when(copied, full).otherwise(F.col("spans")).alias("spans"),
        F.when(copied & ~F.col("leads"), full).otherwise(F.coalesce("removed", none)).alias("removed"),
        F.when(copied, F.col("copy_of")).alias("copy_of"),
    )


def remove_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs without the words of the removed spans: where words go, the rest is joined by single spaces."""
    spans = found.where("size(removed) > 0").select(F.col("doc_id").alias("__doc"), F.col("rid").alias("__row"), F.col("removed").alias("__removed")).dropDuplicates(["__doc", "__row"])
    names = docs.columns
    row = F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")))
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("__doc")) & (row == F.col("__row")), "left")
    words = r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"
    kept = F.expr(f"array_join(filter({words}, (w, i) -> not exists(__removed, r -> i >= r.start and i < r.end)), ' ')")
    return joined.withColumn("text", F.when(F.col("__removed").isNull(), F.col("text")).otherwise(kept)).select(names)


def document_passages(docs: DataFrame) -> DataFrame:
    """The columns of op1_suffix_dedup."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    count = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    found = repeated_passages(docs)
    return found.select("doc_id", "n_words", count("spans").alias("n_repeated"), count("removed").alias("n_removed"), text("spans").alias("spans"), text("removed").alias("removed"), "copy_of")
