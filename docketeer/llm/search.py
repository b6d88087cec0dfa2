"""Ranked lexical search with block-max pruning over a forward index in blocks of documents.

`build_index` writes one row per block: up to BLOCK_DOCS documents that follow each other in the table, their forward
index (each document's terms and counts), and for each term of the block how many of its documents hold it, its
greatest count and the least length of a document with it.  Numbers of the whole corpus aren't stored, so that an index
can be added to; a term's greatest share in any score of the block follows from its greatest count and least length.

`search` takes queries in groups of a bounded size.  It sums document frequencies of the group's terms, bounds every
block for every query, scores the most promising blocks first, which gives each query a threshold, then goes through
all blocks: in each task they are sorted by a query's bound and scored from the forward index until the bound drops
below the threshold, which rises with what is found.  Each task hands on k rows a query at most.

The score of a document with n terms, of N documents with L terms in all:
    sum over the query's terms, repeats included, of w * ((1000000000 * tf) div (1000 * tf + 8 * m))
    w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))),  m = 25 + (75 * n * N) div L
Terms are stretches of ASCII letters and digits and of all other characters beyond ASCII; only A-Z are lower-cased.

Defined results: null and empty texts hold no terms, never score and don't count in N; each row of the documents is a
document of its own, also where keys repeat; a null key sorts after all others; each row of the queries is a query of
its own; queries without terms, or whose terms no document holds, give no rows; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docketeer.llm.common import shared_path, written

#: A block closes at so many documents or bytes of text; one longer text is a block of its own.
BLOCK_DOCS, BLOCK_BYTES = 16, 1_000_000
#: Queries, and bytes of their texts, that are looked for together; bounds what the driver and each task hold of them.
QUERIES_TOGETHER, QUERY_BYTES = 256, 4_000_000
#: Blocks of each query that are scored first, of as many from each task.
FIRST_BLOCKS = 4
#: A query's blocks are scored in rounds, each so many times as far down its list as the one before.
ROUND = 4
#: Sums of whole numbers below this are exact in doubles.
EXACT = 2**53
#: ASCII letters and digits and all bytes of other characters belong to terms, A-Z are lower-cased.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: What a block's row holds beside its documents' keys: whole numbers, the terms' bytes one after another, and columns of
#: little-endian 32-bit numbers: by document its length and how many different terms it holds, by term its bytes, the
#: documents with it, its greatest count and the least length of those documents, by document and term the term's place
#: and count.
COUNTS, TEXTS = ("block", "n_docs", "n_terms"), ("term_bytes",)
ARRAYS = ("lengths", "sizes", "term_sizes", "term_docs", "term_most", "term_least", "doc_terms", "doc_counts")
#: Small row groups, as a reader holds a whole one.
FILE_OPTIONS = {"compression": "zstd", "parquet.block.size": str(8 * 1024 * 1024), "parquet.block.size.row.check.min": "8"}


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


# --- the index ------------------------------------------------------------------------------------------------------


def block_of(texts: list[bytes]) -> dict:
    """A block's fields but for its number, of its documents' texts."""
    cut = [terms_of(t) for t in texts]
    lengths = np.array([len(t) for t in cut], np.int64)
    names = sorted(set().union(*cut))
    number = {t: i for i, t in enumerate(names)}
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64, int(lengths.sum()))
    width = max(1, len(names))
    pairs, counts = np.unique(np.repeat(np.arange(len(cut)), lengths) * width + ids, return_counts=True)
    doc, term = pairs // width, pairs % width
    most, least = np.zeros(len(names), np.int64), np.full(len(names), np.iinfo(np.int32).max)
    np.maximum.at(most, term, counts)
    np.minimum.at(least, term, lengths[doc])
    arrays = (lengths, np.bincount(doc, minlength=len(cut)), [len(t) for t in names], np.bincount(term, minlength=len(names)), most, least, term, counts)
    return {"n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()), "term_bytes": b"".join(names)} | {k: np.asarray(v, "<i4").tobytes() for k, v in zip(ARRAYS, arrays, strict=True)}


def build_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the block index of docs to path: columns keys (array of key), COUNTS, TEXTS and ARRAYS."""
    source = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    fields = [T.StructField("keys", T.ArrayType(source.schema[0].dataType)), *(T.StructField(c, T.LongType()) for c in COUNTS), *(T.StructField(c, T.BinaryType()) for c in TEXTS + ARRAYS)]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, number = to_arrow_schema(schema), TaskContext.get().partitionId() << 33
        for batch in batches:
            at, size = 0, pc.binary_length(batch.column(1)).to_pylist()
            while at < batch.num_rows:
                end, held = at + 1, size[at]
                while end < batch.num_rows and end - at < BLOCK_DOCS and held + size[end] <= BLOCK_BYTES:
                    held, end = held + size[end], end + 1
                part = batch.slice(at, end - at)
                keys = pa.ListArray.from_arrays(pa.array([0, end - at], pa.int32()), part.column(0), type=arrow.field(0).type)
                row = block_of(part.column(1).to_pylist()) | {"block": number}
                yield pa.RecordBatch.from_arrays([keys, *(pa.array([row[f.name]], f.type) for f in list(arrow)[1:])], schema=arrow)
                at, number = end, number + 1

    source.mapInArrow(run, schema).write.options(**FILE_OPTIONS).parquet(path)


# --- queries --------------------------------------------------------------------------------------------------------


class Queries:
    """A group of queries: their terms and, once corpus numbers are known, the terms' weights by query."""

    def __init__(self, texts: list[bytes]) -> None:
        counts = [Counter(terms_of(t)) for t in texts]
        self.n = len(texts)
        self.names = sorted(set().union(*counts))
        number = {t: i for i, t in enumerate(self.names)}
        entries = sorted((number[t], q, c) for q, found in enumerate(counts) for t, c in found.items())
        self.term, self.query, self.times = (np.array(x, np.int64) for x in (zip(*entries, strict=True) if entries else ((), (), ())))

    def weigh(self, docs: int, terms: int, frequency: dict[int, int]) -> None:
        """docs: N; terms: L; frequency: df by number of the term."""
        self.docs, self.terms = docs, terms
        weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * frequency.get(i, 0) + 1))) for i in range(len(self.names))], np.int64)
        self.weight = self.times * weight[self.term]
        self.starts = np.searchsorted(self.term, np.arange(len(self.names) + 1))
        most = np.bincount(self.query, self.weight, self.n).max(initial=0) * 1e6
        self.kind = np.float64 if most < EXACT else np.int64

    def rows(self, terms: np.ndarray) -> np.ndarray:
        """The weights of these terms (numbers) for each query."""
        out = np.zeros((len(terms), self.n), self.kind)
        sizes = self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(self.starts[terms] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        out[np.repeat(np.arange(len(terms)), sizes), self.query[at]] = self.weight[at]
        return out

    def shares(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A term's share in a score before its weight, by its count and the document's length."""
        if 75 * int(lengths.max(initial=0)) * self.docs < 2**63:
            m = 25 + (75 * lengths * self.docs) // self.terms
        else:
            m = np.array([25 + (75 * int(n) * self.docs) // self.terms for n in lengths], np.int64)
        return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class Block:
    """A row of the index beside a group of queries: the terms that both have, by place in the block and by number."""

    def __init__(self, batch: pa.RecordBatch, row: int, names: pa.Array) -> None:
        self.batch, self.row = batch, row
        sizes = self.numbers("term_sizes")
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        self.n_terms = len(sizes)
        held = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), batch.column("term_bytes")[row].as_buffer()])
        found = pc.index_in(held, value_set=names)
        self.at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        self.term = found.take(pa.array(self.at)).to_numpy(zero_copy_only=False).astype(np.int64)

    def numbers(self, name: str) -> np.ndarray:
        return np.frombuffer(self.batch.column(name)[self.row].as_buffer(), "<i4")

    def keys(self) -> pa.Array:
        return self.batch.column("keys")[self.row].values

    def bounds(self, queries: Queries) -> np.ndarray:
        """No document of the block can score more for each query."""
        most, least = (self.numbers(c)[self.at].astype(np.int64) for c in ("term_most", "term_least"))
        return queries.shares(most, least).astype(queries.kind) @ queries.rows(self.term)

    def scores(self, queries: Queries, chosen: np.ndarray) -> np.ndarray:
        """Scores of the block's documents (rows) for the chosen queries (columns), from its forward index."""
        lengths = self.numbers("lengths").astype(np.int64)
        place = np.full(self.n_terms, -1)
        place[self.at] = np.arange(len(self.at))
        local = place[self.numbers("doc_terms")]
        held = np.flatnonzero(local >= 0)
        doc = np.repeat(np.arange(len(lengths)), self.numbers("sizes"))[held]
        out = np.zeros((len(lengths), len(self.at)), queries.kind)
        out[doc, local[held]] = queries.shares(self.numbers("doc_counts")[held].astype(np.int64), lengths[doc])
        return out @ queries.rows(self.term)[:, chosen]


class Best:
    """The k best (score, key) of each query, and the score below which nothing counts any more."""

    def __init__(self, n: int, k: int, least: dict[int, int]) -> None:
        self.k, self.found = k, [[] for _ in range(n)]
        self.least = np.array([max(1, least.get(q, 1)) for q in range(n)], np.int64)

    def add(self, query: int, scores: np.ndarray, keys: pa.Array) -> None:
        at = np.flatnonzero(scores >= self.least[query])
        if not len(at):
            return
        new = [(-int(s), key is None, 0 if key is None else key) for s, key in zip(scores[at].tolist(), keys.take(pa.array(at)).to_pylist(), strict=True)]
        self.found[query] = sorted(self.found[query] + new)[: self.k]
        if len(self.found[query]) == self.k:
            self.least[query] = max(self.least[query], -self.found[query][-1][0])


def score_blocks(batches: Iterator[pa.RecordBatch], queries: Queries, best: Best) -> None:
    """Each batch's blocks by falling bound of each query, until no bound reaches the query's threshold.

    The first block of each query is scored, then the next ROUND - 1 times as many as before, and so on; between rounds
    thresholds rise.  A block is scored once a round for all queries that have it in the round."""
    names = pa.array(queries.names, pa.binary())
    for batch in batches:
        blocks = [Block(batch, row, names) for row in range(batch.num_rows)]
        bounds = np.array([block.bounds(queries) for block in blocks])
        order = np.argsort(-bounds, axis=0, kind="stable")
        begin, end = 0, 1
        while begin < len(blocks):
            here = order[begin:end]
            alive = bounds[here, np.arange(queries.n)] >= best.least
            if not alive.any():
                break
            place, query = np.nonzero(alive)
            row = here[place, query]
            for one in np.unique(row).tolist():
                chosen = query[row == one]
                scores = blocks[one].scores(queries, chosen)
                for i in np.flatnonzero((scores >= best.least[chosen]).any(axis=0)).tolist():
                    best.add(int(chosen[i]), scores[:, i], blocks[one].keys())
            begin, end = end, end * ROUND


def _corpus_numbers(index: DataFrame, queries: Queries) -> tuple[int, int, dict[int, int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, total = pa.array(queries.names, pa.binary()), np.zeros(len(queries.names), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row, names)
                total[block.term] += block.numbers("term_docs")[block.at]
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(total[term])], names=["term", "df"])

    docs, terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    found = index.select("term_sizes", "term_bytes", "term_docs").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()
    return docs or 0, terms or 0, {r["term"]: r["df"] for r in found}


def _promising(index: DataFrame, queries: Queries) -> list[int]:
    """Numbers of the FIRST_BLOCKS blocks with the greatest bounds of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(queries.names, pa.binary())
        for batch in batches:
            bounds = np.array([Block(batch, row, names).bounds(queries) for row in range(batch.num_rows)])
            top = np.argsort(-bounds, axis=0, kind="stable")[:FIRST_BLOCKS]
            query = np.broadcast_to(np.arange(queries.n), top.shape)
            bound = bounds[top, query].astype(np.int64)
            held = bound > 0
            blocks = batch.column("block").to_numpy(zero_copy_only=False)[top]
            yield pa.RecordBatch.from_arrays([pa.array(query[held]), pa.array(blocks[held]), pa.array(bound[held])], names=["q", "block", "bound"])

    rows = index.select("block", "term_sizes", "term_bytes", "term_most", "term_least").mapInArrow(run, "q bigint, block bigint, bound bigint")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound"), "block"))
    return [r["block"] for r in rows.select("block", place.alias("place")).where(F.col("place") <= FIRST_BLOCKS).select("block").distinct().collect()]


def _top(index: DataFrame, queries: Queries, k: int, least: dict[int, int]) -> DataFrame:
    """(q, rank, key, score): the k best of the index's blocks for each query, none below least."""
    schema = T.StructType([T.StructField("q", T.LongType()), T.StructField("key", index.schema["keys"].dataType.elementType), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        best = Best(queries.n, k, least)
        score_blocks(batches, queries, best)
        rows = [(q, None if none else key, -score) for q, found in enumerate(best.found) for score, none, key in found]
        arrow = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("key")))
    return index.mapInArrow(run, schema).select("q", rank.alias("rank"), "key", "score").where(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """(key of queries, rank, key, score): the k documents of an index that score highest for each query.

    The index is what build_index() wrote, read again."""
    spark = index.sparkSession
    asked = queries.select(F.col(key).alias("item"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    count, size = asked.agg(F.count("*"), F.sum(F.length("text"))).first()
    groups = max(1, math.ceil(count / QUERIES_TOGETHER), math.ceil((size or 0) / QUERY_BYTES))
    parts = []
    for group in range(groups):
        rows = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == group).collect()
        held = Queries([bytes(r["text"]) for r in rows])
        if not held.names:
            continue
        docs, terms, frequency = _corpus_numbers(index, held)
        if not frequency:
            continue
        held.weigh(docs, terms, frequency)
        first = _top(index.where(F.col("block").isin(_promising(index, held))), held, k, {})
        least = {r["q"]: r["score"] for r in first.where(F.col("rank") == k).collect()}
        names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], T.StructType([T.StructField("q", T.LongType()), T.StructField(key, asked.schema["item"].dataType)]))
        parts.append(_top(index, held, k, least).join(F.broadcast(names), "q").select(key, "rank", "key", "score"))
    if not parts:
        empty = T.StructType([T.StructField(key, asked.schema["item"].dataType), T.StructField("rank", T.IntegerType()), T.StructField("key", index.schema["keys"].dataType.elementType), T.StructField("score", T.LongType())])
        return spark.createDataFrame([], empty)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(written(part, "found"))
    return out


def benchmark_ranks(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The columns of op12_ranked_search: an index of docs in the shared folder, searched for each item."""
    spark: SparkSession = docs.sparkSession
    path = shared_path(spark, "search-index")
    build_index(docs, path)
    return search(spark.read.parquet(path), items, k).withColumnRenamed("key", "doc_id")


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tfs AS (SELECT doc_id, term, count(*) AS tf FROM docs GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), corpus
), scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), corpus
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
