"""SimHash near-dedup by anchor-point covering.

Fingerprints: A-Z lower-cased, words, 4-word shingles with repeats, XXH64 (seed 42) of each; a bit is set if it is
set in over half the hashes.

Candidates: two 64-bit fingerprints that differ in at most 4 bits differ in at most 2 bits of one of two 31-bit
halves (bits 0-30 and 31-61).  The anchors of a half are the 2^26 words of the perfect [31,26] Hamming code, whose
covering radius is 1.  For halves at distance 2 or less there is a word within 1 of both, and an anchor within 1 of
that: so both lie within radius + threshold / 2 = 2 of a common anchor, and it is enough to copy a fingerprint to the
anchors within 2 of it (15 or 16 a half), against those of radius + threshold on one side only.  Fingerprints that
meet at an anchor are compared in whole.

Only distinct fingerprints are compared.  A bucket passes on a spanning forest of its links, which keeps what is
reachable, never all pairs.  Buckets over BUCKET fingerprints are cut in parts by hash and every two parts meet in a
task of their own, so no task holds more than BUCKET of them, and none is left out.

Defined results: null text is empty; a text without words has fingerprint zero; fewer than 4 words make one shingle.
Rows with equal doc_id are kept, each with the component of its fingerprint; a null doc_id names no component unless all
of its group are null.  keep_one leaves one row of each component:
a null doc_id comes last, of equal ones the smaller hash of the text comes first, and rows equal in both count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docketeer.llm.common import map_text, written
from docketeer.llm.components import components

SHINGLE, THRESHOLD, SEED = 4, 4, 42
HALF_BITS, HALF_STARTS = 31, (0, 31)
#: Fingerprints that one task compares at most.
BUCKET = 4096
#: Runs up to this length are compared pair by pair.
SHORT_RUN = 8
#: Shingles whose hashes are held at once.
CHUNK = 1 << 16


def fingerprint(text: str) -> int:
    """The fingerprint as a signed 64-bit integer."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - SHINGLE + 1)
    starts, ends = starts[:last].tolist(), ends[min(SHINGLE, len(words)) - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, last, CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > last, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep columns plus fp long."""
    return map_text(docs, keep, text, "fp long", lambda texts: [[fingerprint(t) for t in texts]])


# --- anchors --------------------------------------------------------------------------------------------------------


def syndromes(values: np.ndarray) -> np.ndarray:
    """Hamming syndrome of each 31-bit value: the XOR of the numbers (from 1) of its set bits."""
    out = np.zeros(len(values), np.int64)
    for bit in range(HALF_BITS):
        out ^= np.where((values >> bit) & 1, bit + 1, 0)
    return out


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All code words within distance 2 of each 31-bit value: (row numbers, code words).

    Flipping one bit reaches the code word numbered by the syndrome; flipping two bits reaches one for each pair of
    numbers whose XOR is the syndrome.  A value that is a code word itself has no other within 2.
    """
    s = syndromes(values)
    rows, words = [], []

    def add(which: np.ndarray, flips: np.ndarray) -> None:
        rows.append(np.flatnonzero(which))
        words.append(values[which] ^ flips[which])

    add(s == 0, np.zeros(len(values), np.int64))
    one = np.left_shift(1, np.maximum(s - 1, 0))
    add(s > 0, one)
    for i in range(1, HALF_BITS + 1):
        j = s ^ i
        add((s > 0) & (j > i), (1 << (i - 1)) | np.left_shift(1, np.maximum(j - 1, 0)))
    return np.concatenate(rows), np.concatenate(words)


def _replicate(fps: DataFrame) -> DataFrame:
    """fp to (anchor long, fp): anchor is the code word with the half's number above it."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for number, start in enumerate(HALF_STARTS):
                rows, words = anchors((fp >> start) & ((1 << HALF_BITS) - 1))
                yield pa.RecordBatch.from_arrays([pa.array(words | (number << HALF_BITS)), pa.array(fp[rows])], names=["anchor", "fp"])

    return fps.mapInArrow(run, schema)


def spanning_links(fp: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the links between distinct fingerprints: breadth first, one row of distances at a time."""
    bits = fp.astype(np.int64).view(np.uint64)
    left, found = np.arange(len(bits)), []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(bits[left] ^ bits[x]) <= threshold
            new = left[near].tolist()
            found += [(int(fp[x]), int(fp[y])) for y in new]
            queue += new
            left = left[~near]
    return found


def _links_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal (anchor, p, q).  Short runs are compared together, each row with the next, the next
    but one and so on; longer runs pass on a spanning forest."""
    held: list[np.ndarray] = []

    def found(anchor: np.ndarray, p: np.ndarray, q: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        edges = np.flatnonzero((anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1
        run = np.zeros(len(fp), np.int64)
        run[edges] = 1
        run = np.cumsum(run)
        sizes = np.bincount(run)
        bits, small, a, b = fp.view(np.uint64), sizes[run] <= SHORT_RUN, [], []
        for shift in range(1, min(SHORT_RUN, len(fp))):
            near = (run[shift:] == run[:-shift]) & small[shift:]
            near[near] = np.bitwise_count(bits[shift:][near] ^ bits[:-shift][near]) <= THRESHOLD
            a.append(fp[:-shift][near])
            b.append(fp[shift:][near])
        starts = np.concatenate(([0], edges))
        for r in np.flatnonzero(sizes > SHORT_RUN):
            pairs = spanning_links(fp[starts[r] : starts[r] + sizes[r]])
            a.append(np.array([x for x, _ in pairs], np.int64))
            b.append(np.array([y for _, y in pairs], np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) if x else pa.array([], pa.int64()) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        now = [np.concatenate(x) for x in zip(held, now, strict=True)] if held else now
        last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]) | (now[2] != now[2][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0  # the last run may go on
        held = [x[cut:] for x in now]
        if cut:
            yield found(*(x[:cut] for x in now))
    if held:
        yield found(*held)


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """fps (fp, distinct) to links (a, b) that reach the same fingerprints as all pairs within the threshold do."""
    placed = written(_replicate(fps.select("fp")), "anchors")
    sizes = written(placed.groupBy("anchor").count().where("count > 1"), "sizes")  # so that Spark can split a hot anchor
    parts = F.when(F.col("count") <= bucket, 1).otherwise(F.ceil(2 * F.col("count") / bucket)).cast("int")
    met = placed.join(sizes.select("anchor", parts.alias("parts")), "anchor")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("own")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tasks = met.select("anchor", "fp", own, "parts").select("anchor", "fp", "own", other)
    tasks = tasks.select("anchor", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp")
    ordered = tasks.repartition("anchor", "p", "q").sortWithinPartitions("anchor", "p", "q")
    return ordered.mapInArrow(_links_of_sorted, "a long, b long").distinct()


def _linked(fps: DataFrame) -> DataFrame:
    """fps (fp, distinct, and more) plus component: the smallest fingerprint reachable."""
    joined = components(links(fps.select("fp")))
    return fps.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def fingerprint_components(fps: DataFrame) -> DataFrame:
    """fps (fp, low: smallest doc_id) to (fp, component_id): the smallest doc_id reachable.

    Both sides of the join are written first: only where both are plain shuffles does Spark split a large component."""
    linked = written(_linked(fps), "linked")
    least = written(linked.groupBy("component").agg(F.min("low").alias("component_id")), "least")
    return linked.join(least, "component").select("fp", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, fp and component_id of every row of docs."""
    prints = written(fingerprints(docs, [key], text), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min(key).alias("low"))
    found = written(fingerprint_components(distinct), "classes")  # one row a fingerprint, as a fingerprint may have many copies
    return prints.join(found, "fp").select(key, "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def document_components(docs: DataFrame) -> DataFrame:
    """The columns of op10_simhash."""
    return near_duplicates(docs).select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs of each component: that with the smallest row key."""
    key = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h"))
    prints = fingerprints(docs.select(key.alias("__key"), "text"), ["__key"])
    distinct = written(prints.groupBy("fp").agg(F.min("__key").alias("low")), "fingerprints")
    chosen = _linked(distinct).groupBy("component").agg(F.min("low").alias("__key")).select("__key")  # structs compare null-safe
    kept = docs.withColumn("__key", key).join(written(chosen, "chosen"), "__key")
    one = Window.partitionBy("__key").orderBy(F.xxhash64(*docs.columns))  # rows equal in doc_id and text
    return kept.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(docs.columns)
