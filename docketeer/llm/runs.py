"""Periodic runs of words: stretches that repeat one period four times or more, found by divide and conquer.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) that no neighbouring word
extends keeping that period, of max(6, 4 * q) words or more.  The method is Main's and Lorentz's: words become ids, a
text is halved again and again, and at each midpoint the repetitions that cross it are found.  A run that crosses a
midpoint has at least half its words on one side of it, so there the words equal those q places on for q places or
more: the side's Z-function is q or more at q.  Such places are extended both ways, and of runs with the same bounds
the smallest period stays.

The midpoints of one depth of all texts of a slice are looked at together: Z-values of the first SCREEN words by numpy
for every q, the few that go on one by one, or by the linear Z-function where they are many.  So the work is n log n.

Defined results: null and empty texts have no words and no runs; a text of any length is looked at whole; rows with
equal or null keys are looked at each for itself; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A run has so many words at least, and repeats its period so many times.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Words compared for all periods at once.
SCREEN = 8
#: Periods left at one midpoint from which the linear Z-function is used in place of direct comparison.
MANY = 32
#: Bytes of text that are looked at together (one text may have more).
SLICE_BYTES = 2_000_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def z_function(words: list) -> list[int]:
    """Length of the longest common prefix of the list and of the list from each place on."""
    n = len(words)
    z, left, right = [n] + [0] * max(0, n - 1), 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z[:n]


def equal_for(ids: np.ndarray, a: int, b: int) -> int:
    """How many words from a on equal those from b on, where a < b and an own separator ends each text."""
    done, step = 0, 32
    while True:
        x, y = ids[a + done : a + done + step], ids[b + done : b + done + step]
        differ = x[: len(y)] != y
        if differ.any():
            return done + int(differ.argmax())
        if len(y) < step:
            return done + len(y)
        done, step = done + step, step * 4


def crossing(ids: np.ndarray, mids: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(mid, q, z) of each period q up to half of what a midpoint reaches on its right whose Z-value there is q or more.

    Periods whose first two occurrences lie inside a run found at the midpoint before are multiples of that run's."""
    most = np.where(reach > 1, reach // 2, 0)
    total = int(most.sum())
    mid = np.repeat(mids, most)
    q = np.arange(1, total + 1) - np.repeat(np.cumsum(most) - most, most)
    need = np.maximum(q, LEAST_WORDS // 2 - q)
    for k in range(SCREEN):
        keep = (ids[mid + k] == ids[mid + q + k]) | (k >= need)
        mid, q, need = mid[keep], q[keep], need[keep]
    if not len(mid):
        return
    first = np.flatnonzero(np.concatenate(([True], mid[1:] != mid[:-1]))).tolist()
    for at, end in zip(first, [*first[1:], len(mid)], strict=True):
        here, covered, z = int(mid[at]), 0, None
        for period, least in zip(q[at:end].tolist(), need[at:end].tolist(), strict=True):
            if 2 * period <= covered:
                continue
            if end - at > MANY:
                if z is None:
                    z = z_function(ids[here : here + 2 * int(q[end - 1]) + SCREEN].tolist())
                if z[period] < least:
                    continue
            found = equal_for(ids, here, here + period)
            if found >= least:
                covered = period + found
                yield here, period, found


def find_runs(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each run of each text, by start, then period.  A text is a list of words."""
    lengths = [len(t) for t in texts]
    number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    size = sum(lengths) + len(texts) + 1
    starts = np.array(list(accumulate((n + 1 for n in lengths), initial=1)), np.int64)
    # text i lies from starts[i] on, between separators that equal nothing else
    ids = np.empty(size + 2 * SCREEN, np.int64)
    ids[: 2 * SCREEN] = -1
    inside = np.ones(size, bool)
    inside[starts - 1] = False
    body = ids[SCREEN : SCREEN + size]
    body[inside] = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, size - len(texts) - 1)
    body[~inside] = -2 - np.arange(len(texts) + 1)
    ids[:SCREEN], ids[SCREEN + size :] = -1, -1
    back = ids[::-1].copy()
    last = len(ids)
    lo, hi = starts[:-1] + SCREEN, starts[1:] - 1 + SCREEN
    found: dict[tuple[int, int], int] = {}

    def add(start: int, end: int, period: int) -> None:
        if end - start >= max(LEAST_WORDS, LEAST_TIMES * period):
            found[start, end] = min(period, found.get((start, end), period))

    while True:
        wide = hi - lo >= LEAST_WORDS
        lo, hi = lo[wide], hi[wide]
        if not len(lo):
            break
        mids = (lo + hi) // 2
        for mid, period, right in crossing(ids, mids, hi - mids):
            left = equal_for(back, last - mid - period, last - mid)
            add(mid - left, mid + period + right, period)
        for mid, period, left in crossing(back, last - mids, mids - lo):
            mid = last - mid
            right = equal_for(ids, mid - period, mid)
            add(mid - period - left, mid + right, period)
        lo, hi = np.concatenate((lo, mids)), np.concatenate((mids, hi))

    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if found:
        rows = sorted((start, period, end) for (start, end), period in found.items())
        owners = np.searchsorted(starts, np.array([r[0] - SCREEN for r in rows]), "right") - 1
        for owner, (start, period, end) in zip(owners.tolist(), rows, strict=True):
            out[owner].append((start - SCREEN - int(starts[owner]), end - start, period))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


def mark_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, runs (RUNS) and collapsed: the text's words without repeated periods, joined by one space.

    Words are stretches without ASCII white space."""
    source = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    schema = T.StructType([source.schema[0], T.StructField("n_words", T.LongType()), *T.StructType.fromDDL(f"runs {RUNS}, collapsed binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            offsets = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(offsets)) + 1).tolist(), batch.num_rows]
            for at, end in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(at, end - at)
                texts = [t.split() for t in part.column(1).to_pylist()]  # bytes split at ASCII white space alone
                runs = find_runs(texts)
                flat = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
                values = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(arrow.field(2).type.value_type))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(rs) for rs in runs]))), pa.int32()), values, type=arrow.field(2).type)
                collapsed = pa.array([b" ".join(collapse(*x)) for x in zip(texts, runs, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), lists, collapsed], schema=arrow)

    return source.mapInArrow(run, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period (ties: the smallest start, then period); null where there is none.

    Runs come by start, then period, so that only a greater one takes the place of an earlier one."""
    return F.aggregate(
        runs,
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best),
    )


def repeated_tail(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs' key and text; where h = crc32(key as text) ends in 0, words from a on repeat the p words there.

    With g = h div 10 and n words, a = g mod n and p = 1 + (n - a) div (3 + g mod 8).  A null key counts as empty."""
    h = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.when(h % 10 == 0, F.array_remove(F.split(whole, r"[\x20\x09-\x0D]+", -1), ""))
    rows = docs.select(F.col(key), whole.alias("text"), words.alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words").cast("long")
    a = F.pmod("g", n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod("g", F.lit(8))))
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", (a + 1).cast("int"), p.cast("int")), times)), F.lit(1), (n - a).cast("int"))
    changed = F.concat_ws(" ", F.slice("words", F.lit(1), a.cast("int")), tail)
    return rows.select(key, F.when(F.col("words").isNotNull() & (n > 0), changed).otherwise(F.col("text")).alias("text"))


def document_runs(docs: DataFrame) -> DataFrame:
    """The columns of op11_periodic_runs: the digests of each document's runs and of its collapsed text."""
    found = mark_runs(repeated_tail(docs)).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
