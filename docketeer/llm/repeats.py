"""Repeated passages in sequences of hashed units (words or lines), found from content-selected positions.

A passage is a run of at least `length` units.  Every window of `length` units has one selected position: the
leftmost minimum of the hashes of its `gram`-unit pieces.  Equal windows select the same piece, so a repeated window
always has a repeated seed, and only windows with one are hashed and compared.  Windows that share a seed are that
seed extended left and right to the full length in each possible way; equal neighbouring windows join to the maximal
repeated passages.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.llm.common import written

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(kind: str, n: int) -> np.ndarray:
    """The first n powers, modulo 2^64, of the base ("up") or of its inverse ("down")."""
    if len(_powers[kind]) < n:
        steps = np.full(max(n, 1024), _BASE if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:n]


def hash_words(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word (run of other than ASCII white space)."""
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1]))) if len(raw) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64)
    raw, space = raw[starts[0] :], space[starts[0] :]
    starts = starts - starts[0]
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    values = _BYTES[raw] * powers("up", int(place.max()) + 1)[place]
    values[space] = 0
    return mix(np.add.reduceat(values, starts))


def gram_hashes(units: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n units."""
    if len(units) < n:
        return np.zeros(0, np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(units * powers("up", len(units)), dtype=np.uint64)))
    return mix((sums[n:] - sums[:-n]) * powers("down", len(sums) - n))


def selected(units: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram hashes, and the selected position of each window of `length` units."""
    grams = gram_hashes(units, gram)
    width = length - gram + 1
    if len(grams) < width:
        return grams, np.zeros(0, np.int64)
    return grams, np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + np.arange(len(grams) - width + 1)


def repeated_seeds(seeds: DataFrame) -> DataFrame:
    """seeds (seed, doc_id, owner, pos) to the distinct seeds that occur at two places or more.

    Written, so that in a join with all seeds both sides are plain shuffles, of which Spark splits a hot seed's."""
    place = F.struct("doc_id", "owner", "pos")
    return written(seeds.groupBy("seed").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("seed"), "seeds")


def repeated_windows(windows: DataFrame) -> DataFrame:
    """windows (w, doc_id, rid, s) to (doc_id, rid, s, later) of those that occur twice or more; later: not the first,
    by doc_id, rid and s."""
    place = F.struct("doc_id", "rid", "s")
    known = written(windows.groupBy("w").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("w", "first"), "known")  # as for seeds
    return windows.join(known, "w").select("doc_id", "rid", "s", (place != F.col("first")).alias("later"))


def spans_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Sorted window starts to the spans that the windows cover together."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.concatenate(([0], breaks + 1))].tolist(), (starts[np.append(breaks, len(starts) - 1)] + length).tolist(), strict=True))
