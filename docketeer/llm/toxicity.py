"""Toxicity by compression distance: a zstandard dictionary of toxic and one of ordinary text, and calibrated scores.

Both dictionaries are made the same way, each from windows of its own class of labelled documents: first the class's
key segments, the most frequent last, then content that zstandard trains on windows of both classes.  Key segments are
stretches of GRAM-byte pieces that are far more frequent in one class than in the other: by Dunning's log-likelihood
ratio (KEYNESS, beyond chance) and by odds (MIN_LOG_ODDS).  A piece's distinct contexts are counted, so that copies of
one document count once.  Pieces are bytes, not words, so that word stems count in any language.

A window is compressed with either dictionary alone, behind a preamble that both hold: the frame's fixed costs are
thus paid in both, and a single match shows.  The difference of the two lengths is turned into the window's log odds
(a table of how often toxic and ordinary documents have it); a logistic curve over their sum, mean and maximum gives a
document's probability.  Both are calibrated on labelled documents that the dictionaries have not seen.

Only labelled rows with crc32(doc_id as text) mod 4 other than 2 are learned from: at most MAX_DOCS of each label,
those with the smallest hash, leaving out texts over MAX_CHARS characters; the dictionaries see at most MAX_BYTES of
each class.  Scores use the text alone.

Defined results: null text is empty and gets the score of a text without matches; without labels of both classes all
scores are 0; documents without a label are scored like any other; a null doc_id is not held out; equal texts get
equal scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.llm.common import crc32_mod, map_text
from docketeer.llm.repeats import mix

#: Bounds of what learning may see: documents of a label, characters of a text, bytes of a class for the dictionaries.
MAX_DOCS, MAX_CHARS, MAX_BYTES = 2_000, 30_000, 8_000_000
#: Bytes of a window (with the preamble under the 64 from which zstandard squeezes literals), and how far the next starts.
WINDOW, STEP = 56, 48
#: Bytes of a piece and of its context on either side; what makes a piece a key piece.
GRAM, CONTEXT, KEYNESS, MIN_LOG_ODDS = 6, 4, 60.0, 2.0
#: Bytes of a dictionary's key segments and of its trained content.
KEY_BYTES, SHARED_BYTES = 4096, 1024
#: Bytes that no UTF-8 text holds, in every dictionary and before every window.
PREAMBLE = bytes(range(0xF8, 0x100)) * 3 + bytes(range(0xFF, 0xF7, -1))
#: Saved bytes are counted from -SPREAD to SPREAD.
SPREAD = 12
THRESHOLD, HELD_OUT = 0.3, 2


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def windows(text: str) -> list[bytes]:
    data = _bytes(text)
    return [data[i : i + WINDOW] for i in range(0, max(1, len(data) - (WINDOW - STEP)), STEP)]


# --- dictionaries ---------------------------------------------------------------------------------------------------


def _hashes(data: np.ndarray, start: int, length: int, n: int) -> np.ndarray:
    """A number for each of the n runs of `length` bytes from start on; distinct up to 7 bytes."""
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = (out << np.uint64(8)) + data[start + k : start + k + n]
    return out


def pieces_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The pieces at each place of the text, with a space at either end, and a hash of each with its context."""
    edge = b"\0" * CONTEXT
    data = np.frombuffer(b"".join([edge, b" ", _bytes(text), b" ", edge]), np.uint8).astype(np.uint64)
    n = max(0, len(data) - 2 * CONTEXT - GRAM + 1)
    piece = _hashes(data, CONTEXT, GRAM, n)
    around = (_hashes(data, 0, CONTEXT, n) << np.uint64(32)) + _hashes(data, CONTEXT + GRAM, CONTEXT, n)
    return piece, mix(piece) ^ mix(around + np.uint64(1))


def _contexts(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pieces of the texts and the number of each one's distinct contexts."""
    pieces, marks, held, size = np.zeros(0, np.uint64), np.zeros(0, np.uint64), [], 0

    def merge() -> tuple[np.ndarray, np.ndarray]:
        p, m = (np.concatenate([x, *(h[k] for h in held)]) for k, x in enumerate((pieces, marks)))
        m, first = np.unique(m, return_index=True)
        return p[first], m

    for text in texts:
        held.append(pieces_of(text))
        size += len(held[-1][0])
        if size > 1 << 20:
            (pieces, marks), held, size = merge(), [], 0
    return np.unique(merge()[0], return_counts=True)


def key_pieces(own: list[str], other: list[str]) -> np.ndarray:
    """The pieces that mark own against other, sorted."""
    (piece, n), (there, counts) = _contexts(own), _contexts(other)
    if not len(piece) or not len(there):
        return piece[:0]
    at = np.minimum(np.searchsorted(there, piece), len(there) - 1)
    o = np.where(there[at] == piece, counts[at], 0)
    all_n, all_o = n.sum(), counts.sum()
    share = (n + o) / (all_n + all_o)
    ratio = 2 * (n * np.log(n / (all_n * share)) + o * np.log(np.maximum(o, 1) / (all_o * share)))
    odds = np.log((n + 0.5) / all_n) - np.log((o + 0.5) / all_o)
    return piece[(ratio > KEYNESS) & (odds > MIN_LOG_ODDS)]


def key_segments(own: list[str], other: list[str], size: int = KEY_BYTES) -> bytes:
    """Stretches of own's key pieces, the most frequent last; each holds a piece that no more frequent one does."""
    keys, runs = key_pieces(own, other), Counter()
    if not len(keys):
        return b""
    for text in own:
        data, found = b" " + _bytes(text) + b" ", pieces_of(text)[0]
        key = keys[np.minimum(np.searchsorted(keys, found), len(keys) - 1)] == found
        edges = np.flatnonzero(np.diff(np.concatenate(([0], key.astype(np.int8), [0]))))
        runs.update(data[a : b + GRAM - 1] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
    chosen, seen, total = [], set(), 0
    for run, n in sorted(runs.items(), key=lambda x: (-x[1], x[0])):
        inside = {run[i : i + GRAM] for i in range(len(run) - GRAM + 1)}
        if n > 1 and total + len(run) <= size and inside - seen:
            chosen.append(run)
            seen |= inside
            total += len(run)
    return b"".join(reversed(chosen))


def trained_content(samples: list[bytes], size: int = SHARED_BYTES) -> bytes:
    """What zstandard trains on the samples, without its tables; of too few samples their distinct words."""
    import zstandard

    try:
        whole = zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return (b" " + b" ".join(sorted(set(b" ".join(samples).split()))) + b" ")[-size:]
    offsets = b"".join(x.to_bytes(4, "little") for x in (1, 4, 8))  # these end the tables
    return whole[whole.find(offsets) + len(offsets) :] if offsets in whole else whole


@dataclass
class Distance:
    """The two dictionaries, whole.  Compressors are made once a process."""

    toxic: bytes
    ordinary: bytes

    def _compressor(self, content: bytes):
        import zstandard as z

        params = z.ZstdCompressionParameters.from_level(6, source_size=WINDOW + len(PREAMBLE), dict_size=len(content), min_match=6, strategy=z.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)
        return z.ZstdCompressor(dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=params)

    def saved(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text's windows, how many bytes shorter the toxic dictionary makes them than the ordinary one."""
        toxic, ordinary = self._compressor(self.toxic).compress, self._compressor(self.ordinary).compress
        return [np.array([len(ordinary(w)) - len(toxic(w)) for w in (PREAMBLE + x for x in windows(t))]) for t in texts]


def dictionaries(toxic: list[str], ordinary: list[str]) -> Distance:
    shared = trained_content([w for t in [*toxic, *ordinary] for w in windows(t)]) + PREAMBLE
    return Distance(key_segments(toxic, ordinary) + shared, key_segments(ordinary, toxic) + shared)


# --- calibration ----------------------------------------------------------------------------------------------------


def _bin(saved: np.ndarray) -> np.ndarray:
    return np.clip(saved + SPREAD, 0, 2 * SPREAD)


def window_odds(saved: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log odds that a window is of a toxic document, by saved bytes."""
    counts = np.ones((2, 2 * SPREAD + 1))
    for s, label in zip(saved, y.tolist(), strict=True):
        counts[label] += np.bincount(_bin(s), minlength=counts.shape[1])
    shares = np.log(counts / counts.sum(1, keepdims=True))
    return shares[1] - shares[0]


def document_features(saved: list[np.ndarray], odds: np.ndarray) -> np.ndarray:
    """Of the windows' log odds: sum, mean scaled by the root of their number, maximum; and the log of their number."""
    found = [odds[_bin(s)] for s in saved]
    return np.array([[x.sum(), x.mean() * math.sqrt(len(x)), x.max(), math.log(len(x))] for x in found]).reshape(-1, 4)


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40, penalty: float = 0.1) -> np.ndarray:
    """Weights (constant first) of a logistic curve over the columns of x, by Newton's method."""
    rows, weights = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + penalty * np.eye(len(weights))
        weights += np.linalg.solve(curve, rows.T @ (y - p) - penalty * weights)
    return weights


@dataclass
class Model:
    distance: Distance | None
    odds: np.ndarray | None = None
    middle: np.ndarray | None = None  # mean and spread of the features, as fitted
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None

    def scores(self, texts: list[str]) -> list[float]:
        if self.distance is None or not texts:
            return [0.0] * len(texts)
        x = (document_features(self.distance.saved(texts), self.odds) - self.middle) / self.spread
        return (1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))).tolist()


def calibrated(distance: Distance, texts: list[str], y: np.ndarray) -> Model:
    saved = distance.saved(texts)
    odds = window_odds(saved, y)
    x = document_features(saved, odds)
    middle, spread = x.mean(0), x.std(0) + 1e-9
    return Model(distance, odds, middle, spread, fit_logistic((x - middle) / spread, y))


# --- documents ------------------------------------------------------------------------------------------------------


def training_texts(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = MAX_DOCS) -> DataFrame:
    """label, half and text of at most limit documents of each label."""
    known = labels.where(F.col(label).isin(0, 1) & (crc32_mod("doc_id", 4) != HELD_OUT)).groupBy("doc_id").agg(F.max(label).alias("label"))
    ranked = known.select("doc_id", "label", F.xxhash64("doc_id", F.lit(5)).alias("h"))
    few = [ranked.where(F.col("label") == k).orderBy("h", "doc_id").limit(limit) for k in (0, 1)]
    chosen = F.broadcast(few[0].union(few[1]))
    joined = docs.where(F.length("text") <= MAX_CHARS).select("doc_id", "text").join(chosen, "doc_id")
    # one row of each doc_id, chosen before the shuffle too, so that a doc_id of very many rows is few rows there
    first = joined.groupBy("doc_id").agg(F.min_by(F.struct("label", "h", "text"), F.sha2("text", 256)).alias("x")).select("x.*")
    return first.select("label", F.pmod("h", F.lit(2)).alias("half"), "text", "h")


def _bounded(texts: list[str], most: int = MAX_BYTES) -> list[str]:
    """The first texts that have at most `most` bytes together."""
    ends = np.cumsum([len(t.encode("utf-8", "surrogatepass")) for t in texts])
    return texts[: int(np.searchsorted(ends, most, "right"))]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = MAX_DOCS) -> Model:
    rows = sorted(map(tuple, training_texts(docs, labels, label, limit).collect()), key=lambda r: (r[3], r[2]))  # at most 2 * limit texts
    part = lambda half, k: [r[2] for r in rows if r[1] == half and r[0] == k]
    if not all(part(half, k) for half in (0, 1) for k in (0, 1)):
        return Model(None)
    other = [r for r in rows if r[1] == 1]
    return calibrated(dictionaries(_bounded(part(0, 1)), _bounded(part(0, 0))), [r[2] for r in other], np.array([r[0] for r in other]))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """keep columns (doc_id by default) plus score double."""
    return map_text(docs, ["doc_id"] if keep is None else keep, "text", "score double", lambda texts: [model.scores(texts)])


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of op5_toxicity."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (crc32_mod("doc_id", 4) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
