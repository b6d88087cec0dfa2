"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

The vocabulary is a public SentencePiece model file; only its pieces, kinds and scores are read from it.  Where the
scores are merge ranks (-1, -2, ...) rather than log probabilities, a piece of rank r gets the Zipf log probability
log(1 / (r + 2.7)) less the normaliser, which keeps the order of the ranks.

Text is marked as SentencePiece does it: one leading space is added and every space becomes the marker U+2581.  The
best segmentation maximises the summed scores; of equal sums the one whose last piece starts earliest wins.  A
character without a piece becomes its UTF-8 bytes as byte pieces; a marker character that is in the text itself also
does, so that decoding restores every text exactly.

No piece has a marker after another character, so pieces never cross the start of a word.  Texts are therefore cut
into words with the spaces before them, where the vocabulary allows it also between letters and punctuation; each
distinct word is segmented once while a worker remembers it (remembered words are bounded), and all new words of a
batch go through the trie together in numpy.  Decoding gathers the pieces of a batch in one Arrow take.

Defined results: null or empty text gives no ids and decodes to the empty text; decoding null gives the empty text;
rows with equal or null doc_id are coded each for itself.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketeer.llm.common import slices

MARK = "▁"
#: Stands for a marker character of the text itself while words are cut: it has no piece and so becomes bytes.
LITERAL = b"\xff"
WORDS = re.compile(r" *[^ ]+| +")
#: ASCII marks and controls; words cut between these and all else, which holds for texts of ASCII and Latin letters.
_MARKS, _LATIN = r"\x00-\x1f!-/:-@\[-`{-\x7f", "0-9A-Za-z\u00c0-\u024f"
FINE_WORDS, MIXED, OTHER = re.compile(f" *(?:[{_MARKS}]+|[^ {_MARKS}]+)| +"), re.compile(f"[{_MARKS}][{_LATIN}]|[{_LATIN}][{_MARKS}]"), re.compile(f"[^\x00-\x7f\u00c0-\u024f]")
#: Words that a worker remembers for good, those that it remembers until there are too many of them, and bytes up to
#: which words go through the trie together.
WORDS_KEPT, WORDS_PASSING, TOGETHER = 400_000, 200_000, 64
#: What an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0


@dataclass
class Trie:
    """Double array over the bytes of the pieces.  A node's child by byte c is base[node] + c if check[] of it is node."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray  # id of the piece that ends at the node, or -1


@dataclass
class Vocabulary:
    trie: Trie
    score: np.ndarray
    byte_ids: np.ndarray
    unknown: float
    text: list[bytes]  # of each id, markers as spaces; b"" for control pieces
    fine: bool  # whether no piece has both ASCII marks and Latin letters side by side


def build_trie(keys: list[tuple[bytes, int]]) -> Trie:
    """keys: byte strings and their ids, distinct.  Nodes are placed breadth first: an only child goes to the first free
    slot, several children to the first base, from that of the last such node on, where all their slots are free."""
    keys = sorted(keys)
    size = 1 << 20
    base, check, piece = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    taken = bytearray(size)
    taken[0] = 1
    queue, first_free, hint = [(0, 0, len(keys), 0)], 257, 257
    for node, low, high, depth in queue:
        if len(keys[low][0]) == depth:
            piece[node] = keys[low][1]
            low += 1
        groups, at = [], low
        while at < high:
            label, start = keys[at][0][depth], at
            while at < high and keys[at][0][depth] == label:
                at += 1
            groups.append((label, start, at))
        if not groups:
            continue
        while taken[first_free]:
            first_free += 1
        if len(groups) == 1:
            where = first_free - groups[0][0]
        else:
            where = hint = max(hint, first_free - groups[0][0])
            while any(taken[where + g[0]] for g in groups):
                where += 1
            hint = where if len(groups) < 8 else hint
        if where + 512 > size:
            size *= 2
            taken.extend(bytes(size - len(taken)))
            base, check, piece = np.resize(base, size), np.append(check, np.full(size - len(check), -1)), np.append(piece, np.full(size - len(piece), -1))
        base[node] = where
        for label, start, end in groups:
            child = where + label
            taken[child] = 1
            check[child] = node
            queue.append((child, start, end, depth + 1))
    used = max(q[0] for q in queue) + 257
    return Trie(base[:used].astype(np.int32), check[:used].astype(np.int32), piece[:used].astype(np.int32))


def load_vocabulary(model_path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
    as_byte = [model.is_byte(i) for i in range(n)]
    normal = [i for i in range(n) if not special[i] and not as_byte[i]]
    raw = np.array([model.get_score(i) for i in range(n)])
    if len(normal) > 1 and np.all(raw[normal] == np.round(raw[normal])):  # merge ranks
        weight = 1.0 / (-raw[normal] + 2.7)
        score = np.full(n, -np.inf)
        score[normal] = np.log(weight / weight.sum())
    else:
        score = raw.astype(float)
    bad = [names[i] for i in normal if re.search(f"[^{MARK}]{MARK}", names[i])]
    if bad:
        raise ValueError(f"pieces cross the start of a word: {bad[:3]}")
    byte_ids = np.full(256, -1, np.int32)
    for i in np.flatnonzero(as_byte):
        byte_ids[int(names[i][3:5], 16)] = i
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary lacks byte pieces")
    text = [bytes([int(names[i][3:5], 16)]) if as_byte[i] else b"" if special[i] else names[i].replace(MARK, " ").encode() for i in range(n)]
    trie = build_trie([(text[i], i) for i in normal])
    fine = not any(MIXED.search(names[i]) for i in normal)
    return Vocabulary(trie, score, byte_ids, float(score[normal].min() - UNKNOWN_PENALTY), text, fine)


def _char_length(lead: np.ndarray) -> np.ndarray:
    """Bytes of the character that starts with lead; LITERAL and stray bytes count as one."""
    return np.where(lead < 0xC0, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, np.where(lead < 0xF8, 4, 1))))


def segment_one(word: bytes, v: Vocabulary) -> list[int]:
    """Viterbi for one word, piece by piece: for long words, and the model for segment_packed()."""
    n, base, check, piece = len(word), v.trie.base, v.trie.check, v.trie.piece
    best, back = [-np.inf] * (n + 1), [(-1, -1)] * (n + 1)
    best[0] = 0.0
    start = 0
    while start < n:
        length = min(int(_char_length(np.array([word[start]]))[0]), n - start)
        node, at, single = 0, start, False
        while at < n:
            child = int(base[node]) + word[at]
            if base[node] == 0 or child >= len(check) or check[child] != node:
                break
            node, at = child, at + 1
            if piece[node] >= 0:
                single = single or at - start == length
                total = best[start] + v.score[piece[node]]
                if total > best[at]:
                    best[at], back[at] = total, (start, int(piece[node]))
        if not single and best[start] + v.unknown > best[start + length]:
            best[start + length], back[start + length] = best[start] + v.unknown, (start, -1)
        start += length
    ids, at = [], n
    while at:
        start, i = back[at]
        ids.append([i] if i >= 0 else _bytes_of(word[start:at], v))
        at = start
    return [i for part in reversed(ids) for i in part]


def _bytes_of(char: bytes, v: Vocabulary) -> list[int]:
    return [int(v.byte_ids[b]) for b in (MARK.encode() if char == LITERAL else char)]


def segment_packed(words: list[bytes], v: Vocabulary) -> list[bytes]:
    """Viterbi for many short words at once: one row per word, all rows advance byte by byte together.  Ids as int32."""
    if not words:
        return []
    lengths = np.array([len(w) for w in words])
    n, top = len(words), int(lengths.max())
    grid = np.zeros((n, top + 4), np.int64)
    flat = np.frombuffer(b"".join(words), np.uint8)
    rows = np.repeat(np.arange(n), lengths)
    grid[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    base, check, piece = v.trie.base, v.trie.check, v.trie.piece
    best = np.full((n, top + 5), -np.inf)
    best[:, 0] = 0.0
    back_at, back_id = np.zeros((n, top + 5), np.int32), np.full((n, top + 5), -1, np.int32)

    def offer(who: np.ndarray, start: int, end: np.ndarray | int, gain: np.ndarray | float, ids: np.ndarray | int) -> None:
        total = best[who, start] + gain
        better = total > best[who, end]
        who = who[better]
        end, ids = (x[better] if isinstance(x, np.ndarray) else x for x in (end, ids))
        best[who, end], back_at[who, end], back_id[who, end] = total[better], start, ids

    for start in range(top):
        who = np.flatnonzero((lengths > start) & (best[:, start] > -np.inf))
        if not len(who):
            continue
        char = np.minimum(_char_length(grid[who, start]), lengths[who] - start)
        single = np.zeros(len(who), bool)
        alive, node, at = np.arange(len(who)), np.zeros(len(who), np.int64), start
        while len(alive):
            inside = lengths[who[alive]] > at
            alive, node = alive[inside], node[inside]
            step = base[node]
            child = np.minimum(step + grid[who[alive], at], len(check) - 1)
            found = (step > 0) & (check[child] == node)
            alive, node, at = alive[found], child[found], at + 1
            ends = piece[node] >= 0
            if ends.any():
                single[alive[ends]] |= char[alive[ends]] == at - start
                ids = piece[node[ends]]
                offer(who[alive[ends]], start, at, v.score[ids], ids)
        lone = ~single
        if lone.any():
            offer(who[lone], start, start + char[lone], v.unknown, -1)
    row, begin, end, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    who, at = np.arange(n)[lengths > 0], lengths[lengths > 0]
    while len(who):
        start = back_at[who, at]
        for held, now in ((row, who), (begin, start), (end, at), (ids, back_id[who, at])):
            held.append(now)
        who, at = who[start > 0], start[start > 0]
    row, begin, end, ids = (np.concatenate(x).astype(np.int64) for x in (row, begin, end, ids))
    order = np.lexsort((begin, row))
    data, ends = ids[order].astype("<i4").tobytes(), (4 * np.cumsum(np.bincount(row, minlength=n))).tolist()
    out = [data[a:b] for a, b in zip([0, *ends], ends)]
    unknown = np.unique(row[ids < 0])
    inside = order[np.isin(row[order], unknown)]
    spelled: dict[int, list[int]] = {w: [] for w in unknown.tolist()}
    for w, a, b, i in zip(row[inside].tolist(), begin[inside].tolist(), end[inside].tolist(), ids[inside].tolist()):
        spelled[w] += [i] if i >= 0 else _bytes_of(words[w][a:b], v)
    for w, found in spelled.items():
        out[w] = array("i", found).tobytes()
    return out


def segment_many(words: list[bytes], v: Vocabulary) -> list[list[int]]:
    return [array("i", packed).tolist() for packed in segment_packed(words, v)]


class Encoder:
    """Ids of texts, with the words seen so far."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v, self.known = vocabulary, {}
        self.passing: list[str] = []

    def _words(self, text: str) -> list[str]:
        if not text:
            return []
        fine = self.v.fine and (text.isascii() or not OTHER.search(text))
        return (FINE_WORDS if fine else WORDS).findall(" " + text)

    def _learn(self, new: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass").replace(MARK.encode(), LITERAL) for w in new]
        lengths = np.array([len(r) for r in raw], np.int64)
        order = np.argsort(lengths, kind="stable").tolist()
        short = order[: int((lengths <= TOGETHER).sum())]
        for at in range(0, len(short), 20_000):
            part = short[at : at + 20_000]
            self.known.update(zip(map(new.__getitem__, part), segment_packed([raw[i] for i in part], self.v)))
        for i in order[len(short):]:
            self.known[new[i]] = array("i", segment_one(raw[i], self.v)).tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian int32."""
        cut = [self._words(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.passing) + len(new) > WORDS_PASSING:  # words seen early are the frequent ones, and stay
            for word in self.passing:
                del self.known[word]
            self.passing = []
            new = set().union(*cut).difference(self.known)
        if len(self.known) - len(self.passing) >= WORDS_KEPT:
            self.passing += new
        self._learn(list(new))
        return [b"".join(map(self.known.__getitem__, words)) for words in cut]


_encoders: dict[str, Encoder] = {}


def process_encoder(model_path: str, vocabulary: Vocabulary) -> Encoder:
    """The encoder of this worker process, which later tasks use again."""
    if model_path not in _encoders:
        _encoders.clear()
        _encoders[model_path] = Encoder(vocabulary)
    return _encoders[model_path]


def decode_ids(ids: list[int], v: Vocabulary) -> str:
    """The text of one list of ids."""
    return decode_lists(pa.array([ids], pa.list_(pa.int32())), piece_table(v))[0]


def decode_lists(lists: pa.ListArray, table: pa.Array) -> list[str]:
    """The text of each list of ids: pieces joined, markers as spaces, bytes put together, the added space taken off.

    table holds the pieces by id; a null list gives the empty text."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    joined = table.take(lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])))
    places = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data, at = memoryview(joined.buffers()[2] or b""), places[offsets - offsets[0]].tolist()
    texts = (bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(at, at[1:]))
    return [t[1:] if t.startswith(" ") else t for t in texts]


def piece_table(v: Vocabulary) -> pa.Array:
    return pa.array(v.text, pa.large_binary())


#: Rows decoded together: bounds what a worker holds of their pieces.
ROWS_DECODED = 200


def _mapped(df: DataFrame, extra: str, keep: list[str], fields: list[T.StructField], model_path: str, make) -> DataFrame:
    """keep columns of df, then fields, which make(vocabulary, column of extra) gives as Arrow arrays for a slice of rows."""
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(model_path))
    source = df.select(*keep, F.col(extra).alias("__in"))
    schema = T.StructType(df.select(*keep).schema.fields + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in slices(batches):
            kept = [c.cast(f.type) for c, f in zip(batch.columns[: len(keep)], arrow)]
            made = [c.cast(f.type) for c, f in zip(make(shared.value, batch.column(len(keep))), list(arrow)[len(keep):], strict=True)]
            yield pa.RecordBatch.from_arrays([*kept, *made], schema=arrow)

    return source.mapInArrow(run, schema)


def _ids(model_path: str, v: Vocabulary, texts: pa.Array) -> pa.ListArray:
    rows = process_encoder(model_path, v).ids([t or "" for t in texts.to_pylist()])
    offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))


def _texts(v: Vocabulary, lists: pa.ListArray) -> pa.Array:
    table, texts = piece_table(v), []
    for at in range(0, len(lists), ROWS_DECODED):
        texts += decode_lists(lists.slice(at, ROWS_DECODED), table)
    return pa.array(texts, pa.string())


def _ids_field(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.IntegerType(), False))


def encode(df: DataFrame, model_path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """df with the ids of its text column added (an earlier column of that name goes)."""
    source = df.withColumn(text, F.col(text).cast("string")) if dict(df.dtypes)[text] != "string" else df
    return _mapped(source, text, [c for c in df.columns if c != out], [_ids_field(out)], model_path, lambda v, texts: [_ids(model_path, v, texts)])


def decode(df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the text of its ids column added (an earlier column of that name goes)."""
    return _mapped(df, ids, [c for c in df.columns if c != out], [T.StructField(out, T.StringType())], model_path, lambda v, lists: [_texts(v, lists)])


def recode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the ids of its text column and the text decoded from these ids added, in one pass over the rows."""

    def make(v: Vocabulary, texts: pa.Array) -> list[pa.Array]:
        lists = _ids(model_path, v, texts)
        return [lists, _texts(v, lists)]

    return _mapped(df, text, [c for c in df.columns if c not in (ids, out)], [_ids_field(ids), T.StructField(out, T.StringType())], model_path, make)


def document_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids, the digest of the decoded text and whether it is the text: the columns of op6."""
    coded = recode(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), model_path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.col("text")).alias("round_trip"))
