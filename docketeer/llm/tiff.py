"""Media columns: TIFF files in a binary column.

`encode` lays bytes out as 8-bit grey samples and writes them as TIFF; `pages` walks the image directories of any
binary column and emits one row per page; `features` reads all pages of each file back and computes a digest row.

Supported: both byte orders, strips and tiles, 8- and 16-bit samples, chunky samples, compression none (1), LZW (5),
deflate (8, 32946) and PackBits (32773), predictors none (1) and horizontal (2).

Defined results: a null or empty binary has no pages; a file that can't be read gives one row with page -1 and the
reason in `error`; a page that can't be decoded gives its row with null samples and the reason; rows with equal or null
doc_id are stored each for itself.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.llm.common import map_text, slices

NONE, LZW, DEFLATE, PACKBITS = 1, 5, 8, 32773
WIDTH, STRIP_ROWS, PAGE_ROWS, TILE = 192, 64, 4096, 64
#: Compression and predictor of a document's file: one of these by the payload's checksum, so that each meets payloads of
#: every size and kind.
KINDS = ((LZW, 2), (DEFLATE, 1), (LZW, 1), (DEFLATE, 2), (PACKBITS, 1))


# --- codecs ---------------------------------------------------------------------------------------------------------


def packbits_encode(data: bytes) -> bytes:
    if not data:
        return b""
    values = np.frombuffer(data, np.uint8)
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    lengths = np.diff(np.append(starts, len(values)))
    out, literal_from = bytearray(), 0

    def literals(upto: int) -> None:
        for at in range(literal_from, upto, 128):
            piece = data[at : min(at + 128, upto)]
            out.append(len(piece) - 1)
            out.extend(piece)

    for start, length in zip(starts[lengths >= 3].tolist(), lengths[lengths >= 3].tolist(), strict=True):
        literals(start)
        value, left = data[start : start + 1], length
        while left > 1:
            run = min(left, 128)
            out.append(257 - run)
            out += value
            left -= run
        literal_from = start + length - left
    literals(len(data))
    return bytes(out)


def packbits_decode(data: bytes) -> bytes:
    out, at, end = [], 0, len(data)
    while at < end:
        head = data[at]
        if head < 128:
            out.append(data[at + 1 : at + 2 + head])
            at += head + 2
        elif head > 128:
            out.append(data[at + 1 : at + 2] * (257 - head))
            at += 2
        else:
            at += 1
    return b"".join(out)


#: TIFF's LZW: most significant bit first; a clear code before the table is full; widths are raised one code early, so
#: that the n-th code after a clear code (from 0) has the bits of the number 258 + n, at most 12.
CLEAR, END, FIRST_FREE, LAST_FREE = 256, 257, 258, 4094


def _code_places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Widths of the first n codes after a clear code, and the bit at which each starts."""
    widths = np.minimum(12, np.frexp(np.arange(FIRST_FREE, FIRST_FREE + n, dtype=float))[1])
    return widths, np.cumsum(widths) - widths


def _written_bits(codes: list[int], widths: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.array(codes, ">u2").view(np.uint8)).reshape(-1, 16)
    return bits[np.arange(16) >= 16 - widths[:, None]]


def lzw_encode(data: bytes) -> bytes:
    """Codes are looked up by (code before, byte), so that no prefix is ever copied."""
    parts, codes, table, free, held = [_written_bits([CLEAR], np.array([9]))], [], {}, FIRST_FREE, -1
    known, emit = table.get, codes.append
    for value in data:
        if held < 0:
            held = value
            continue
        key = held << 8 | value
        code = known(key)
        if code is not None:
            held = code
            continue
        emit(held)
        table[key] = free
        free += 1
        held = value
        if free == LAST_FREE:
            emit(CLEAR)
            parts.append(_written_bits(codes, _code_places(len(codes))[0]))
            codes.clear()
            table.clear()
            free = FIRST_FREE
    if held >= 0:
        emit(held)
    emit(END)
    parts.append(_written_bits(codes, _code_places(len(codes))[0]))
    return np.packbits(np.concatenate(parts)).tobytes()


def _lzw_runs(data: bytes) -> Iterator[list[int]]:
    """The codes between clear codes, up to the end code or the end of the data."""
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.int64)
    at, size = 0, 8 * len(data)
    while at + 9 <= size:
        widths, places = _code_places((size - at) // 9)
        places = places + at
        inside = int(np.searchsorted(places + widths, size, "right"))
        widths, places = widths[:inside], places[:inside]
        byte = places >> 3
        word = raw[byte] << 24 | raw[byte + 1] << 16 | raw[byte + 2] << 8 | raw[byte + 3]
        codes = word >> (32 - (places & 7) - widths) & ((1 << widths) - 1)
        stops = np.flatnonzero((codes == CLEAR) | (codes == END))
        stop = int(stops[0]) if len(stops) else len(codes)
        yield codes[:stop].tolist()
        if stop == len(codes) or codes[stop] == END:
            return
        at = int(places[stop] + widths[stop])


_ROOTS = [bytes([i]) for i in range(256)] + [b"", b""]


def lzw_decode(data: bytes) -> bytes:
    out: list[bytes] = []
    for codes in _lzw_runs(data):
        table, held = _ROOTS.copy(), b""
        for code in codes:
            if code < len(table):
                entry = table[code]
            elif code == len(table) and held:
                entry = held + held[:1]
            else:
                raise ValueError("LZW code beyond the table")
            out.append(entry)
            if held and len(table) < 4096:
                table.append(held + entry[:1])
            held = entry
    return b"".join(out)


def _compress(data: bytes, how: int) -> bytes:
    return {NONE: bytes, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 6), PACKBITS: packbits_encode}[how](data)


def _expand(data: bytes, how: int) -> bytes:
    if how == NONE:
        return data
    if how == LZW:
        return lzw_decode(data)
    if how in (DEFLATE, 32946):
        return zlib.decompress(data)
    if how == PACKBITS:
        return packbits_decode(data)
    raise ValueError(f"compression {how} is not supported")


# --- files ----------------------------------------------------------------------------------------------------------


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, tiled: bool = False, order: str = "<") -> bytes:
    """A TIFF of 8-bit grey pages (rows x width arrays)."""
    body, last = bytearray((b"II*\0" if order == "<" else b"MM\0*") + b"\0\0\0\0"), 4
    for page in pages:
        rows, width = page.shape
        if tiled:
            tall, wide = -(-rows // TILE) * TILE, -(-width // TILE) * TILE
            padded = np.zeros((tall, wide), np.uint8)
            padded[:rows, :width] = page
            blocks = [padded[y : y + TILE, x : x + TILE] for y in range(0, tall, TILE) for x in range(0, wide, TILE)]
        else:
            blocks = [page[y : y + STRIP_ROWS] for y in range(0, rows, STRIP_ROWS)]
        offsets, sizes = [], []
        for block in blocks:
            if predictor == 2:
                block = np.concatenate([block[:, :1], block[:, 1:] - block[:, :-1]], axis=1)
            data = _compress(block.tobytes(), compression)
            offsets.append(len(body))
            sizes.append(len(data))
            body += data + b"\0" * (len(data) % 2)

        def array(values: list[int]) -> int:
            if len(values) == 1:
                return values[0]
            at = len(body)
            body.extend(struct.pack(f"{order}{len(values)}I", *values))
            return at

        where, how_long = array(offsets), array(sizes)
        layout = [(322, 4, 1, TILE), (323, 4, 1, TILE), (324, 4, len(blocks), where), (325, 4, len(blocks), how_long)] if tiled else [(273, 4, len(blocks), where), (278, 4, 1, STRIP_ROWS), (279, 4, len(blocks), how_long)]
        tags = sorted([(256, 4, 1, width), (257, 4, 1, rows), (258, 3, 1, 8), (259, 3, 1, compression), (262, 3, 1, 1), (277, 3, 1, 1), (317, 3, 1, predictor), *layout])
        struct.pack_into(f"{order}I", body, last, len(body))
        body += struct.pack(f"{order}H", len(tags))
        for tag, kind, count, value in tags:
            body += struct.pack(f"{order}HHI", tag, kind, count) + (struct.pack(f"{order}HH", value, 0) if kind == 3 else struct.pack(f"{order}I", value))
        last = len(body)
        body += b"\0\0\0\0"
    return bytes(body)


def directories(data: bytes) -> Iterator[tuple[str, dict[int, list[int]]]]:
    """The byte order and the tags of each image directory; a loop between directories ends the walk."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(f"{order}H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen = struct.unpack_from(f"{order}I", data, 4)[0], set()
    while at and at not in seen:
        seen.add(at)
        (count,) = struct.unpack_from(f"{order}H", data, at)
        tags: dict[int, list[int]] = {}
        for i in range(count):
            entry = at + 2 + 12 * i
            tag, kind, n = struct.unpack_from(f"{order}HHI", data, entry)
            letter = {1: "B", 3: "H", 4: "I"}.get(kind)
            if letter:
                size = n * struct.calcsize(letter)
                place = entry + 8 if size <= 4 else struct.unpack_from(f"{order}I", data, entry + 8)[0]
                tags[tag] = list(struct.unpack_from(f"{order}{n}{letter}", data, place))
        yield order, tags
        (at,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * count)


def samples(data: bytes, order: str, tags: dict[int, list[int]]) -> np.ndarray:
    """The page's samples as rows x (width * samples per pixel)."""
    one = lambda tag, default: tags.get(tag, [default])[0]
    width, rows, bits, how, per, predictor = one(256, 0), one(257, 0), one(258, 1), one(259, 1), one(277, 1), one(317, 1)
    if bits not in (8, 16) or predictor not in (1, 2) or one(284, 1) != 1:
        raise ValueError(f"{bits} bits, predictor {predictor} or this sample plan is not supported")
    kind = np.dtype(np.uint8) if bits == 8 else np.dtype(np.uint16).newbyteorder(order)
    tiled = 324 in tags
    wide, tall = (one(322, 0), one(323, 0)) if tiled else (width, min(one(278, rows), rows))
    offsets, sizes = tags[324 if tiled else 273], tags[325 if tiled else 279]
    page = np.zeros((rows, width * per), kind.newbyteorder("="))
    across = -(-width // wide)
    for i, (offset, size) in enumerate(zip(offsets, sizes, strict=True)):
        y, x = i // across * tall, i % across * wide
        height = tall if tiled else min(tall, rows - y)
        if offset + size > len(data):
            raise ValueError("a strip or tile lies beyond the file")
        flat = np.frombuffer(_expand(data[offset : offset + size], how), kind)
        block = flat[: height * wide * per].reshape(height, wide, per)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=page.dtype)
        cut = block[: rows - y, : width - x].reshape(min(height, rows - y), -1)
        page[y : y + cut.shape[0], x * per : x * per + cut.shape[1]] = cut
    return page


# --- documents as media ---------------------------------------------------------------------------------------------


def payload_of(text: str) -> bytes:
    raw = text.encode("utf-8", "surrogatepass")
    return raw.ljust(max(1, -(-len(raw) // WIDTH)) * WIDTH, b" ")


def store(payload: bytes) -> bytes:
    """Payload bytes as a TIFF of one of KINDS; files whose rows fill whole tiles are tiled.  Equal payloads give equal files."""
    grid = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    pages = [grid[y : y + PAGE_ROWS] for y in range(0, len(grid), PAGE_ROWS)]
    how, predictor = KINDS[zlib.crc32(payload) % len(KINDS)]
    return write_tiff(pages, how, predictor, tiled=len(grid) % TILE == 0)


def encode(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep columns plus n_bytes (of the text) and media, the text's payload as a TIFF file (null text: empty)."""

    def make(texts: list[str]) -> list:
        return [[len(t.encode("utf-8", "surrogatepass")) for t in texts], [store(payload_of(t)) for t in texts]]

    return map_text(df, keep if keep is not None else df.columns, text, "n_bytes long, media binary", make)


PAGE_FIELDS = "page int, width int, height int, bits int, compression int, predictor int, tiled boolean, samples binary, error string"


def read_pages(data: bytes | None) -> Iterator[tuple]:
    if not data:
        return
    number = -1
    try:
        for number, (order, tags) in enumerate(directories(data)):
            head = [number, *(tags.get(t, [d])[0] for t, d in ((256, 0), (257, 0), (258, 1), (259, 1), (317, 1))), 324 in tags]
            try:
                yield (*head, samples(data, order, tags).tobytes(), None)
            except Exception as error:  # a damaged page is a row with its reason
                yield (*head, None, str(error)[:200])
    except (ValueError, struct.error) as error:
        yield (number + 1 if number >= 0 else -1, 0, 0, 0, 0, 0, False, None, str(error)[:200])


def pages(df: DataFrame, media: str = "media", keep: list[str] | None = None) -> DataFrame:
    """One row per page of each TIFF in the media column: keep columns, then PAGE_FIELDS."""
    from pyspark.sql.types import StructType

    keep = [c for c in df.columns if c != media] if keep is None else keep
    source = df.select(*keep, media)
    schema = StructType(source.select(*keep).schema.fields + StructType.fromDDL(PAGE_FIELDS).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for part in slices(batches, 100):
            rows, found = [], []
            for i, data in enumerate(part.column(len(keep)).to_pylist()):
                for page in read_pages(data):
                    rows.append(i)
                    found.append(page)
            kept = part.select(range(len(keep))).take(pa.array(rows, pa.int64()))
            made = [pa.array([p[k] for p in found], f.type) for k, f in enumerate(list(arrow)[len(keep):])]
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(kept.columns, arrow)), *made], schema=arrow)

    return source.mapInArrow(run, schema)


FEATURE_FIELDS = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_pages int"


def feature_of(payload: bytes) -> str:
    """Integer features of the samples: mean and variance in thousandths, share of bytes in four ranges, ascents."""
    x = np.frombuffer(payload, np.uint8)
    counts = np.bincount(x, minlength=256).astype(np.int64)
    n, total, squares = len(x), int(counts @ np.arange(256)), int(counts @ (np.arange(256) ** 2))
    ranges = [int(c) for c in np.add.reduceat(counts, [0, 33, 65, 97, 128])]
    return ",".join(map(str, [total * 1000 // n, (squares * n - total * total) * 1000 // (n * n), *ranges, int(np.count_nonzero(x[1:] > x[:-1]))]))


def features(df: DataFrame, media: str = "media", keep: list[str] | None = None) -> DataFrame:
    """keep columns plus FEATURE_FIELDS, all computed from the samples that read_pages() decodes from the stored file."""
    from pyspark.sql.types import StructType

    keep = [c for c in df.columns if c != media] if keep is None else keep
    source = df.select(*keep, media)
    schema = StructType(source.select(*keep).schema.fields + StructType.fromDDL(FEATURE_FIELDS).fields)

    def digest(data: bytes | None) -> tuple:
        found = list(read_pages(data))
        bad = next((p[-1] for p in found if p[-1]), None)
        if not found or bad:
            return (None, None, None, len(data or b""), hashlib.sha256(data or b"").hexdigest(), bad, len(found))
        payload = b"".join(p[-2] for p in found)
        return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature_of(payload), len(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for part in slices(batches):
            made = [digest(data) for data in part.column(len(keep)).to_pylist()]
            kept = [c.cast(f.type) for c, f in zip(part.columns[: len(keep)], arrow)]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array([m[k] for m in made], f.type) for k, f in enumerate(list(arrow)[len(keep):]))], schema=arrow)

    return source.mapInArrow(run, schema)


def document_media(docs: DataFrame) -> DataFrame:
    """Each document stored as TIFF, read back and digested: the columns of op4_tiff_media."""
    stored = encode(docs, keep=["doc_id"])
    return features(stored).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", F.col("n_pages"))
