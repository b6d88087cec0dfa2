"""WARC archives with a two-level capture index.

`write_archive` writes a table of pages as WARC 1.1 files, one gzip member a record, and returns where each record
lies.  Of records with equal payloads of LEAST_REPEATED bytes or more, that with the largest key is a response and the
others revisit it; all others are responses.

`write_index` sorts captures by reversed-host URL key, then by page, cuts them into compressed blocks of BLOCK_LINES
lines, and ends each index file with a sparse directory: the first and last key, place and size of each block.  What it
returns has one row an index file, with its first and last key.  `find` looks keys up: by binary search among the
files, then in a file's directory, then in the blocks that may hold the key, each of which is one range read.  A key
with very many captures lies in many blocks, which are read by different tasks.  `read_records` reads the records found,
by ranges of the archives, and `payloads` gives each revisit the payload digest of the response that it refers to.

Files lie in a folder that all executors share and that pyarrow's file systems can open by its URI.  File names hold a
random part, and only what a task that ended well returned is ever looked up, so that tasks may run twice.

Defined results: a null page is empty; a null URL has the empty key; pages with equal payloads that share the largest
page key are all responses, and if all keys of equal payloads are null, all are; a null key is smaller than all others;
repeated rows give repeated records; an empty table gives no rows.  Control characters and white space in a URL's key
count as one and the same.
"""

from __future__ import annotations

import gzip
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketeer.llm.common import shared_path, slices, written

#: Payloads of fewer bytes are never revisited.
LEAST_REPEATED = 1000
#: A new archive file begins after so many bytes; lines of an index block; zlib level of records and blocks.
ARCHIVE_BYTES, BLOCK_LINES, LEVEL = 1_000_000_000, 3000, 4
#: One range read of an archive covers records that lie together, up to so many bytes.
READ_BYTES = 8_000_000
#: Repeated payloads are sent to all tasks up to so many; beyond, both sides are shuffled by digest.
MOST_SENT = 100_000
#: Fixed value: the profile that names revisits by equal payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
CAPTURE = "url_key string, page string, url string, date string, record_type string, digest string, file string, offset bigint, length bigint"
INDEX = "first_key string, last_key string, file string, offset bigint, length bigint, n_lines bigint"
RECORD = "page string, record_type string, url string, date string, refers_to string, digest string, payload binary"


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, the port if it is not the scheme's own, then path and query.

    https://www.example.com/a?b#c gives com,example,www)/a?b; scheme, user and fragment don't count."""
    parts = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?//(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    scheme, host, port, rest = (F.regexp_extract(text, parts, i) for i in (1, 2, 3, 4))
    usual = (port == "") | ((F.lower(scheme) == "http") & (port == "80")) | ((F.lower(scheme) == "https") & (port == "443"))
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), F.lit(")"), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))
    return F.regexp_replace(F.when(text.rlike(parts), key).otherwise(text), r"[\x00-\x20\x7F]", "%20")


# --- records --------------------------------------------------------------------------------------------------------


def record_id(page: str | None) -> str:
    return "<urn:no-page>" if page is None else f"<urn:page:{quote(page, safe='')}>"


def page_of(identifier: str | None) -> str | None:
    return unquote(identifier[10:-1]) if identifier and identifier.startswith("<urn:page:") else None


def record(kind: str, page: str | None, url: str | None, date: str, digest: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record as a gzip member.  A revisit holds the head of the answer alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> tuple:
    """The fields of RECORD of one gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record here")
    named = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(named["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2] if named.get("content-type", "").startswith("application/http") else block
    kind = named["warc-type"]
    digest = named.get("warc-payload-digest", "").removeprefix("sha1:")
    return page_of(named["warc-record-id"]), kind, named.get("warc-target-uri"), named.get("warc-date"), page_of(named.get("warc-refers-to")), digest, None if kind == "revisit" else payload


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", date: Column | None = None) -> DataFrame:
    """Write pages as WARC files in the folder path.  Returns the captures (CAPTURE), one row a record."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.lit(DATE) if date is None else date, F.lit(DATE)).alias("date"), body.alias("payload"), F.sha1(body).alias("digest"), F.length(body).alias("size"))
    groups = written(rows.where(f"size >= {LEAST_REPEATED}").groupBy("digest").agg(F.max("key").alias("last"), F.count("*").alias("n")).where("n > 1").select("digest", "last"), "repeated")
    few = groups.limit(MOST_SENT + 1).count() <= MOST_SENT
    joined = rows.join((F.broadcast if few else lambda x: x.hint("merge"))(groups.withColumn("repeated", F.lit(True))), "digest", "left")
    again = F.col("repeated").isNotNull() & (F.col("size") >= LEAST_REPEATED) & ~F.col("key").eqNullSafe(F.col("last"))
    ready = joined.select(url_key(F.col("url")).alias("url_key"), F.col("key").cast("string").alias("page"), "url", "date", "digest", "payload", F.when(again, F.col("last").cast("string")).alias("refers_to"), again.alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(path)
        store.create_dir(folder, recursive=True)
        schema, file, name, at = _arrow(CAPTURE), None, "", 0
        for batch in slices(batches):
            made = []
            for k, page, link, day, digest, data, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kind = "revisit" if revisit else "response"
                member = record(kind, page, link, day, digest, data, refers_to)
                if file is None or at >= ARCHIVE_BYTES:
                    if file is not None:
                        file.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    file = store.open_output_stream(f"{folder}/{name}", compression=None)
                file.write(member)
                made.append((k, page, link, day, kind, digest, name, at, len(member)))
                at += len(member)
            yield _batch(made, schema)
        if file is not None:
            file.close()

    return written(ready.mapInArrow(run, CAPTURE), "captures")


# --- the index ------------------------------------------------------------------------------------------------------


def write_index(captures: DataFrame, path: str) -> DataFrame:
    """Write captures as sorted compressed blocks, and each file's block directory, in the folder path.

    Returns INDEX: an index file's first and last key, the place of its directory, and how many lines it holds."""
    ordered = captures.repartitionByRange("url_key", "page", "file", "offset").sortWithinPartitions("url_key", "page", "file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(path)
        store.create_dir(folder, recursive=True)
        name, at, lines, directory, count = f"{uuid.uuid4().hex}.idx", 0, [], [], 0
        with store.open_output_stream(f"{folder}/{name}", compression=None) as file:

            def close() -> None:
                nonlocal at, lines
                data = gzip.compress("".join(f"{k} {rest}\n" for k, rest in lines).encode(), LEVEL, mtime=0)
                directory.append([lines[0][0], lines[-1][0], at, len(data)])
                file.write(data)
                at, lines = at + len(data), []

            for batch in slices(batches):
                for k, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    lines.append((k, json.dumps(rest)))
                    count += 1
                    if len(lines) >= BLOCK_LINES:
                        close()
            if lines:
                close()
            last = gzip.compress(json.dumps(directory).encode(), LEVEL, mtime=0)
            file.write(last)
        if count:
            yield _batch([(directory[0][0], directory[-1][1], name, at, len(last), count)], _arrow(INDEX))

    return written(ordered.select("url_key", "page", "url", "date", "record_type", "digest", "file", "offset", "length").mapInArrow(run, INDEX), "index")


def _range(store: fs.FileSystem, path: str, offset: int, length: int) -> bytes:
    with store.open_input_file(path) as file:
        return file.read_at(length, offset)


def find(index: DataFrame, path: str, keys: DataFrame, key: str = "url_key") -> DataFrame:
    """The captures (CAPTURE) of every key that is asked for.  index: what write_index(…, path) returned.

    The index's rows, one a file, are as many as the partitions it was written by; they go to all tasks."""
    files = sorted((r["first_key"].encode(), r["last_key"].encode(), r["file"], r["offset"], r["length"]) for r in index.collect())
    first, last = [f[0] for f in files], [f[1] for f in files]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(path)
        schema, held = _arrow("url_key string, file string, offset bigint, length bigint"), (None, [], [], [])
        for batch in slices(batches):
            out = []
            for wanted in batch.column(0).to_pylist():
                name = wanted.encode()
                for i in range(bisect_left(last, name), bisect_right(first, name)):
                    if held[0] != i:
                        _, _, file, offset, length = files[i]
                        entries = json.loads(gzip.decompress(_range(store, f"{folder}/{file}", offset, length)))
                        held = (i, [e[0].encode() for e in entries], [e[1].encode() for e in entries], entries)
                    out += [(wanted, files[i][2], *held[3][b][2:]) for b in range(bisect_left(held[2], name), bisect_right(held[1], name))]
            yield _batch(out, schema)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(path)
        schema, held = _arrow(CAPTURE), (None, [], [])
        for batch in slices(batches):
            out = []
            for wanted, file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held[0] != (file, offset):
                    rows = gzip.decompress(_range(store, f"{folder}/{file}", offset, length)).split(b"\n")[:-1]
                    held = ((file, offset), [r.partition(b" ")[0] for r in rows], rows)
                name = wanted.encode()
                for i in range(bisect_left(held[1], name), bisect_right(held[1], name)):
                    out.append((wanted, *json.loads(held[2][i].partition(b" ")[2])))
                    if len(out) >= 5000:
                        yield _batch(out, schema)
                        out = []
            yield _batch(out, schema)

    asked = keys.select(F.col(key).alias("url_key")).where("url_key IS NOT NULL").distinct().repartitionByRange("url_key").sortWithinPartitions("url_key")
    pairs = written(asked.mapInArrow(blocks, "url_key string, file string, offset bigint, length bigint"), "blocks")
    return pairs.repartitionByRange("file", "offset", "url_key").sortWithinPartitions("file", "offset", "url_key").mapInArrow(lines, CAPTURE)


def read_records(captures: DataFrame, path: str) -> DataFrame:
    """The records (RECORD) of captures, read from the archives in path by ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(path)
        schema, file, name = _arrow(RECORD), None, None
        for batch in slices(batches, 200):
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            out, i = [], 0
            while i < len(rows):
                begin, end, j = rows[i][1], rows[i][1] + rows[i][2], i + 1
                while j < len(rows) and rows[j][0] == rows[i][0] and rows[j][1] <= end and rows[j][1] + rows[j][2] - begin <= READ_BYTES:
                    end, j = max(end, rows[j][1] + rows[j][2]), j + 1
                if name != rows[i][0]:
                    if file is not None:
                        file.close()
                    name, file = rows[i][0], store.open_input_file(f"{folder}/{rows[i][0]}")
                data = file.read_at(end - begin, begin)
                out += [parsed(data[at - begin : at - begin + length]) for _, at, length in rows[i:j]]
                i = j
            yield _batch(out, schema)
        if file is not None:
            file.close()

    places = captures.select("file", "offset", "length")
    return places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, RECORD)


def payloads(records: DataFrame) -> DataFrame:
    """page, payload_bytes, payload_digest, record_type, refers_to: a revisit has what its response's payload gives."""
    facts = written(records.select("page", "record_type", "refers_to", "digest", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")), "facts")
    own = facts.where("record_type <> 'revisit'")
    responses = written(own.groupBy(F.col("page").alias("refers_to"), F.col("payload_digest").alias("digest")).agg(F.max("payload_bytes").alias("payload_bytes")), "responses")
    revisits = facts.where("record_type = 'revisit'").select("page", "record_type", "refers_to", "digest")
    # both sides are written tables, so that adaptive execution can split a response that very many refer to
    joined = revisits.join(responses, ["refers_to", "digest"], "left").select("page", "payload_bytes", F.when(F.col("payload_bytes").isNotNull(), F.col("digest")).alias("payload_digest"), "record_type", "refers_to")
    return own.select("page", "payload_bytes", "payload_digest", "record_type", "refers_to").unionByName(joined)


def archive_digest(pages: DataFrame) -> DataFrame:
    """Write pages as archives and index in the shared folder, look all their URLs up: the columns of op13_warc."""
    spark: SparkSession = pages.sparkSession
    folder = shared_path(spark, "warc")
    captures = write_archive(pages, f"{folder}/archive")
    index = write_index(captures, f"{folder}/index")
    found = find(index, f"{folder}/index", pages.select(url_key(F.col("url")).alias("url_key")))
    kind = pages.schema["page_id"].dataType
    out = payloads(read_records(found, f"{folder}/archive"))
    return out.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE_SQL = """
WITH records AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), last AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM records)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < response THEN response END AS refers_to
FROM last
"""
