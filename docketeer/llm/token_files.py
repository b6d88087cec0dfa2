"""Token-ID output: Parquet list columns with delta-encoded ids, bounded row groups and pages, and page indexes.

`encode` turns texts into ids of a public tokenizer; `write_tokens` writes them in ascending id order, with each
row's offset inside its file part; `read_tokens` reads them back with global offsets.  Because rows are sorted and
pages carry min/max indexes, a filter on doc_id reads only the pages it needs, and offsets or lengths can be read
without the ids.

Defined results: null text is empty and gives only the end id; rows with equal doc_id are all written, in order of
their texts; null doc_id sorts first; an empty table gives an empty file set and no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docketeer.llm.common import shared_path, slices

END_ID = 1
#: Parquet settings of the token files: format v2 without dictionaries writes integers as DELTA_BINARY_PACKED.
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.block.size": str(16 * 1024 * 1024),
    "parquet.page.size": str(256 * 1024),
    "parquet.page.row.count.limit": "2000",
}
#: Words whose ids a worker process remembers for good, words that it remembers until there are too many of them, and the
#: characters of the longest word that it remembers at all.
WORDS_KEPT, WORDS_PASSING, LONGEST_KEPT = 400_000, 200_000, 64
#: Latin letters (without U+0130, whose small form is two characters).
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
#: In texts of ASCII and these letters alone, groups end where letters and other characters meet, but for apostrophes.
_OTHER = re.compile(f"[^\x00-\x7f{_LETTERS}]")
_FINE, _AROUND = re.compile(f"[{_LETTERS}]+|[^ \t-\r{_LETTERS}]+"), re.compile(f"[^ \t-\r]*'[^ \t-\r]*|[{_LETTERS}]+|[^ \t-\r{_LETTERS}]+")
#: Words that are one group and that no normalizer changes.
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
#: Printable ASCII without letters and apostrophes: digits are groups of their own, and so is what stands between them.
_SIGNS, _SIGN_GROUPS = re.compile(r"[!-&(-@\[-`{-~]+"), re.compile("[0-9]|[^0-9]+")
#: The characters by which byte-level models write bytes, by rule: printable ones stand for themselves, the others follow U+0100.
_PRINTED = frozenset([*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)])
_BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTED)}
#: How a tokenizer file says that it composes, ignores case, drops white space and groups as below.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_GROUPS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_at_space(config: dict) -> bool:
    """Whether a tokenizer's file says that a text's ids are those of its words, and that ASCII case makes no difference."""
    normalizer = config.get("normalizer") or {}
    split, as_bytes = [*((config.get("pre_tokenizer") or {}).get("pretokenizers") or []), {}, {}][:2]
    return (
        normalizer.get("normalizers") == _NORMALIZERS
        and (split.get("pattern"), split.get("behavior"), split.get("invert")) == ({"Regex": _GROUPS}, "Removed", True)
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) or "<|" not in t["content"] for t in config.get("added_tokens", []))
        and {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}.items() <= as_bytes.items()
        and not config.get("truncation") and not config.get("padding")
    )


def lowered(text: str) -> str | None:
    """The text with A-Z as a-z, or None where the tokenizer might compose other characters then.

    It composes first and lowers later, and a-z have composed forms that A-Z lack (U+1E97 for t, none for T)."""
    if text.isascii():
        return text.lower()
    small = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return small if unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", small) else None


class _Words(dict):
    """Ids of words, little-endian uint32; a word that isn't known is learned when it is looked up.

    Words seen early are the frequent ones, and stay; later ones are forgotten when there are too many of them."""

    def __init__(self, learn) -> None:
        super().__init__()
        self.learn, self.passing = learn, []

    def __missing__(self, word: str) -> bytes:
        ids = self.learn(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORDS_KEPT:
                self.passing.append(word)
            self[word] = ids
        return ids

    def forget(self) -> None:
        if len(self.passing) > WORDS_PASSING:
            for word in self.passing:
                del self[word]
            self.passing.clear()


class WordEncoder:
    """Ids of a tokenizer, word by word where it ignores case and drops white space, else of whole texts.

    Such a tokenizer never composes or merges over white space, so a text's ids are those of its words in turn; words
    repeat, and a remembered word costs a dictionary look-up.  A-Z are lower-cased first where that is safe, and never
    where the text may hold a special token.
    """

    def __init__(self, tokenizer_path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as file:
            self.by_word = splits_at_space(json.load(file))
        self.known = _Words(self._learned)

    def _words(self, text: str) -> list[str]:
        small = lowered(text) if "<|" not in text else None
        if small is not None and (small.isascii() or not _OTHER.search(small)):
            return (_AROUND if "'" in small else _FINE).findall(small)
        text = text if small is None else small
        for space in "\t\n\x0b\x0c\r":
            text = text.replace(space, " ")
        return text.split(" ")

    def _group(self, written: str) -> bytes:
        """Ids of one group in the model's own characters, straight from the model."""
        return array("I", [token.id for token in self.tokenizer.model.tokenize(written)]).tobytes()

    def _learned(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word):
            return self._group(word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_CHARS))
        if _SIGNS.fullmatch(word) and "<|" not in word:
            groups = _SIGN_GROUPS.findall(word)
            return self._group(word) if len(groups) == 1 else b"".join(map(self.known.__getitem__, groups))
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [array("I", found.ids).tobytes() for found in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        out: list[bytes] = []
        for text in texts:
            out.append(b"".join(map(self.known.__getitem__, self._words(text))))
            self.known.forget()
        return out


@lru_cache(maxsize=2)
def word_encoder(tokenizer_path: str) -> WordEncoder:
    """The encoder of this worker process, which later tasks use again."""
    return WordEncoder(tokenizer_path)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Write the texts' ids to path in ascending key order: columns key, part, local_start, n_tokens, ids.

    part numbers the sorted file parts; local_start counts ids before the row inside its part.
    """
    source = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([source.schema[0], T.StructField("part", T.IntegerType()), T.StructField("local_start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark.sql.pandas.types import to_arrow_schema

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        arrow, encoder, part, start = to_arrow_schema(schema), word_encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            rows = [x + end for x in encoder.ids(batch.column(1).to_pylist())]
            counts = np.array([len(x) // 4 for x in rows], np.int64)
            offsets = np.concatenate(([0], np.cumsum(counts)))
            values = pa.array(np.frombuffer(b"".join(rows), "<u4").astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values, type=arrow.field(4).type)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(rows), part, np.int32)), pa.array(start + offsets[:-1]), pa.array(counts), lists], schema=arrow)
            start += int(offsets[-1])

    # by the key alone where rows are dealt out: a key's rows stay together, and only ties compare texts
    ordered = source.repartitionByRange(F.col(key)).sortWithinPartitions(key, "text")
    ordered.mapInArrow(run, schema).write.options(**FILE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Rows of a token file set with start, the number of ids before them in all parts.

    The totals of the parts come from the same files (metadata columns only); they are one row per part.
    """
    rows = spark.read.parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    out = rows if ids else rows.drop("ids")
    return out.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("local_start")).drop("base", "local_start", "part")


def crc_of_ids(df: DataFrame, ids: str = "ids") -> DataFrame:
    """df with ids replaced by n_tokens and ids_crc32, counted and summed over the list itself."""
    keep = [c for c in df.columns if c not in (ids, "n_tokens")]
    schema = T.StructType(df.select(*keep).schema.fields + [T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            lists = batch.column(len(keep))
            offsets = lists.offsets.to_numpy()
            data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64())], schema=arrow)

    return df.select(*keep, ids).mapInArrow(run, schema)


def token_file_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write docs as a token file set in the shared folder, read it back: the columns of op9_token_files."""
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path)
    return crc_of_ids(read_tokens(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")
