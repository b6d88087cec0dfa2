"""Corpus preparation over `documents`: quality rules, line dedup, near-duplicate removal, mixing, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  run() writes each stage's result as Parquet in the
folder that all executors share and gives it, read again, to the next stage.  All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketeer.llm import lines, mixing, pieces, quality, simhash
from docketeer.llm.common import table, written
from docketeer.llm.queries import PIECES


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later runs of repeated lines; those that lose all their lines go."""
    return lines.keep_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near duplicates."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet tempered source, language and topic shares."""
    return mixing.keep_sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and SentencePiece ids, with the round trip checked."""
    return pieces.document_pieces(docs, PIECES)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

#: The learned rules and the segmentation can't be expressed in SQL; tests/llm/test_pipeline.py holds run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
