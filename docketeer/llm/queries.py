"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docketeer.llm import lines, mixing, pieces, pii, quality, runs, search, simhash, suffixes, tiff, token_files, toxicity, warc
from docketeer.llm.common import table

#: Places of the public tokenizer files; the operators take them as parameters.
PIECES, WORD_IDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.document_passages(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_mix(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.document_pii(table(spark, sf_dir, "documents"))


def op4_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.document_media(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.document_pieces(table(spark, sf_dir, "documents"), PIECES)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.document_lines(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digest(table(spark, sf_dir, "documents"), WORD_IDS)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_components(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.document_runs(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.benchmark_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_mixing": op2_mixing,
    "op3_pii": op3_pii,
    "op4_tiff_media": op4_tiff_media,
    "op5_toxicity": op5_toxicity,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_quality_rules": op7_quality_rules,
    "op8_line_dedup": op8_line_dedup,
    "op9_token_files": op9_token_files,
    "op10_simhash": op10_simhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_ranked_search": op12_ranked_search,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {
    "op2_mixing": mixing.ORACLE_SQL,
    "op8_line_dedup": lines.ORACLE_SQL,
    "op12_ranked_search": search.ORACLE_SQL,
    "op13_warc": warc.ORACLE_SQL,
}
