"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell (source, language, topic).  Raking scales the cells until their sums over each of the three
dimensions meet its target shares; documents are then sampled by the calibrated probability of their cell, with a
number drawn from the document's id, so that every run draws the same.

The cell table is aggregated before it is shuffled and grows with the distinct cells, not the documents.  Raking runs
on it ROUNDS times over the three dimensions, each time as an aggregation by the dimension (combined before the
shuffle, so that a language with most cells is no burden) joined back; a round is one plan, and written.  Only single
totals come to the driver.  A cell's probability is its raked tokens over its own,
scaled so that the sample has the wanted share of all tokens; where that is over 1, all its documents are kept and
the other cells are scaled up in turn (FILL_ROUNDS times).

Targets are given as {dimension: {value: weight}}; dimensions that aren't given are tempered: each value's share of
the tokens to the power TEMPER.  Values without a target keep their tempered share; cells can't get more than they
have.

Defined results: null source, lang or topic is the value ''; null text has no tokens, and its document is in the cell
but counts for nothing; cells without tokens have probability 1; rows with equal doc_id are drawn together, those with a null one
as if it were the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.llm.common import written

DIMENSIONS = ("source", "lang", "topic")
#: Share of all tokens to keep, exponent of tempered targets, rounds of raking and of filling.
SHARE, TEMPER, ROUNDS, FILL_ROUNDS = 0.8, 0.7, 6, 4


def topic_of(text: Column) -> Column:
    """A coarse topic from the text's form: table, code, list or prose."""
    return (
        F.when(F.length(text) - F.length(F.replace(text, F.lit("|"))) >= 20, "table")
        .when(text.rlike(r"(?md)^[ \t]*(def |class |import |#include|[{};])"), "code")
        .when(text.rlike(r"(?md)^[ \t]*([-*]|[0-9]+[.)]) "), "list")
        .otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    """Words in the text."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def draw(key: Column) -> Column:
    """A number in [0, 1) from the key: the first 52 bits of its MD5."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_cells(docs: DataFrame) -> DataFrame:
    """docs plus __source, __lang, __topic and __tokens."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select("*", blank("source").alias("__source"), blank("lang").alias("__lang"), topic_of(text).alias("__topic"), tokens_of(text).alias("__tokens"))


def _targets(cells: DataFrame, dimension: str, total: int, given: dict[str, float] | None, temper: float) -> DataFrame:
    """dimension and its target share: given, or the token share to the power temper; normalised to sum 1."""
    target = F.pow(F.sum("tokens") / F.lit(float(total)), F.lit(temper))
    for value, weight in sorted((given or {}).items()):
        target = F.when(F.col(dimension) == value, F.lit(float(weight))).otherwise(target)
    raw = cells.groupBy(dimension).agg(target.alias("target"))
    return raw.select(dimension, (F.col("target") / F.lit(raw.agg(F.sum("target")).first()[0])).alias(f"t_{dimension}"))


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, rounds: int = ROUNDS) -> DataFrame:
    """cells (source, lang, topic, tokens) plus weight: raked shares that sum to 1.  Cells without tokens go."""
    state = cells.where("tokens > 0")
    total = state.agg(F.sum("tokens")).first()[0]
    if not total:
        return state.withColumn("weight", F.lit(0.0))
    for d in DIMENSIONS:
        state = state.join(_targets(cells.where("tokens > 0"), d, total, (targets or {}).get(d), temper), d)
    state = written(state.withColumn("weight", F.col("tokens") / F.lit(float(total))), "rake")
    for _ in range(rounds):
        for d in DIMENSIONS:
            sums = state.groupBy(d).agg(F.sum("weight").alias("__sum"))
            state = state.join(sums, d).withColumn("weight", F.col("weight") * F.col(f"t_{d}") / F.col("__sum")).drop("__sum")
        state = written(state, "rake")  # a round's three steps are one plan
    whole = state.agg(F.sum("weight")).first()[0]
    return state.withColumn("weight", F.col("weight") / F.lit(whole)).drop(*(f"t_{d}" for d in DIMENSIONS))


def probabilities(raked: DataFrame, share: float = SHARE, rounds: int = FILL_ROUNDS) -> DataFrame:
    """raked plus p: the probability to keep a document of the cell."""
    want = (raked.agg(F.sum("tokens")).first()[0] or 0) * share
    state = raked.withColumn("p", F.least(F.lit(1.0), F.lit(want) * F.col("weight") / F.col("tokens")))
    for _ in range(rounds):
        full = F.col("p") >= 1.0
        held, open_ = state.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not held or not open_:
            break
        scale = F.lit((want - held) / open_)
        state = state.withColumn("p", F.when(full, 1.0).otherwise(F.least(F.lit(1.0), scale * F.col("weight") / F.col("tokens"))))
    return state


def cell_table(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, share: float = SHARE) -> DataFrame:
    """source, lang, topic, tokens, documents, weight and p of every cell with tokens."""
    cells = with_cells(docs).groupBy(F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic")).agg(F.sum("__tokens").alias("tokens"), F.count("*").alias("documents"))
    return written(probabilities(rake(written(cells, "cells"), targets), share), "raked")


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, share: float = SHARE) -> DataFrame:
    """docs plus topic, tokens, p and chosen, for every row (earlier columns of these names are replaced)."""
    table = cell_table(docs, targets, share).select(F.col("source").alias("__source"), F.col("lang").alias("__lang"), F.col("topic").alias("__topic"), F.col("p").alias("__p"))
    joined = with_cells(docs).join(table, ["__source", "__lang", "__topic"], "left")
    kept = [c for c in docs.columns if c not in ("topic", "tokens", "p", "chosen")]
    p = F.coalesce("__p", F.lit(1.0))
    return joined.select(*kept, F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"), p.alias("p"), (draw(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) < p).alias("chosen"))


def document_mix(docs: DataFrame) -> DataFrame:
    """The columns of op2_mixing."""
    drawn = sample(docs.select("doc_id", "source", "lang", "text"))
    return drawn.select("doc_id", F.col("topic"), F.col("tokens").alias("n_tokens"), F.round("p", 6).alias("probability"), "chosen")


def keep_sample(docs: DataFrame) -> DataFrame:
    """The rows of docs that the mix chooses."""
    names = docs.columns
    plain = docs.select(F.struct(*names).alias("__row"), "doc_id", "source", "lang", "text")
    return sample(plain).where("chosen").select("__row.*")


def _oracle() -> str:
    """The same rows in SQL: raking as window sums, one step after the other."""
    parts = [
        """d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
  CASE WHEN length(coalesce(text, '')) - length(replace(coalesce(text, ''), '|', '')) >= 20 THEN 'table'
       WHEN regexp_matches(coalesce(text, ''), '(?m)^[ \t]*(def |class |import |#include|[{};])') THEN 'code'
       WHEN regexp_matches(coalesce(text, ''), '(?m)^[ \t]*([-*]|[0-9]+[.)]) ') THEN 'list' ELSE 'prose' END AS topic,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents)""",
        "c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(tokens) > 0)",
    ]
    for x in DIMENSIONS:
        parts.append(f"r_{x} AS (SELECT {x}, pow(sum(tokens) / (SELECT sum(tokens) FROM c), {TEMPER}) AS t FROM c GROUP BY {x})")
        parts.append(f"t_{x} AS (SELECT {x}, t / (SELECT sum(t) FROM r_{x}) AS t_{x} FROM r_{x})")
    parts.append("w0 AS (SELECT *, tokens / (SELECT sum(tokens) FROM c) AS weight FROM c JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic))")
    step = 0
    for _ in range(ROUNDS):
        for x in DIMENSIONS:
            parts.append(f"w{step + 1} AS (SELECT * REPLACE (weight * t_{x} / sum(weight) OVER (PARTITION BY {x}) AS weight) FROM w{step})")
            step += 1
    parts.append(f"v AS (SELECT source, lang, topic, tokens, weight / (SELECT sum(weight) FROM w{step}) AS weight FROM w{step})")
    parts.append(f"p0 AS (SELECT *, least(1.0, (SELECT sum(tokens) FROM v) * {SHARE} * weight / tokens) AS p FROM v)")
    for i in range(FILL_ROUNDS):
        held, open_ = (f"(SELECT coalesce(sum({v}), 0) FROM p{i} WHERE p {o} 1)" for v, o in (("tokens", ">="), ("weight", "<")))
        scaled = f"((SELECT sum(tokens) FROM v) * {SHARE} - {held}) / nullif({open_}, 0)"
        parts.append(f"p{i + 1} AS (SELECT * REPLACE (CASE WHEN p >= 1 THEN 1.0 ELSE least(1.0, {scaled} * weight / tokens) END AS p) FROM p{i})")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, topic, d.tokens AS n_tokens, round(coalesce(p, 1.0)::DOUBLE, 6) AS probability,
  ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < coalesce(p, 1.0) AS chosen
FROM d LEFT JOIN p{FILL_ROUNDS} USING (source, lang, topic)"""
    )


ORACLE_SQL = _oracle()
