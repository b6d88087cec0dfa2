"""Quality rules: decision lists learned by sequential covering over document statistics, as Spark expressions.

`document_stats` computes the statistics of every document with SQL functions alone; `learn_rules` grows and prunes
threshold conjunctions on a bounded labelled sample; `verdict` turns the ordered rules into one conditional
expression.  A document that a rule covers is rejected.

Learning: labelled rows are split in a growing and a pruning part.  A rule starts empty and takes the condition with
the highest information gain until it covers no good row or has MAX_CONDITIONS; pruning then drops last conditions
while that doesn't lower (bad - good) / (bad + good) on the pruning part.  Rules that miss MIN_PRECISION there end the
list.  Learning sees only counts of labelled rows by binned statistics: at most MAX_LABELLED of them, those with the
smallest hash of doc_id.

Defined results: null text has no words; documents with equal or null doc_id each get their own row (labels without a
doc_id teach nothing); a kept column may have any name but those of the statistics; without labels of both
classes the list is empty and only the base rules reject; a table without rows gives none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.llm.common import written

#: Labelled rows that learning may see, bins a statistic, conditions a rule, rules a list.
MAX_LABELLED, BINS, MAX_CONDITIONS, MAX_RULES = 8_000, 24, 3, 12
#: Share of bad rows that a rule must reach on the pruning part, and bad rows that it must cover there.
MIN_PRECISION, MIN_COVERED = 0.98, 3

SPACE = r"[\\x20\\x09-\\x0D]"
WORD = r"[^\\x20\\x09-\\x0D]"

#: What rules may test: statistics as exact ratios of the counts below.
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
}


def _let(name: str, value: str, body: str) -> str:
    """body with name standing for value, which is computed once a row."""
    return f"transform(array({value}), {name} -> {body})[0]"


#: Words in 3-word windows that occur twice or more.  Windows are sorted as 36 bits of hash with their place in the
#: lower 28 bits, which finds all that may be repeated; only those are compared by their full hash.
_REPEATS = _let(
    "h",
    "transform(__words, w -> xxhash64(w))",
    _let(
        "s",
        "sort_array(transform(sequence(0L, size(h) - 3L), i -> shiftleft(xxhash64(h[int(i)], h[int(i) + 1], h[int(i) + 2]), 28) | i))",
        _let(
            "c",
            "sort_array(transform(filter(s, (x, k) -> coalesce(shiftright(x, 28) = shiftright(get(s, k - 1), 28), false) or coalesce(shiftright(x, 28) = shiftright(get(s, k + 1), 28), false)),"
            " x -> named_struct('g', xxhash64(h[int(x & 268435455L)], h[int(x & 268435455L) + 1], h[int(x & 268435455L) + 2]), 'i', int(x & 268435455L))))",
            "size(array_distinct(flatten(transform(filter(c, (x, k) -> coalesce(x.g = get(c, k - 1).g, false) or coalesce(x.g = get(c, k + 1).g, false)), x -> array(x.i, x.i + 1, x.i + 2)))))",
        ),
    ),
)


def document_stats(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """keep columns (doc_id by default) plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), the
    counts that only FEATURES use, and base_failed."""
    keep = ["doc_id"] if keep is None else keep
    text = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__t"))
    split = text.select(
        *keep,
        F.expr(f"filter(split(__t, '{SPACE}+'), w -> w <> '')").alias("__words"),
        F.expr(f"filter(split(__t, '\\n'), l -> l rlike '{WORD}')").alias("__lines"),
        *(F.expr(f"length(__t) - length(regexp_replace(__t, '{chars}', ''))").cast("long").alias(name) for name, chars in (("n_symbols", "[#*$%&|<>]"), ("n_marks", "[!?;:]"), ("n_upper", r"\\p{Lu}"), ("n_digits", "[0-9]"))),
    )
    counted = split.select(
        *keep,
        F.expr("bigint(size(__words))").alias("n_words"),
        F.expr("aggregate(__words, 0L, (a, w) -> a + length(w))").alias("word_chars"),
        "n_symbols",
        F.expr("bigint(size(__lines) - size(array_distinct(__lines)))").alias("n_dup_lines"),
        F.expr(f"bigint(if(size(__words) < 4, 0, {_REPEATS}))").alias("n_repeat_words"),
        F.expr("bigint(size(__lines))").alias("n_lines"),
        "n_marks",
        "n_upper",
        "n_digits",
    )
    return counted.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def rule_holds(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.holds()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The number, from 1, of the first rule that covers the row, else null: one conditional expression."""
    out = F.when(F.lit(False), F.lit(None).cast("int"))
    for number, rule in enumerate(rules, 1):
        out = out.when(rule_holds(rule), F.lit(number))
    return out.otherwise(F.lit(None).cast("int"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = MAX_LABELLED) -> DataFrame:
    """FEATURES and base_failed of at most limit labelled documents, with bad (1 for label 0) and part (0 grow, 1 prune).

    A doc_id counts once, however many rows have it: by the row with the smallest statistics."""
    chosen = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("__label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    stats = document_stats(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), ["doc_id", "__label"])
    others = [c for c in stats.columns if c != "doc_id"]
    stats = stats.groupBy("doc_id").agg(F.min(F.struct(*others)).alias("__row")).select("doc_id", "__row.*")
    return stats.select("base_failed", (1 - F.col("__label")).alias("bad"), F.expr("int(pmod(xxhash64(doc_id, 7L), 3) = 0)").alias("part"), *(F.expr(f"double({e})").alias(f) for f, e in FEATURES.items()))


def learn_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = MAX_LABELLED) -> list[Rule]:
    sample = written(labelled_sample(docs, labels, label, limit), "labelled").where("not base_failed")  # written first: else the filter runs before the join, on all documents
    names = list(FEATURES)
    cuts = sample.agg(*(F.percentile(f, F.array(*(F.lit(i / BINS) for i in range(1, BINS)))).alias(f) for f in names), F.percentile("words", F.lit(0.5)).alias("__any")).first()
    thresholds = {f: sorted(set(cuts[f] or [])) for f in names}
    binned = sample.groupBy("bad", "part", *(_bin(f, thresholds[f]).alias(f) for f in names)).count()
    rows = [(r["bad"], r["part"], r["count"], [r[f] for f in names]) for r in binned.collect()]  # at most `limit` rows
    return cover(rows, names, thresholds)


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many of the cuts lie below the value."""
    return F.expr("0" + "".join(f" + int({feature} > {cut!r}D)" for cut in cuts))


def cover(rows: list[tuple], names: list[str], thresholds: dict[str, list[float]]) -> list[Rule]:
    """Sequential covering over counted rows (bad, part, count, bin of each feature)."""
    grow, prune = [r for r in rows if r[1] == 0], [r for r in rows if r[1] == 1]
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        found = _prune(_grow(grow, names, thresholds), prune)
        bad, good = _covered(found, prune)
        if not found or bad < MIN_COVERED or bad < MIN_PRECISION * (bad + good):
            break
        rules.append(tuple(Condition(names[f], above, thresholds[names[f]][cut]) for f, above, cut in found))
        grow, prune = ([r for r in part if not _holds(found, r)] for part in (grow, prune))
    return rules


def _holds(rule: list[tuple[int, bool, int]], row: tuple) -> bool:
    return all((row[3][f] > cut) == above for f, above, cut in rule)


def _covered(rule: list, rows: list[tuple]) -> tuple[int, int]:
    inside = [r for r in rows if _holds(rule, r)]
    return sum(r[2] for r in inside if r[0]), sum(r[2] for r in inside if not r[0])


def _grow(rows: list[tuple], names: list[str], thresholds: dict[str, list[float]]) -> list:
    rule: list[tuple[int, bool, int]] = []
    while len(rule) < MAX_CONDITIONS:
        bad, good = _covered([], rows)
        if not bad or not good:
            break
        before, best, choice = math.log2(bad / (bad + good)), 0.0, None
        for f, name in enumerate(names):
            size = len(thresholds[name]) + 1
            counts = [[0] * size, [0] * size]
            for r in rows:
                counts[r[0]][r[3][f]] += r[2]
            low_good = low_bad = 0
            for cut in range(size - 1):
                low_good, low_bad = low_good + counts[0][cut], low_bad + counts[1][cut]
                for above, p, n in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                    gain = p * (math.log2(p / (p + n)) - before) if p else 0.0
                    if gain > best:
                        best, choice = gain, (f, above, cut)
        if choice is None:
            break
        rule.append(choice)
        rows = [r for r in rows if _holds([choice], r)]
    return rule


def _prune(rule: list, rows: list[tuple]) -> list:
    def worth(candidate: list) -> float:
        bad, good = _covered(candidate, rows)
        return (bad - good) / (bad + good) if bad + good else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def document_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of op7_quality_rules: statistics, base_failed, kept, and the rule that rejected."""
    rules = learn_rules(docs, labels)
    judged = document_stats(docs).withColumn("rule", verdict(rules))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows and columns of docs that base rules and learned rules keep."""
    names = docs.columns
    rules = learn_rules(docs, labels)
    whole = docs.select("doc_id", "text", F.struct(*names).alias("__row"))
    judged = document_stats(whole, ["__row"])
    return judged.where(~F.col("base_failed") & verdict(rules).isNull()).select("__row.*")
