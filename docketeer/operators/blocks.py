"""Documents to rows: anchors, blocks, carried headings, page numbers."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docketeer.functions.arrays import scan
from docketeer.functions.text import let, lines_of, strip
from docketeer.sources.shared import written

PAGE_BREAK = "\n\n"


def starts_of(lengths: Column) -> Column:
    """Where each of consecutive pieces starts (from 0), by their lengths: sums of all lengths before, inside the row."""
    return scan(lengths, F.lit(0), lambda a, b: a + b)


def lines_with_starts(text: Column) -> Column:
    """The text's lines as an array of (i, start, line)."""
    return let(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda lines: F.zip_with(
            F.transform(lines, lambda line, i: F.struct(i.alias("i"), line.alias("line"))),
            starts_of(F.transform(lines, lambda line: F.length(line) + 1)),
            lambda x, start: F.struct(x["i"].alias("i"), start.alias("start"), x["line"].alias("line")),
        ),
    )


def joined_pages(pages: Column) -> Column:
    """The text of all pages, and where each page starts in it."""
    text = F.array_join(F.transform(pages, lambda p: F.coalesce(p, F.lit(""))), PAGE_BREAK)
    starts = starts_of(F.transform(pages, lambda p: F.length(F.coalesce(p, F.lit(""))) + len(PAGE_BREAK)))
    return F.struct(text.alias("text"), F.when(F.size(pages) > 0, starts).otherwise(F.array(F.lit(0))).alias("starts"))


def page_for_offset(starts: Column, offset: Column) -> Column:
    """The number, from 1, of the last page that starts at or before the offset."""
    return F.greatest(F.size(F.filter(starts, lambda s: s <= offset)), F.lit(1))


def split_at(docs: DataFrame, anchor: str, keep: list[str], text: str = "text") -> DataFrame:
    """Blocks that start at each match of anchor at a line start and run to the next one or the end: keep columns,
    position (from 1), start (code points, from 0) and block.  Text before the first anchor has no row.  Nothing moves:
    each row's blocks and their places come from the row itself."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), rf"(?m)(?=^(?:{anchor}))")
    placed = let(parts, lambda p: F.zip_with(p, starts_of(F.transform(p, lambda b: F.length(b))), lambda block, start: F.struct(start.cast("long").alias("start"), block.alias("block"))))
    opening = F.filter(placed, lambda x: x["block"].rlike(rf"(?m)\A(?:{anchor})"))
    found = docs.select(*keep, F.posexplode(opening).alias("__i", "__b"))
    return found.select(*keep, (F.col("__i") + 1).alias("position"), "__b.start", "__b.block")


#: Phrases that are looked for in each text one by one; phrases, and characters of them, that one automaton holds.
FEW_PHRASES, GROUP_PHRASES, GROUP_CHARS = 500, 100_000, 8_000_000


def holding_any(docs: DataFrame, phrases: DataFrame, key: str, text: str) -> DataFrame:
    """docs plus holds: whether the text has one of the phrases (column phrase; empty ones don't count).

    Texts stay where they are.  Up to FEW_PHRASES distinct phrases are sent along as one row.  More are dealt to groups of
    a bounded size, each an automaton that reads a text once for all its phrases.
    """
    wanted = phrases.where("phrase <> ''").select("phrase").distinct()
    if wanted.limit(FEW_PHRASES + 1).count() <= FEW_PHRASES:
        one = wanted.agg(F.collect_list("phrase").alias("__phrases"))
        return docs.join(F.broadcast(one)).withColumn("holds", F.exists("__phrases", lambda p: F.coalesce(F.contains(F.col(text), p), F.lit(False)))).drop("__phrases")
    wanted = written(wanted, "phrases")
    count, chars = wanted.agg(F.count("*"), F.sum(F.length("phrase"))).first()
    groups = max(-(-count // GROUP_PHRASES), -(-chars // GROUP_CHARS))
    out = docs.withColumn("holds", F.lit(False))
    for group in range(groups):
        found = _finder([r["phrase"] for r in wanted.where(F.pmod(F.xxhash64("phrase"), F.lit(groups)) == group).collect()])
        out = out.withColumn("holds", F.col("holds") | found(F.when(~F.col("holds"), F.col(text))))
    return out


def _finder(phrases: list[str]):
    """Whether a text has one of the phrases, as a function of columns; null has none."""

    @F.pandas_udf(T.BooleanType())
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase in phrases:
            automaton.add_word(phrase)
        automaton.make_automaton()
        for batch in batches:
            yield batch.map(lambda x: x is not None and bool(phrases) and next(automaton.iter(x), None) is not None).astype(bool)

    return find


def boundaries(rows: DataFrame, doc: str, start: str, length: str) -> DataFrame:
    """rows plus end: the start of the document's next row, or its length."""
    return rows.withColumn("end", F.lead(start).over(Window.partitionBy(doc).orderBy(start))).withColumn("end", F.coalesce("end", F.col(length)))


def carried(rows: DataFrame, group: str, order: str, value: Column, name: str) -> DataFrame:
    """rows plus the last value that isn't null at or before each one."""
    frame = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(frame))


def renumbered(rows: DataFrame, group: str, order: str, name: str = "ruling_index") -> DataFrame:
    """Numbers from 1 of the rows that are left."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(order)))


def best_match(rows: DataFrame, group: list[str], score: str, offset: str) -> DataFrame:
    """The row of the highest score of each group; of equal ones the later."""
    others = [c for c in rows.columns if c not in group]
    return rows.groupBy(*group).agg(F.max_by(F.struct(*others), F.struct(score, offset)).alias("__row")).select(*group, "__row.*").select(rows.columns)


def page_slice(pages: Column, start: Column, end: Column) -> Column:
    """Pages start to end (from 1), clamped to those that there are."""
    n = F.size(pages)
    low = F.least(F.greatest(F.coalesce(start, F.lit(1)), F.lit(1)), F.greatest(n, F.lit(1)))
    high = F.least(F.greatest(F.coalesce(end, low), low), F.greatest(n, F.lit(1)))
    return F.slice(pages, low, high - low + 1)


#: Digits that aren't decimal ones, such as those in circles; with decimal digits they make page numbers.
OTHER_DIGITS = "".join(c for c in map(chr, range(0x20000)) if c.isdigit() and not c.isdecimal())


def line_kind(line: Column) -> Column:
    """What makes lines of pages alike: the trimmed line, or that it is a page number such as 1 or - 1 -."""
    text = strip(line)
    plain = F.regexp_replace(F.translate(text, "–—", "--"), r"^[ \t-]+|[ \t-]+\z", "")
    return F.when(plain.rlike(rf"^(?:\p{{Nd}}|[{OTHER_DIGITS}])+\z"), F.lit("\n")).otherwise(text)


def shared_lines(pages: Column) -> Column:
    """(prefix, suffix): how many lines all pages have alike at their starts, and of the lines left, at their ends.
    Fewer than two pages, or an empty one, share none."""
    kinds = F.transform(F.coalesce(pages, F.array().cast("array<string>")), lambda p: F.transform(lines_of(p), line_kind))

    def count(all_pages: Column, most: Column) -> Column:
        first = F.get(all_pages, F.lit(0))
        place = F.when(most > 0, F.sequence(F.lit(0), F.greatest(most, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
        differ = F.filter(place, lambda i: ~F.forall(all_pages, lambda p: F.get(p, i) == F.get(first, i)))
        return F.coalesce(F.get(differ, F.lit(0)), most)

    def both(all_pages: Column) -> Column:
        least = F.when(F.size(all_pages) < 2, F.lit(0)).otherwise(F.array_min(F.transform(all_pages, lambda p: F.size(p))))
        return let(
            F.struct(least.alias("least"), count(all_pages, least).alias("prefix")),
            lambda x: F.struct(x["prefix"].alias("prefix"), count(F.transform(all_pages, lambda p: F.reverse(p)), x["least"] - x["prefix"]).alias("suffix")),
        )

    return let(kinds, both)


def without_shared_lines(pages: Column) -> Column:
    """Pages without the lines that all of them share at their starts and ends."""
    return let(
        shared_lines(pages),
        lambda s: F.transform(pages, lambda p: let(lines_of(p), lambda a: F.array_join(F.slice(a, s["prefix"] + 1, F.size(a) - s["prefix"] - s["suffix"]), "\n"))),
    )


def common_lines(docs: DataFrame, key: str, pages: str = "pages") -> DataFrame:
    """(key, prefix, suffix): how many lines all pages of each document share at their starts and ends."""
    return docs.select(key, shared_lines(F.col(pages)).alias("__s")).select(key, "__s.prefix", "__s.suffix")


def collapse_similar(docs: DataFrame, pages: str = "pages", ratio: float = 0.9) -> DataFrame:
    """docs with each page dropped whose next page is nearly the same (by letters and digits): the last of a run stays."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def keep_last(column: pd.Series) -> pd.Series:
        def one(all_pages):
            kept: list[str] = []
            for page in all_pages if all_pages is not None else []:
                plain = "".join(c for c in (page or "").lower() if c.isascii() and c.isalnum())
                if kept:
                    before = "".join(c for c in kept[-1].lower() if c.isascii() and c.isalnum())
                    match = difflib.SequenceMatcher(None, before, plain, autojunk=False)
                    if before == plain or (match.real_quick_ratio() > ratio and match.quick_ratio() > ratio and match.ratio() > ratio):
                        kept.pop()
                kept.append(page or "")
            return kept

        return column.map(one)

    return docs.withColumn(pages, keep_last(pages))
