"""Stretches of text: cutting spans out, and where places lie afterwards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketeer.functions.arrays import scan
from docketeer.functions.text import SPACE, blank, let, strip


def gaps(spans: Column, size: Column) -> Column:
    """The stretches (start, end) of 0 to size that no span covers, in order; spans may overlap and come in any order."""

    def between(ordered: Column) -> Column:
        covered = scan(F.transform(ordered, lambda s: s["end"]), F.lit(0), lambda a, b: F.greatest(a, b))
        inner = F.zip_with(covered, ordered, lambda before, s: F.struct(before.alias("start"), F.least(s["start"], size).alias("end")))
        last = F.struct(F.greatest(F.coalesce(F.array_max(F.transform(ordered, lambda s: s["end"])), F.lit(0)), F.lit(0)).alias("start"), size.alias("end"))
        return F.filter(F.concat(inner, F.array(last)), lambda g: g["start"] < g["end"])

    whole = F.transform(spans, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))
    return let(F.array_sort(F.coalesce(whole, F.array().cast("array<struct<start:int,end:int>>"))), between)


def without_spans(text: Column, spans: Column) -> Column:
    """(text, kept_end, pieces) of text without spans (start, end; end exclusive).

    What is left between spans is joined by line ends, without line ends of its own at its ends; blank stretches go.
    kept_end is where in the whole text the last stretch ends that stays; the text's end counts without white space.
    pieces has (start, end, at) for each stretch: its place in the whole text, and where it begins in what is left.
    Without spans the text stays as it is.  Null counts as empty."""
    whole = blank(text)
    filled = F.length(F.regexp_replace(whole, rf"{SPACE}+\z", ""))
    size = F.length(whole)

    def piece(g: Column) -> Column:
        part = F.substring(whole, g["start"] + 1, g["end"] - g["start"])
        lead = F.length(part) - F.length(F.regexp_replace(part, r"^\n+", ""))
        body = F.regexp_replace(part, r"^\n+|\n+\z", "")
        return F.struct((g["start"] + lead).alias("start"), body.alias("body"), g["end"].alias("end"), (strip(part) != "").alias("filled"))

    def joined(pieces: Column) -> Column:
        places = F.zip_with(pieces, scan(F.transform(pieces, lambda p: F.length(p["body"]) + 1), F.lit(0), lambda a, b: a + b), lambda p, at: F.struct(p["start"].alias("start"), (p["start"] + F.length(p["body"])).alias("end"), at.alias("at")))
        end = F.coalesce(F.try_element_at(pieces, F.lit(-1))["end"], F.lit(0))
        return F.struct(F.array_join(F.transform(pieces, lambda p: p["body"]), "\n").alias("text"), F.when(end == size, filled).otherwise(end).alias("kept_end"), places.alias("pieces"))

    untouched = F.struct(whole.alias("text"), filled.alias("kept_end"), F.when(size > 0, F.array(F.struct(F.lit(0).alias("start"), size.alias("end"), F.lit(0).alias("at")))).otherwise(F.array().cast("array<struct<start:int,end:int,at:int>>")).alias("pieces"))
    cut = let(F.filter(F.transform(gaps(spans, size), piece), lambda p: p["filled"]), joined)
    return F.when(F.coalesce(F.size(spans), F.lit(0)) < 1, untouched).otherwise(cut)


def place_after(pieces: Column, place: Column) -> Column:
    """Where a place of the whole text lies in what without_spans() leaves; null where it went."""
    inside = F.filter(pieces, lambda p: (p["start"] <= place) & (place < p["end"]))
    return let(F.get(inside, F.lit(0)), lambda p: p["at"] + place - p["start"])
