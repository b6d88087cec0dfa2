"""Array expressions: running values inside a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketeer.functions.text import let

#: Values that are combined one after the other; the results of such chunks are combined in turn.
CHUNK = 256


def scan(values: Column, zero: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each value what combine makes of all values before it; zero before the first.

    combine takes two values of one kind, in any grouping.  Arrays are copied as they grow, so they grow by chunks: a row
    of n values costs n * CHUNK + (n / CHUNK) ** 2 copies.
    """
    start = F.array(zero)
    grow = lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), x)))
    size = F.size(values)
    firsts = F.when(size > 0, F.sequence(F.lit(1), F.greatest(size, F.lit(1)), F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
    chunks = F.transform(firsts, lambda at: F.aggregate(F.slice(values, at, F.lit(CHUNK)), start, grow))  # each ends with its whole
    return let(
        chunks,
        lambda parts: let(
            F.aggregate(parts, start, lambda acc, part: grow(acc, F.element_at(part, -1))),
            lambda bases: F.flatten(F.transform(parts, lambda part, k: F.transform(F.slice(part, F.lit(1), F.size(part) - 1), lambda x: combine(x, F.get(bases, k))))),
        ),
    )
