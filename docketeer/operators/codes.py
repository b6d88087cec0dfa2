"""Short codes of names, no two alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketeer.sources.shared import written

#: Rounds after which names count as stuck.
MAX_ROUNDS = 1000
#: What a name without letters starts its codes with.
NO_LETTERS = "CTY"


def label(slug: Column) -> Column:
    """county-of-x as County Of X."""
    return F.array_join(F.transform(F.split(slug, "-"), lambda part: F.concat(F.upper(F.left(part, F.lit(1))), F.lower(F.substring(part, 2, 1 << 30)))), " ")


def unique_codes(slugs: DataFrame, slug: str = "slug") -> DataFrame:
    """(slug, code): what each different slug gets if they choose in order, each the first code that is still free.

    A slug's codes are the first letters of its parts if there are two or more, the first three to six of all its
    letters, then the first three (or as many as there are) with 2, 3 and so on behind them, where those alone are taken.

    All choose at once instead: of those that want a code the first in order has it, the others want their next one, and
    so on until nobody loses.  As the first in order has priority for every code, that ends as choosing in order does.
    Slugs that have come to their numbered codes take, to begin with, as high a number as there are such slugs of the
    same letters before them, which they would lose to; so many slugs of the same letters take few rounds.
    Null slugs have no code.
    """
    name = slugs.select(F.col(slug).alias("slug")).where("slug IS NOT NULL").distinct()
    letters = F.regexp_replace(F.upper("slug"), r"[^\p{L}]", "")
    initials = F.upper(F.array_join(F.transform(F.split("slug", "-"), lambda part: F.left(part, F.lit(1))), ""))
    widths = F.filter(F.array(*map(F.lit, range(3, 7))), lambda n: n <= F.length("letters"))
    wanted = F.concat(F.when(F.length("initials") >= 2, F.array("initials")).otherwise(F.array().cast("array<string>")), F.transform(widths, lambda n: F.left("letters", n)))
    parts = name.select("slug", letters.alias("letters"), initials.alias("initials"))
    # at: which code a slug wants now; tried: whether the letters alone are among the codes before the numbered ones
    state = written(parts.select("slug", wanted.alias("wanted"), F.when(F.col("letters") == "", NO_LETTERS).otherwise(F.left("letters", F.lit(3))).alias("base"), (F.length("letters") >= 3).cast("int").alias("tried"), F.lit(0).alias("at")), "codes")
    for _ in range(MAX_ROUNDS):
        late = F.col("at") >= F.size("wanted")
        before = F.row_number().over(Window.partitionBy("base").orderBy("slug")) - 1
        numbered = state.where(late).withColumn("at", F.greatest(F.col("at"), F.size("wanted") + before))
        number = F.col("at") - F.size("wanted") + F.col("tried") + 1
        code = F.when(F.col("at") < F.size("wanted"), F.get("wanted", F.col("at"))).when(number == 1, F.col("base")).otherwise(F.concat("base", number))
        asked = written(state.where(~late).unionByName(numbered).withColumn("code", code), "codes")
        first = written(asked.groupBy("code").agg(F.min("slug").alias("__first")), "first")
        state = written(asked.join(first, "code").select("slug", "wanted", "base", "tried", (F.col("at") + (F.col("slug") != F.col("__first")).cast("int")).alias("at"), "code", (F.col("slug") != F.col("__first")).alias("lost")), "codes")
        if state.where("lost").isEmpty():
            return state.select(F.col("slug").alias(slug), "code")
        state = state.drop("code", "lost")
    raise RuntimeError(f"codes did not settle in {MAX_ROUNDS} rounds")
