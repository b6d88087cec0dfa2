"""Newline-delimited JSON logs.

Log order is batch, file, line.  Spark deals files out by size, so that its own row numbers don't give that order;
`line_no` carries it as (batch, file, block, row): the number of the append (0 for a file that no append wrote), the
file's path, where its block starts in it, and the row's place among those of the block.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from docketeer.sources import files

CORRUPT = "_corrupt"
#: The folders that appends write, in order.
_BATCH = "batch-{:012d}"


def _parsed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """line_no, the line as it is, and what it says (_corrupt is null if it parses)."""
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    place = F.struct(
        F.coalesce(F.nullif(F.regexp_extract("_metadata.file_path", "/batch-([0-9]{12})/[^/]*$", 1), F.lit("")).cast("long"), F.lit(0)).alias("batch"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    whole = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = whole.select(place.alias("line_no"), "value").where(F.trim("value") != "")
    return lines.withColumn("row", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All lines that parse, with line_no; keys that the schema lacks are left out, missing ones are null."""
    good = _parsed(spark, path, schema).where(F.col("row").isNotNull() & F.col(f"row.{CORRUPT}").isNull())
    return good.select(*(F.col(f"row.{f}").alias(f) for f in schema.names), "line_no")


def malformed(spark: SparkSession, path: str, schema: StructType, samples: int = 3) -> DataFrame:
    """One row: how many lines don't parse, and the first few of them."""
    bad = _parsed(spark, path, schema).where(F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull()).select("line_no", "value")
    first = bad.orderBy("line_no").limit(samples).agg(F.sort_array(F.collect_list(F.struct("line_no", "value"))).alias("s"))
    return bad.agg(F.count("*").alias("lines")).join(first).select("lines", F.transform("s", lambda x: x["value"]).alias("samples"))


def last_by(rows: DataFrame, *keys: str, order: str = "line_no") -> DataFrame:
    """The last line of each key.  Aggregates before the shuffle: only keys and candidate rows move."""
    others = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("__row"))
    return best.select(*keys, "__row.*").select(rows.columns)


def first_by(rows: DataFrame, *keys: str, order: str = "line_no") -> DataFrame:
    """The first line of each key."""
    others = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(order)).alias("__row"))
    return best.select(*keys, "__row.*").select(rows.columns)


def limit_by(rows: DataFrame, n: int, *keys: str, order: str = "line_no") -> DataFrame:
    """The first n rows of each key."""
    place = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("__n", F.row_number().over(place)).where(F.col("__n") <= n).drop("__n")


def append_log(rows: DataFrame, path: str) -> None:
    """Append rows as JSON lines, columns in order of name, after all lines that are there.  One writer at a time."""
    spark = rows.sparkSession
    last = max((int(name[6:]) for name in files.folders(spark, path) if re.fullmatch("batch-[0-9]{12}", name)), default=0)
    rows.select(sorted(rows.columns)).write.json(f"{path.rstrip('/')}/{_BATCH.format(last + 1)}")


def rewrite_if_changed(rows: DataFrame, path: str, schema: StructType, *keys: str) -> bool:
    """Make the log at path hold exactly rows, in order of keys, in one batch; whether anything was written.  Rows are
    compared as a whole first, so that an unchanged log keeps its files.  One writer at a time."""
    spark, wanted = rows.sparkSession, rows.select(*schema.names)
    marks = [F.count("*"), *(F.sum(F.xxhash64(*schema.names, F.lit(k)).cast("decimal(38,0)")) for k in (0, 1))]
    there = files.exists(spark, path)
    before = read_log(spark, path, schema).select(*schema.names).agg(*marks).first() if there else (0, None, None)
    if tuple(before) == tuple(wanted.agg(*marks).first()):
        return False
    aside = files.beside(path, "new")
    wanted.orderBy(*keys).write.json(f"{aside}/{_BATCH.format(1)}")
    files.put_in_place(spark, aside, path)
    return True


def merge_logs(base: DataFrame, upstream: DataFrame, local: DataFrame) -> DataFrame:
    """A three-way merge of append-only logs that keeps repeated lines: of each line as many as the fuller side has,
    at least those of the base."""
    columns = base.columns
    sides = [d.select(columns).withColumn("__side", F.lit(i)) for i, d in enumerate((base, upstream, local))]
    counts = sides[0].union(sides[1]).union(sides[2]).groupBy(*columns).agg(*(F.count_if(F.col("__side") == i).alias(f"__{i}") for i in range(3)))
    return counts.withColumn("__n", F.greatest("__0", "__1", "__2")).select(*columns, F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias("__k")).drop("__k")
