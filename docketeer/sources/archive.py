"""Content-addressed files: scans, hash checks, sidecars, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = r"/([0-9a-f]{2})/([0-9a-f]{64})\.([a-z0-9]+)$"


def scan(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("pdf", "docx"), content: bool = True, max_bytes: int | None = 50 * 1024 * 1024) -> DataFrame:
    """Files <two hex>/<sha>.<extension> whose prefix fits their name: sha, extension, path, length and, if wanted, content.

    The length limit is a filter on the file listing, so larger files are never read.
    """
    globbed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(extensions) + "}").load(path)
    named = globbed.where(F.col("length") <= max_bytes) if max_bytes else globbed
    named = named.withColumn("prefix", F.regexp_extract("path", NAME, 1)).withColumn("source_sha256", F.regexp_extract("path", NAME, 2))
    found = named.where((F.col("source_sha256") != "") & (F.col("prefix") == F.left("source_sha256", F.lit(2))))
    return found.select("source_sha256", F.regexp_extract("path", NAME, 3).alias("extension"), "path", "length", *(["content"] if content else []))


def verified(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): whether the content has the hash that the name claims."""
    checked = sources.withColumn("actual_sha256", F.sha2("content", 256))
    same = F.col("actual_sha256") == F.col("source_sha256")
    return checked.where(same).drop("actual_sha256"), checked.where(~same)


def quarantine(bad: DataFrame, path: str) -> None:
    """Append what failed the hash check, with the claimed and the actual hash."""
    bad.select("source_sha256", "actual_sha256", "path", "length", "content").write.mode("append").parquet(path)


def unparsed(sources: DataFrame, rulings: DataFrame) -> DataFrame:
    """Sources that no row names.  Goes before anything that reads content."""
    return sources.join(rulings.select("source_sha256").distinct(), "source_sha256", "left_anti")


def with_sidecars(sources: DataFrame, sidecars: DataFrame) -> DataFrame:
    """A sidecar's content in place of the source's own; identity stays."""
    ocr = sidecars.select("source_sha256", F.col("content").alias("__ocr"))
    return sources.join(ocr, "source_sha256", "left").withColumn("content", F.coalesce("__ocr", "content")).drop("__ocr")


def with_captures(sources: DataFrame, last_captures: DataFrame, county: Column) -> DataFrame:
    """Each source with its last capture, and its own archive address where it has none."""
    joined = sources.join(last_captures, "source_sha256", "left")
    own = F.concat(F.lit("archive://"), county, F.lit("/"), F.col("source_sha256"), F.lit("."), F.col("extension"))
    return joined.withColumn("source_url", F.coalesce(F.nullif("source_url", F.lit("")), own))


def stats(files: DataFrame) -> DataFrame:
    """Files and bytes; content isn't read."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def looks_like(content: Column, extension: str) -> Column:
    """Whether the first bytes are those of the kind of file."""
    head = {"pdf": b"%PDF", "docx": b"PK\x03\x04", "json": b"{"}[extension]
    return F.substring(content, 1, len(head)) == F.lit(bytearray(head))


def extractable_chars(pages: Column) -> Column:
    """Characters of text on all pages, without surrounding blanks."""
    return F.aggregate(F.coalesce(pages, F.array().cast("array<string>")), F.lit(0), lambda n, page: n + F.length(F.trim(F.coalesce(page, F.lit("")))))


def needs_ocr(docs: DataFrame, sidecars: DataFrame, least: int = 40) -> DataFrame:
    """PDF sources with little text and no sidecar."""
    poor = docs.where((F.col("extension") == "pdf") & (extractable_chars(F.col("pages")) < least))
    return poor.join(sidecars.select("source_sha256"), "source_sha256", "left_anti")
