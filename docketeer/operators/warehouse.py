"""The ruling tables: summaries, merging, sharded writing, digests, audits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketeer.functions.text import blank, clip, first_filled, strip
from docketeer.sources import files

# The index's columns in their order, and the limits of its labels and excerpts.
SUMMARY_COLUMNS = (
    "ruling_id", "county", "division", "dept", "judge", "judge_name",
    "hearing_date", "ruling_index", "case_number", "case_title", "motion_type",
    "outcome", "conditional", "continued_to", "page_start", "page_end",
    "source_url", "ingest_ts", "status", "previous_version_id",
)
TITLE_LIMIT, MOTION_LIMIT, OUTCOME_EXCERPT, OPENING_EXCERPT = 512, 256, 600, 300
PENDING = r"(?is)calendar\s+notes\s+are\s+not\s+yet\s+available.*check\s+back\s+for\s+updated\s+notes"
SHARD_LIMIT, SHARD_SHARE = 90 * 1024 * 1024, 0.8


def status_of(status: Column, outcome_text: Column, body_text: Column, full_text: Column) -> Column:
    return F.when((blank(status) == "pending") | first_filled(outcome_text, body_text, full_text).rlike(PENDING), "pending").otherwise("published")


def short_label(c: Column, limit: int) -> Column:
    """Labels over the limit are blanked rather than cut."""
    return F.when(F.length(c) > limit, "").otherwise(c)


def summary(rulings: DataFrame) -> DataFrame:
    """Listed columns only, so that new ones can't leak; excerpts for published rows."""
    have = rulings.columns
    text = {c: F.col(c) if c in have else F.lit(None).cast("string") for c in ("status", "outcome_text", "body_text", "full_text")}
    base = rulings.withColumn("status", status_of(*text.values()))
    if "case_title" in have:
        base = base.withColumn("case_title", short_label(F.col("case_title"), TITLE_LIMIT))
    if "motion_type" in have:
        base = base.withColumn("motion_type", short_label(F.col("motion_type"), MOTION_LIMIT))
    shown = F.col("status") == "published"
    outcome = F.when(shown, F.nullif(clip(text["outcome_text"], OUTCOME_EXCERPT), F.lit("")))
    opening = F.when(shown, F.nullif(clip(first_filled(text["body_text"], text["full_text"]), OPENING_EXCERPT), F.lit("")))
    return base.select(*(c for c in SUMMARY_COLUMNS if c in have or c == "status"), outcome.alias("outcome_text"), opening.alias("body_text"))


def details(rulings: DataFrame) -> DataFrame:
    """One record of each id.  Ids with different records are an error, raised when the plan runs."""
    columns = ["county", "case_title", "motion_type", "outcome_text", "body_text", "full_text"]
    record = F.struct(*(blank(F.col(c)).alias(c) for c in columns))
    per = rulings.groupBy("ruling_id").agg(F.min(record).alias("r"), F.max(record).alias("s"))
    same = F.when(F.col("r") == F.col("s"), F.col("r")).otherwise(F.raise_error(F.concat(F.lit("different records of ruling "), F.col("ruling_id"))))
    return per.select("ruling_id", same.alias("r")).select("ruling_id", "r.*")


def merged(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables' rows: columns in the order first seen, missing ones null; the existing type wins, but a column
    that was always null takes the new type."""
    old_types = dict(existing.dtypes)
    cast = [F.col(c).try_cast(old_types[c]).alias(c) if c in old_types and old_types[c] != "void" and t != old_types[c] else F.col(c) for c, t in new.dtypes]
    return existing.unionByName(new.select(*cast), allowMissingColumns=True)


def write_sharded(df: DataFrame, path: str, order: list[str], sample_bytes_per_row: float, limit: int = SHARD_LIMIT) -> None:
    """Ordered Parquet files of at most limit bytes, by the bytes a row that an earlier write or a sample showed.

    They are written beside the old table, measured, written again with fewer rows where one is over the limit (a
    single row may be), and renamed into its place when whole: the old table stays until then.
    """
    spark = df.sparkSession
    files.recover(spark, path)
    rows, aside = max(1, int(limit * SHARD_SHARE / max(1.0, sample_bytes_per_row))), files.beside(path, "new")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    while True:
        ordered.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "9").option("maxRecordsPerFile", rows).parquet(aside)
        largest = max(files.sizes(spark, aside, ".parquet").values(), default=0)
        if largest <= limit or rows == 1:
            break
        rows = max(1, min(rows // 2, int(rows * SHARD_SHARE * limit / largest)))
    files.put_in_place(spark, aside, path)


def bytes_per_row(spark: SparkSession, path: str) -> float:
    """Of a written table."""
    size = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).agg(F.sum("length")).first()[0] or 0
    return size / max(1, spark.read.parquet(path).count())


def shards_needed(total_bytes: float, limit: int = SHARD_LIMIT) -> int:
    return max(1, math.ceil(total_bytes / (limit * SHARD_SHARE)))


def dataset_digest(listed: DataFrame) -> DataFrame:
    """listed files (name, sha256) to one digest: the hash itself for one file, else that of the sorted lines."""
    lines = F.array_sort(F.collect_list(F.concat("name", F.lit(" "), "sha256", F.lit("\n"))))
    return listed.agg(F.when(F.count("*") == 1, F.min("sha256")).otherwise(F.sha2(F.array_join(lines, ""), 256)).alias("digest"))


def stale_outputs(manifest: DataFrame, outputs: DataFrame) -> DataFrame:
    """Paths that one side lacks or that differ in bytes or hash."""
    m = manifest.select("path", F.col("bytes").alias("m_bytes"), F.col("sha256").alias("m_sha"))
    both = m.join(outputs.select("path", "bytes", "sha256"), "path", "full_outer")
    reason = F.when(F.col("bytes").isNull(), "missing").when(F.col("m_bytes").isNull(), "unlisted").when(F.col("bytes") != F.col("m_bytes"), "bytes").when(F.col("sha256") != F.col("m_sha"), "hash")
    return both.select("path", reason.alias("reason")).where("reason is not null")


def slice_plan(rulings: DataFrame, slices: DataFrame, sources: DataFrame) -> DataFrame:
    """rulings plus plan: what is to be done for each one's own PDF file.

    slices (ruling_id): those that are there, which are skipped.  sources (source_sha256, extension).  Pages are cut from
    a PDF source if the ruling has page numbers (else the plan is missing); all other rulings are set as text.  Rows
    without an id or a source have none.
    """
    there = slices.select("ruling_id").distinct().withColumn("__there", F.lit(True))
    pdf = sources.where("extension = 'pdf'").select("source_sha256").distinct().withColumn("__pdf", F.lit(True))
    filled = lambda c: blank(F.col(c)) != ""
    pages = (F.coalesce("page_start", F.lit(0)) != 0) & (F.coalesce("page_end", F.lit(0)) != 0)
    plan = F.when(~filled("ruling_id") | ~filled("source_sha256"), None).when(F.col("__there"), "skip").when(F.col("__pdf").isNull(), "text").when(pages, "slice").otherwise("missing")
    return rulings.join(there, "ruling_id", "left").join(pdf, "source_sha256", "left").withColumn("plan", plan).select(*rulings.columns, "plan")


VIEW_VERSION = 4


def publish(rulings: DataFrame, path: str, source_digest: str) -> None:
    """The viewer's files: detail records in folders by the id's first two letters, then the index, last the manifest
    with their names and bytes.  Each is put in place when whole, so that a reader never finds a manifest without them."""
    spark = rulings.sparkSession
    records = details(rulings).select(F.left("ruling_id", F.lit(2)).alias("prefix"), "*")
    for name, rows, parts in (("ruling-text", records, ["prefix"]), ("summary", summary(rulings), [])):
        aside = files.beside(f"{path}/{name}", "new")
        (rows.repartition("prefix") if parts else rows).write.partitionBy(*parts).json(aside)
        files.put_in_place(spark, aside, f"{path}/{name}")
    manifest = F.struct(F.lit(VIEW_VERSION).alias("version"), F.lit(source_digest).alias("source_sha256"))
    aside = files.beside(f"{path}/_viewer", "new")
    _outputs(spark, path).select(manifest.alias("m"), "path", "bytes").select("m.*", "path", "bytes").coalesce(1).write.json(aside)
    files.put_in_place(spark, aside, f"{path}/_viewer")


def _outputs(spark: SparkSession, path: str) -> DataFrame:
    """path (below the folder) and bytes of the written details and index."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load([f"{path}/ruling-text", f"{path}/summary"])
    return read.select(F.regexp_extract("path", "/((?:ruling-text|summary)/.*)$", 1).alias("path"), F.col("length").alias("bytes"))


def published(spark: SparkSession, path: str, source_digest: str) -> bool:
    """Whether the viewer's files are there, whole, and made of this source."""
    if not all(files.exists(spark, f"{path}/{name}") for name in ("ruling-text", "summary", "_viewer")):
        return False
    listed = spark.read.schema("version int, source_sha256 string, path string, bytes long").json(f"{path}/_viewer")
    stale = listed.where((F.col("version") != VIEW_VERSION) | (F.col("source_sha256") != source_digest))
    both = listed.select("path", F.col("bytes").alias("listed")).join(_outputs(spark, path), "path", "full_outer")
    return stale.isEmpty() and both.where(~F.col("listed").eqNullSafe(F.col("bytes"))).isEmpty()


def live_stats(rulings: DataFrame) -> DataFrame:
    source = F.nullif(blank(F.col("source_sha256")), F.lit(""))
    return rulings.agg(F.count("*").alias("rulings"), F.countDistinct("county").alias("counties"), F.countDistinct(source).alias("sources"), F.min("hearing_date").alias("first_date"), F.max("hearing_date").alias("last_date"))


def live_block(stats: dict, updated: str) -> str:
    """The Markdown table of one row of live_stats()."""
    rows = [("Parsed rulings", f"{stats['rulings']:,}"), ("Counties", f"{stats['counties']:,}"), ("Source documents", f"{stats['sources']:,}"), ("Hearing dates", f"{stats['first_date']} to {stats['last_date']}"), ("Updated", updated)]
    return "\n".join(["| Metric | Value |", "|---|---|", *(f"| {name} | {value} |" for name, value in rows)])


def replace_block(document: str, block: str, start: str = "<!-- LIVE:START -->", end: str = "<!-- LIVE:END -->") -> str:
    head, mark, rest = document.partition(start)
    _, close, tail = rest.partition(end)
    if not mark or not close:
        raise ValueError("the document lacks its markers")
    return f"{head}{start}\n{block}\n{end}{tail}"


def bad_spans(rulings: DataFrame) -> DataFrame:
    return rulings.where("page_start < 1 or page_end < page_start")


def audit(rulings: DataFrame, short: int = 40) -> DataFrame:
    """Counts of what looks wrong, by county."""
    dup_ids = rulings.groupBy("county", "ruling_id").count().where("count > 1").groupBy("county").agg(F.sum("count").alias("dup_id_rows"))
    main = rulings.groupBy("county").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("source_sha256").alias("n_sources"),
        F.min("hearing_date").alias("first_date"),
        F.max("hearing_date").alias("last_date"),
        F.count_if(blank(F.col("body_text")) == "").alias("blank_body"),
        F.count_if(F.length("body_text") < short).alias("short_body"),
        F.count_if(~blank(F.col("source_url")).rlike("^(?:https?|archive)://")).alias("bad_url"),
    )
    return main.join(dup_ids, "county", "left").withColumn("dup_id_rows", F.coalesce("dup_id_rows", F.lit(0)))


#: What makes a text look broken: replacement characters, glyph numbers of PDF fonts, control characters.
ARTIFACTS = r"\x{FFFD}|\(cid:[0-9]+\)|[\x00-\x08\x0E-\x1F]"


def full_audit(rulings: DataFrame, slices: DataFrame, short: int = 20) -> DataFrame:
    """Everything that is counted of each county: rows, sources, dates, blank columns, short and broken texts, ids and
    places inside a source that occur twice, addresses that aren't of the web, rulings without a slice.

    slices: ruling_id.  Repeats are summed before they are joined, one row a county."""
    text = lambda c: strip(F.col(c))

    def doubled(*key: str, name: str) -> DataFrame:
        return rulings.groupBy("county", *key).count().where("count > 1").groupBy("county").agg(F.sum("count").alias(name))

    there = slices.select("ruling_id").where("ruling_id IS NOT NULL").distinct().withColumn("__there", F.lit(True))
    main = rulings.join(there, "ruling_id", "left").groupBy("county").agg(
        F.count("*").alias("n_rows"), F.countDistinct("source_sha256").alias("n_sources"), F.min("hearing_date").alias("first_date"), F.max("hearing_date").alias("last_date"),
        F.count_if(F.col("hearing_date") < F.lit("2010-01-01").cast("date")).alias("before_2010"),
        *(F.count_if(text(c) == "").alias(f"blank_{c}") for c in ("division", "dept", "motion_type", "outcome_text", "body_text", "case_title")),
        F.count_if(F.length(text("body_text")) < short).alias("short_body_text"),
        F.count_if(F.concat_ws(" ", "case_title", "body_text").rlike(ARTIFACTS)).alias("artifacts"),
        F.count_if(~blank(F.col("source_url")).rlike("^https?://")).alias("bad_url"),
        F.count_if(F.col("__there").isNull()).alias("missing_slices"),
    )
    for found in (doubled("ruling_id", name="doubled_ids"), doubled("source_sha256", "ruling_index", name="doubled_places")):
        name = found.columns[1]
        one = found.withColumnRenamed("county", "__county")
        main = main.join(one, F.col("county").eqNullSafe(F.col("__county")), "left").drop("__county").withColumn(name, F.coalesce(name, F.lit(0)))
    return main
