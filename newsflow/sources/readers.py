"""Scans of landed data: JSON lines, feeds, id lists, items, pages, seen keys, tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators.skew import lookup_join
from newsflow.schemas import LANDED_PAGE, SEEN_FILE, SEEN_KEYS, STORY_ITEM
from newsflow.schemas import schema as schema_of
from newsflow.sources.landing import bucket_column

CORRUPT = "_corrupt_record"


def _is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, or no rows if nothing was written there yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if _is_missing_path(error):
            return spark.createDataFrame([], schema)
        raise


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, quarantine: bool = False) -> DataFrame:
    """One JSON object per non-blank line.

    A bad line fails the read, or with ``quarantine`` becomes a row with its text in
    ``_corrupt_record``. A missing file is an error.
    """
    if quarantine:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    # folder names such as batch=3 are not part of the record
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).select(schema.fieldNames())


def read_jsonl_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records written batch by batch, with their ``run_source`` and ``batch``; none if nothing was written yet."""
    folder = [T.StructField("run_source", T.StringType()), T.StructField("batch", T.LongType())]
    return read_or_empty(spark, path, T.StructType([*schema.fields, *folder]), "json")


def with_positions(df: DataFrame, name: str = "pos") -> DataFrame:
    """Number the rows in scan order (increasing, with gaps); meant for one file, straight after the scan."""
    return df.withColumn(name, F.monotonically_increasing_id())


def read_feed(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Feed entries in feed order, plus ``_corrupt_record``.

    A malformed entry keeps its text in ``_corrupt_record`` and the others survive; see
    ``usable_entries``. ``feed_pos`` follows the order within one file: land one file per feed run, or
    carry a landed position column.
    """
    schema = schema_of(f"title string, link string, pubDate string, {CORRUPT} string")
    scanned = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(schema)
        .load(path)
    )
    return scanned.select(
        F.monotonically_increasing_id().alias("feed_pos"),
        "title",
        "link",
        F.col("pubDate").alias("published"),
        CORRUPT,
    )


def usable_entries(feed: DataFrame) -> DataFrame:
    """Entries that parsed and have a link."""
    return feed.where(F.col(CORRUPT).isNull() & F.col("link").isNotNull()).drop(CORRUPT)


def malformed_entries(feed: DataFrame) -> DataFrame:
    """Entries that did not parse, for the warning."""
    return feed.where(F.col(CORRUPT).isNotNull())


def ranked_ids(df: DataFrame, limit: int, ids: str | Column = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(rank, id)`` of the first ``limit`` ids of each list; a missing list has none."""
    column = F.col(ids) if isinstance(ids, str) else ids
    cut = F.slice(column, 1, limit)
    return df.select(*keep, F.posexplode(cut).alias("rank", "id"))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Story items, one JSON object per line; a ``null`` line or a bad line is no item.

    An id may have landed more than once; ``landed_at`` is the time of its file.
    """
    scanned = read_jsonl(spark, path, STORY_ITEM, quarantine=True)
    timed = scanned.withColumn("landed_at", F.col("_metadata.file_modification_time"))
    return timed.where(F.col("id").isNotNull()).drop(CORRUPT)


def with_items(ranked: DataFrame, items: DataFrame, spread: str = "pos", **kw) -> DataFrame:
    """Add ``item`` (struct, null if there is none) to each ranked id; ``items`` has one row per id."""
    fields = [F.col(c) for c in items.columns if c != "id"]
    looked_up = items.select("id", F.struct(*fields).alias("item"))
    return lookup_join(ranked, looked_up, "id", spread, **kw)


def landed_pages(df: DataFrame) -> DataFrame:
    """``(url, html, http_status)``, and ``landed_at`` and the bucket if they are there. A landing without status counts as 200 if
    it has a body, else 0."""
    if "http_status" not in df.columns:
        has_body = F.coalesce(F.col("html"), F.lit("")) != ""
        df = df.withColumn("http_status", F.when(has_body, 200).otherwise(0))
    landed_at = [F.col("landed_at").cast("timestamp")] if "landed_at" in df.columns else []
    bucket = [c for c in [bucket_column(df)] if c]
    return df.select(*[F.col(f.name).cast(f.dataType) for f in LANDED_PAGE], *landed_at, *bucket)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages. A URL may have landed more than once; without a ``landed_at`` the time of its file counts."""
    landed = spark.read.parquet(path)
    if "landed_at" not in landed.columns:
        landed = landed.withColumn("landed_at", F.col("_metadata.file_modification_time"))
    return landed_pages(landed)


def newest_pages(pages: DataFrame, landed_at: str) -> DataFrame:
    """One row per URL, the one landed last; copies are folded map-side."""
    columns = [f.name for f in LANDED_PAGE if f.name != "url"]
    newest = pages.groupBy("url").agg(F.max_by(F.struct(*columns), landed_at).alias("_p"))
    return newest.select("url", "_p.*")


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """Seen keys from ``{"hashes": [...]}`` JSON, any number of objects. Absent means none; a corrupt file
    is an error, because silently starting over would process everything again. One object is read by one
    task, so keep large sets in the table that ``mark_processed`` writes."""
    try:
        scanned = spark.read.schema(SEEN_FILE).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if _is_missing_path(error):
            return spark.createDataFrame([], SEEN_KEYS)
        raise
    return scanned.select(F.explode("hashes").alias("canonical_key")).distinct()


def list_tables(spark: SparkSession) -> DataFrame:
    """Names of the tables and views the session knows."""
    return spark.sql("SHOW TABLES").select("tableName", "isTemporary")
