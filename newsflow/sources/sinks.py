"""Writes: JSON lines, article table versions, seen keys, run ledger."""

import datetime as dt
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.times import isoformat, utc
from newsflow.operators.dedupe import new_keys
from newsflow.operators.ordering import with_prior_count
from newsflow.schemas import ARTICLES, RUN_EVENTS, SEEN_KEYS
from newsflow.schemas import schema as schema_of
from newsflow.sources.readers import read_or_empty

RUNNING, SUCCESS, FAILED = "running", "success", "failed"
COMMITS = schema_of("version long")


def append_jsonl(df: DataFrame, path: str, by_source: bool = False) -> None:
    """Append records as JSON lines, nulls written; ``by_source`` splits into one folder per source."""
    writer_df = df.withColumn("_source", F.col("source")) if by_source else df
    writer = writer_df.write.mode("append").option("ignoreNullFields", "false")
    (writer.partitionBy("_source") if by_source else writer).json(path)


def batch_folder(source: str, batch: int) -> str:
    """Folder of one run of one source; sources number their batches independently."""
    return f"run_source={quote(source, safe='')}/batch={batch}"


def write_jsonl_batch(df: DataFrame, path: str, source: str, batch: int) -> None:
    """Records of one run as JSON lines in a folder of their own; writing the batch again replaces it."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{batch_folder(source, batch)}")


def before_run(rows: DataFrame, source: str, batch: int) -> DataFrame:
    """Rows of all runs but this one and later ones of the same source (columns ``run_source``, ``batch``)."""
    own = (F.col("run_source") == source) & (F.col("batch") >= batch)
    return rows.where(~F.coalesce(own, F.lit(False)))


def mark_processed(spark: SparkSession, path: str, df: DataFrame, key: str = "canonical_key") -> None:
    """Add the keys of ``df`` to the seen table; keys already there are not written again."""
    seen = read_or_empty(spark, path, SEEN_KEYS)
    fresh = new_keys(seen, df.withColumnRenamed(key, "canonical_key"))
    fresh.write.mode("append").parquet(path)


class ArticleTable:
    """Article rows under ``path/version=V/run_source=S/batch=B``.

    A run adds one batch folder of its source. Writing a batch again replaces it, so a replayed run or
    micro-batch changes nothing, and sources may share batch numbers. ``rewrite`` stores an upserted table as
    the base of the next version, a folder that no source and batch name, and switches to it; the version
    being read is never touched. The list of versions lies next to the data.
    """

    BASE = ""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = ARTICLES):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._commits = f"{self.path}.versions"

    def version(self) -> int:
        versions = read_or_empty(self.spark, self._commits, COMMITS, "json")
        return versions.agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first().v

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def read(self, before: tuple[str, int] | None = None) -> DataFrame:
        """Current rows; ``before=(source, batch)`` leaves out that batch and later ones of the same source."""
        folder = [T.StructField("run_source", T.StringType()), T.StructField("batch", T.LongType())]
        rows = read_or_empty(self.spark, self._folder(self.version()), T.StructType([*self.schema.fields, *folder]))
        if before is not None:
            rows = before_run(rows, *before)
        return rows.drop("run_source", "batch")

    def append(self, rows: DataFrame, source: str, batch: int) -> None:
        """Write one batch of a source: rows with new keys."""
        if source == self.BASE or batch < 0:
            raise ValueError("a run needs a source and a batch number from 0")
        self._write(rows, f"{self._folder(self.version())}/{batch_folder(source, batch)}")

    def write_run(self, rows: DataFrame, source: str, batch: int) -> None:
        """Append the rows of a run, all with new keys, and number them in ``pos`` order after the ids before it."""
        top = F.coalesce(self.read(before=(source, batch)).agg(F.max("id")).scalar(), F.lit(0))
        numbered = with_prior_count(rows, "pos", out="_rank")
        self.append(numbered.withColumn("id", top + F.col("_rank") + 1), source, batch)

    def _write(self, rows: DataFrame, folder: str) -> None:
        columns = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        columns.write.mode("overwrite").parquet(folder)

    def rewrite(self, rows: DataFrame) -> int:
        """Store ``rows`` as the base of the next version and make it current."""
        following = self.version() + 1
        self._write(rows, f"{self._folder(following)}/run_source=__HIVE_DEFAULT_PARTITION__/batch=-1")
        commit = self.spark.range(1).select(F.lit(following).cast("long").alias("version"))
        commit.write.mode("append").json(self._commits)
        return following


def run_event(
    spark: SparkSession,
    run_id: str,
    source: str,
    ts: dt.datetime,
    status: str,
    items_processed: int = 0,
    errors: int = 0,
) -> DataFrame:
    return spark.createDataFrame([(run_id, source, utc(ts), status, items_processed, errors)], RUN_EVENTS)


def start_run(spark: SparkSession, path: str, run_id: str, source: str, ts: dt.datetime) -> None:
    """Ledger row of a run that began."""
    run_event(spark, run_id, source, ts, RUNNING).write.mode("append").parquet(path)


def finish_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    source: str,
    ts: dt.datetime,
    status: str,
    items_processed: int,
    errors: int,
) -> None:
    """Ledger row of a run that ended, as success or failed."""
    event = run_event(spark, run_id, source, ts, status, items_processed, errors)
    event.write.mode("append").parquet(path)


def current_runs(events: DataFrame) -> DataFrame:
    """State of each run from its ledger rows: start, end, last status and counters.

    A run that ended shows its last end, also while it is tried again; of ends at the same time success counts.
    """
    ended = F.col("status") != RUNNING
    order = F.struct(ended.alias("ended"), "event_ts", (F.col("status") == SUCCESS).alias("well"))
    last = F.max_by(F.struct("status", "items_processed", "errors"), order)
    runs = events.groupBy("run_id", "source").agg(
        F.min("event_ts").alias("_started"),
        F.max(F.when(ended, F.col("event_ts"))).alias("_completed"),
        last.alias("_last"),
    )
    return runs.select(
        "run_id",
        "source",
        isoformat(F.col("_started")).alias("started_at"),
        isoformat(F.col("_completed")).alias("completed_at"),
        "_last.status",
        "_last.items_processed",
        "_last.errors",
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return current_runs(read_or_empty(spark, path, RUN_EVENTS))
