"""Incremental runs over newly landed files.

The set of known keys lives in the article table, so nothing expires and no streaming state is kept.
A micro-batch may be delivered again: it reads only earlier batches and rewrites its own batch folder
and ledger rows, so a replay changes nothing.
"""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from newsflow.constants import SOURCE_FEED, SOURCE_RANKED
from newsflow.plans.feed import feed_records, feed_walk
from newsflow.plans.flow import save_run
from newsflow.plans.ranked import ranked_records, ranked_walk
from newsflow.sources.keyed import KeyedArticles
from newsflow.sources.sinks import ArticleTable

BatchWriter = Callable[[DataFrame, int], None]


def feed_batches(
    table: ArticleTable | KeyedArticles,
    ledger: str,
    pages: DataFrame,
    run_ts: dt.datetime,
    limit: int | None = None,
    source: str = SOURCE_FEED,
    first_batch: int = 0,
    analysis: dict | None = None,
    **options,
) -> BatchWriter:
    """Writer that runs each micro-batch of feed entries through the feed source."""

    def write(entries: DataFrame, batch_id: int) -> None:
        def run(seen):
            return feed_walk(entries, pages, seen, run_ts, limit, source=source, **options)

        def records(done):
            return feed_records(done, run_ts, **(analysis or {}))

        save_run(entries.sparkSession, run, records, table, ledger, source, first_batch + batch_id, run_ts)

    return write


def ranked_batches(
    table: ArticleTable | KeyedArticles,
    ledger: str,
    items: DataFrame,
    pages: DataFrame,
    run_ts: dt.datetime,
    limit: int | None = None,
    source: str = SOURCE_RANKED,
    first_batch: int = 0,
    analysis: dict | None = None,
    **options,
) -> BatchWriter:
    """Writer that runs each micro-batch of ranked ids ``(pos, id)`` through the ranked source."""

    def write(ranked: DataFrame, batch_id: int) -> None:
        def run(seen):
            return ranked_walk(ranked, items, pages, seen, run_ts, limit, source=source, **options)

        def records(done):
            return ranked_records(done, run_ts, **(analysis or {}))

        save_run(ranked.sparkSession, run, records, table, ledger, source, first_batch + batch_id, run_ts)

    return write


def ingest_stream(stream: DataFrame, write: BatchWriter, checkpoint: str) -> StreamingQuery:
    """Process what has landed since the last call, then stop."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_entry_stream(spark: SparkSession, path: str, schema, fmt: str = "json", **options) -> DataFrame:
    """Stream of landed files; ``maxFilesPerTrigger`` and other source options pass through."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)
