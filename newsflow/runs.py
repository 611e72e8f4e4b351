"""Whole runs over landed data, and checks of their output. Options of a run are plain arguments."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from newsflow.constants import RANKED_OVERFETCH, SOURCE_FEED, SOURCE_RANKED
from newsflow.operators import audit, compare
from newsflow.plans.feed import feed_raw_records, feed_records, feed_walk
from newsflow.plans.flow import save_raw_run, save_run
from newsflow.plans.ranked import ranked_raw_records, ranked_records, ranked_walk
from newsflow.schemas import OUTPUT_RECORD, RANKED_IDS
from newsflow.sources import readers
from newsflow.sources.keyed import KeyedArticles
from newsflow.sources.sinks import ArticleTable


def ingest_feed(
    spark: SparkSession,
    feed: str,
    pages: str,
    table: ArticleTable | KeyedArticles,
    ledger: str,
    batch: int,
    run_ts: dt.datetime,
    limit: int | None = 10,
    output: str | None = None,
    raw: bool = False,
    source: str = SOURCE_FEED,
    analysis: dict | None = None,
    **options,
) -> None:
    """One run over a landed feed file and landed pages.

    ``limit`` caps accepted articles. A raw run writes v1.0 JSON lines to ``output`` and nothing else;
    otherwise articles go to ``table`` and, if ``output`` is given, v2.0 JSON lines there too.
    """
    entries = readers.usable_entries(readers.read_feed(spark, feed))
    landed = readers.read_pages(spark, pages)

    def run(seen):
        return feed_walk(entries, landed, seen, run_ts, limit, raw=raw, source=source, **options)

    if raw:
        save_raw_run(
            spark, run, lambda done: feed_raw_records(done, run_ts), table, output, ledger, source, batch, run_ts
        )
    else:
        records = lambda done: feed_records(done, run_ts, **(analysis or {}))
        save_run(spark, run, records, table, ledger, source, batch, run_ts, output)


def ingest_ranked(
    spark: SparkSession,
    ids: str,
    items: str,
    pages: str,
    table: ArticleTable | KeyedArticles,
    ledger: str,
    batch: int,
    run_ts: dt.datetime,
    limit: int = 20,
    output: str | None = None,
    raw: bool = False,
    source: str = SOURCE_RANKED,
    analysis: dict | None = None,
    **options,
) -> None:
    """One run over a landed id list (``{"ids": [...]}``), landed items and landed pages.

    ``limit`` caps accepted articles; twice as many ids are checked, to leave room for the topic filter.
    """
    lists = readers.read_jsonl(spark, ids, RANKED_IDS)
    lists = readers.with_positions(lists, "list")
    ranked = readers.ranked_ids(lists, limit * RANKED_OVERFETCH, keep=("list",)).withColumnRenamed("rank", "pos")
    looked_up, landed = readers.read_items(spark, items), readers.read_pages(spark, pages)

    def run(seen):
        return ranked_walk(ranked, looked_up, landed, seen, run_ts, limit, raw=raw, source=source, **options)

    if raw:
        save_raw_run(
            spark, run, lambda done: ranked_raw_records(done, run_ts), table, output, ledger, source, batch, run_ts
        )
    else:
        records = lambda done: ranked_records(done, run_ts, **(analysis or {}))
        save_run(spark, run, records, table, ledger, source, batch, run_ts, output)


def audit_jsonl(spark: SparkSession, path: str, schema=OUTPUT_RECORD) -> DataFrame:
    """Audit summary of JSON-lines output; ``passed`` is the verdict."""
    return audit.audit(readers.read_jsonl(spark, path, schema))


def compare_jsonl(
    spark: SparkSession, left: str, right: str, schema=OUTPUT_RECORD, mode: str = "full", by_position: bool = False
) -> DataFrame:
    """Verdict on two outputs. By default records may come in any order; ``by_position`` pairs them in file
    order, which needs one file on each side."""
    a, b = (readers.read_jsonl(spark, p, schema) for p in (left, right))
    if by_position:
        return compare.comparison_summary(readers.with_positions(a), readers.with_positions(b), mode=mode)
    return compare.content_summary(a, b, mode)
