"""The part both sources share: status, quota, analysis, records, tables."""

import contextlib
import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.constants import UNKNOWN_MODEL
from newsflow.functions.times import isoformat, run_time
from newsflow.functions.urls import canonical_key
from newsflow.operators.dedupe import ACCEPTED, union_keys, with_status
from newsflow.operators.enrich import analyze, attach_analysis, build_prompt, output_records, prompt_date
from newsflow.operators.ordering import with_prior_count
from newsflow.operators.quota import run_counters, take_successes
from newsflow.operators.records import to_json_record
from newsflow.operators.skew import HOT_ROWS
from newsflow.schemas import RAW_RECORD
from newsflow.session import stage
from newsflow.sources.keyed import KeyedArticles
from newsflow.sources.readers import read_jsonl_batches
from newsflow.sources.sinks import (
    FAILED,
    SUCCESS,
    ArticleTable,
    before_run,
    finish_run,
    start_run,
    write_jsonl_batch,
)

CARRIED = ("canonical_key", "pos")
#: Rows of the first range that a run with a quota looks at, unless the quota asks for more.
FIRST_RANGE = 1024


@dataclasses.dataclass(frozen=True)
class Walk:
    """Rows a run looked at, each with its status."""

    visited: DataFrame
    failed: Column | None = None

    @property
    def accepted(self) -> DataFrame:
        return self.visited.where(F.col("status") == ACCEPTED)

    @property
    def counters(self) -> DataFrame:
        return run_counters(self.visited, failed=self.failed)


def decide(candidates: DataFrame, limit: int | None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``pos`` and ``status`` of the candidates (``source, canonical_key, pos, ok``) that the quota lets a run visit:
    first-wins dedupe, then the quota. Works on four thin columns; staged if there is a quota."""
    thin = candidates.select("source", "canonical_key", "pos", "ok")
    decided = with_status(thin, hot_rows=hot_rows)
    if limit is not None:
        decided = stage(take_successes(stage(decided, "status"), limit), "visited")
    return decided.select("pos", "status")


def walk(
    candidates: DataFrame, limit: int | None, failed: Column | None = None, hot_rows: int = HOT_ROWS
) -> Walk:
    """Decide every candidate. ``candidates`` are staged already.

    The status is joined back by position, which is unique, so bodies are shuffled once and evenly.
    """
    return Walk(candidates.join(decide(candidates, limit, hot_rows), "pos"), failed)


def walk_ranges(
    listed: DataFrame,
    candidates: Callable[[DataFrame], DataFrame],
    limit: int,
    failed: Column | None = None,
    hot_rows: int = HOT_ROWS,
    first: int = FIRST_RANGE,
) -> Walk:
    """The walk over ``listed`` (staged, of one source, in ``pos`` order) that stops at the quota.

    ``candidates`` looks up and parses a part of the listing. It gets the first rows, at least twice the quota,
    then ranges that double, until enough rows were accepted: what comes later is neither fetched nor parsed, and
    there are at most as many rounds as doublings. A row's status depends on earlier positions alone, so the rows
    seen so far, decided together, give what a walk over all of them gives. One number per round reaches the driver.
    """
    ranked = stage(with_prior_count(listed, "pos", out="_rank"), "ranked")
    total, start, size, looked_at = ranked.count(), 0, max(first, 2 * limit), None
    while True:
        part = ranked.where((F.col("_rank") >= start) & (F.col("_rank") < start + size)).drop("_rank")
        found = candidates(part)
        looked_at = found if looked_at is None else looked_at.unionByName(found)
        decided = decide(looked_at, limit, hot_rows)
        start, size = start + size, 2 * size
        if start >= total or decided.where(F.col("status") == ACCEPTED).count() >= limit:
            return Walk(looked_at.join(decided, "pos"), failed)


def in_order(listed: DataFrame, *order: str) -> DataFrame:
    """``listed`` with ``pos``, which is unique and follows ``order``, instead of the columns ``order``; staged.

    Positions that several files or lists count on their own give the order, and identity is given here, once.
    A single position column that is unique already is kept as it is, without a sort.
    """
    present = [c for c in order if c in listed.columns]
    rest = [c for c in listed.columns if c not in present]
    listed = stage(listed, "given")
    if len(present) == 1:
        repeated = listed.groupBy(*present).count().where((F.col("count") > 1) | F.col(present[0]).isNull())
        if not repeated.limit(1).collect():
            return listed.withColumnRenamed(present[0], "pos")
    placed = listed.orderBy(*present, *rest).withColumn("pos", F.monotonically_increasing_id())
    return stage(placed.select("pos", *rest), "listed")


def fold_copies(found: DataFrame, landed_at: str = "landed_at") -> DataFrame:
    """One row per ``pos`` of a staged look-up result: what landed last, ties by the values themselves.

    A page or item may have landed more than once. Rows are moved only if one did.
    """
    rest = [c for c in found.columns if c not in ("pos", landed_at)]
    if not found.groupBy("pos").count().where("count > 1").limit(1).collect():
        return found.select("pos", *rest)
    newest = found.groupBy("pos").agg(F.max(F.struct(landed_at, *rest)).alias("_newest"))
    return newest.select("pos", *[F.col(f"_newest.{c}").alias(c) for c in rest])


def with_landing_time(landed: DataFrame) -> DataFrame:
    if "landed_at" in landed.columns:
        return landed
    return landed.withColumn("landed_at", F.lit(None).cast("timestamp"))


def with_unmatched(listed: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` plus the listed rows it lacks, nulls in the columns they do not have. Both are staged."""
    rest = listed.join(found.select("pos"), "pos", "left_anti")
    shared = rest.select(*[c for c in rest.columns if c in found.columns])
    return found.unionByName(shared, allowMissingColumns=True)


def analyzed(
    articles: DataFrame,
    analyzer_factory: Callable | None = None,
    stored: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Articles with ``article_hash``, ``analysis`` and ``analysis_error``.

    ``stored`` results are looked up by hash; without them the analyzer, if any, is called.
    """
    hashed = articles.withColumn("article_hash", F.sha2("content", 256))
    if stored is not None:
        found = attach_analysis(hashed, stored, hot_rows=hot_rows)
        return found.withColumn("analysis_error", F.lit(None).cast("string"))
    prompt = build_prompt(
        F.col("title"), F.col("source"), prompt_date(F.col("published_at")), F.col("content")
    )
    return analyze(hashed, prompt, analyzer_factory)


def article_rows(records: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Table rows of v2.0 records, the whole record kept as JSON."""
    record = records.drop(*CARRIED)
    rows = records.withColumn("raw_data", to_json_record(record))
    return rows.withColumn("inserted_at", isoformat(run_time(run_ts)))


@contextlib.contextmanager
def recorded(spark: SparkSession, ledger: str, source: str, batch: int, run_ts: dt.datetime):
    """Ledger rows around a run; the body yields its ``Walk`` to ``done``. Failures are recorded and raised.

    The run id is the source and batch number, so a replay writes the same run again. A run starts at its run
    time and ends when it ends, so that a retry stands behind what it retries. Two numbers reach the driver.
    """
    run_id = f"{source}-{batch}"
    start_run(spark, ledger, run_id, source, run_ts)
    finished: list[Walk] = []
    try:
        yield finished.append
        counts = finished[0].counters.first()
        processed, errors = (counts.items_processed, counts.errors) if counts else (0, 0)
        finish_run(spark, ledger, run_id, source, dt.datetime.now(dt.UTC), SUCCESS, processed, errors)
    except Exception:
        finish_run(spark, ledger, run_id, source, dt.datetime.now(dt.UTC), FAILED, 0, 0)
        raise


def save_run(
    spark: SparkSession,
    make_walk: Callable[[DataFrame], Walk],
    make_records: Callable[[Walk], DataFrame],
    table: ArticleTable | KeyedArticles,
    ledger: str,
    source: str,
    batch: int,
    run_ts: dt.datetime,
    jsonl: str | None = None,
) -> None:
    """One run end to end: walk, article batch, optional v2.0 JSON lines, ledger.

    ``make_walk`` gets the keys of earlier batches. Everything is written under the batch number, so
    that a replay replaces its own output.
    """
    with recorded(spark, ledger, source, batch, run_ts) as done:
        known = table.read(before=(source, batch))
        walked = make_walk(known.select("canonical_key"))
        records = stage(make_records(walked), "records")
        table.write_run(article_rows(records, run_ts), source, batch)
        if jsonl:
            write_jsonl_batch(records.drop(*CARRIED), jsonl, source, batch)
        done(walked)


def save_raw_run(
    spark: SparkSession,
    make_walk: Callable[[DataFrame], Walk],
    make_records: Callable[[Walk], DataFrame],
    table: ArticleTable | KeyedArticles,
    jsonl: str,
    ledger: str,
    source: str,
    batch: int,
    run_ts: dt.datetime,
) -> None:
    """A raw run: v1.0 JSON lines only. Keys in the article table and in earlier raw batches are skipped."""
    with recorded(spark, ledger, source, batch, run_ts) as done:
        earlier = before_run(read_jsonl_batches(spark, jsonl, RAW_RECORD), source, batch)
        raw_keys = earlier.select(canonical_key(F.col("url")).alias("canonical_key"))
        known = table.read(before=(source, batch))
        walked = make_walk(union_keys(known, raw_keys))
        write_jsonl_batch(make_records(walked).drop(*CARRIED), jsonl, source, batch)
        done(walked)


def records_of(
    done: Walk,
    run_ts: dt.datetime,
    raw_metadata: Column,
    analyzer_factory: Callable | None = None,
    stored: DataFrame | None = None,
    model_used: str = UNKNOWN_MODEL,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """v2.0 records of the accepted articles of a walk."""
    articles = done.accepted.withColumn("raw_metadata", raw_metadata)
    with_analysis = analyzed(articles, analyzer_factory, stored, hot_rows)
    return output_records(with_analysis, run_ts, model_used)
