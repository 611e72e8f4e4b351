"""Feed source: entries, landed pages, extracted articles, records."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.constants import CONTENT_SELECTORS, SOURCE_FEED, TITLE_SELECTOR
from newsflow.functions.times import parse_page_date
from newsflow.functions.urls import canonical_key, is_http_url
from newsflow.operators.dedupe import only_new
from newsflow.operators.extract import with_article
from newsflow.operators.records import (
    chosen_title,
    feed_metadata,
    is_missing,
    raw_body_feed,
    raw_records,
)
from newsflow.operators.skew import HOT_ROWS
from newsflow.plans.flow import (
    FIRST_RANGE,
    Walk,
    fold_copies,
    in_order,
    records_of,
    walk,
    walk_ranges,
    with_landing_time,
    with_unmatched,
)
from newsflow.session import stage
from newsflow.sources.landing import page_lookup


def feed_listing(
    entries: DataFrame, seen: DataFrame | None, source: str = SOURCE_FEED, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """New entries, staged, in the order of ``feed_file`` (if given) and ``feed_pos``, which may repeat.

    Known keys are dropped here, so the bodies of their pages are neither moved nor parsed.
    """
    listed = entries.select(
        F.lit(source).alias("source"),
        *[c for c in ("feed_file", "feed_pos") if c in entries.columns],
        F.col("link").alias("url"),
        F.col("title").alias("feed_title"),
        F.col("published").alias("feed_published"),
        canonical_key(F.col("link")).alias("canonical_key"),
    )
    listed = in_order(listed, "feed_file", "feed_pos")
    if seen is not None:
        listed = stage(only_new(listed, seen, hot_rows=hot_rows), "new")
    return listed


def feed_candidates(
    listed: DataFrame,
    pages: DataFrame,
    run_ts: dt.datetime,
    title_selector=TITLE_SELECTOR,
    content_selectors=CONTENT_SELECTORS,
    raw: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every listed entry with its extracted article and ``ok``. A page that landed twice counts once.

    In raw mode every entry is ok; otherwise the page must have a body, a readable date and a usable URL.
    """
    landed = page_lookup(listed, with_landing_time(pages), "url", "pos", hot_rows)
    found = with_article(landed, "html", title_selector, content_selectors)
    dated = F.col("published_at").isNotNull()
    found = found.withColumn("published_at", parse_page_date(F.col("published_raw"), run_ts))
    if raw:
        body = raw_body_feed(F.when(dated, F.col("content")), F.col("html"))
        found = found.withColumn("body", body)
    has_page = ~is_missing(F.col("html"))
    found = found.withColumn("has_page", has_page).drop("html", "published_raw", *(["content"] if raw else []))

    every = with_unmatched(listed, fold_copies(stage(found, "pages")))
    has_page = F.coalesce("has_page", F.lit(False))
    status = F.coalesce("http_status", F.lit(0))
    if raw:
        return every.select(
            "source", "pos", "url", F.col("feed_title").alias("title"), "feed_published", "canonical_key",
            status.alias("http_status"), has_page.alias("has_page"),
            F.coalesce("body", F.lit("")).alias("body"), F.lit(True).alias("ok"),
        )
    title = chosen_title(F.col("page_title"), F.col("feed_title"))
    ok = has_page & dated & is_http_url(F.col("url")) & title.isNotNull()
    return every.select(
        "source", "pos", "url", title.alias("title"), "canonical_key", status.alias("http_status"),
        "published_at", "content", ok.alias("ok"),
    )


def feed_walk(
    entries: DataFrame,
    pages: DataFrame,
    seen: DataFrame | None,
    run_ts: dt.datetime,
    limit: int | None = None,
    raw: bool = False,
    source: str = SOURCE_FEED,
    hot_rows: int = HOT_ROWS,
    first_range: int = FIRST_RANGE,
    **selectors,
) -> Walk:
    """One run over the feed; in raw mode entries without a page are kept and also counted as errors.

    With a ``limit`` entries are looked up and parsed range by range, until it is met.
    """
    listed = feed_listing(entries, seen, source, hot_rows)
    failed = ~F.col("has_page") if raw else None

    def candidates(part: DataFrame) -> DataFrame:
        return feed_candidates(part, pages, run_ts, raw=raw, hot_rows=hot_rows, **selectors)

    if limit is None:
        return walk(candidates(listed), None, failed, hot_rows)
    return walk_ranges(listed, candidates, limit, failed, hot_rows, first_range)


def feed_records(done: Walk, run_ts: dt.datetime, **analysis) -> DataFrame:
    """v2.0 records of a run."""
    return records_of(done, run_ts, feed_metadata(run_ts), **analysis)


def feed_raw_records(done: Walk, run_ts: dt.datetime) -> DataFrame:
    """v1.0 records of a raw run."""
    return raw_records(done.accepted, F.col("body"), F.col("feed_published"), run_ts)
