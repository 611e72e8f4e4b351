"""Ranked source: id list, items, topic filter, page or item text, records."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.constants import ITEM_PAGE, SOURCE_RANKED
from newsflow.functions.text import html_to_text, is_topic
from newsflow.functions.times import epoch_to_utc, isoformat
from newsflow.functions.urls import canonical_key, is_http_url
from newsflow.operators.dedupe import only_new
from newsflow.operators.records import chosen_content, is_missing, item_url, ranked_metadata, raw_records
from newsflow.operators.skew import HOT_ROWS
from newsflow.plans.flow import Walk, fold_copies, in_order, records_of, walk, with_landing_time, with_unmatched
from newsflow.session import stage
from newsflow.sources.landing import page_lookup
from newsflow.sources.readers import with_items


def ranked_candidates(
    ranked: DataFrame,
    items: DataFrame,
    pages: DataFrame,
    seen: DataFrame | None,
    run_ts: dt.datetime,
    source: str = SOURCE_RANKED,
    item_page: str = ITEM_PAGE,
    raw: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every ranked id ``(pos, id)`` that is an error or a new item on topic, with content and ``ok``.

    Ids are walked by ``list`` (if given) and ``pos``, which may repeat. Items and pages that landed more than
    once count once.

    The topic filter stands before the key look-up, and both before any page is joined or parsed. An id
    without an item stays as an error row; items off topic and known keys leave without a trace.
    """
    columns = [c for c in ("list", "pos", "id") if c in ranked.columns]
    ranked = in_order(ranked.select(*[F.col(c).alias("_pos" if c == "pos" else c) for c in columns]), "list", "_pos")
    item = F.col("item")
    found = with_items(ranked, items, "pos", hot_rows=hot_rows)
    landed_at = item["landed_at"] if "landed_at" in items.columns else F.lit(None).cast("timestamp")
    found = fold_copies(stage(found.withColumn("landed_at", landed_at), "items"))
    topical = found.where(item.isNull() | is_topic(item["title"]))
    url = item_url(item["url"], F.col("id"), item_page)
    listed = topical.select(
        F.lit(source).alias("source"),
        "pos",
        "id",
        item.isNotNull().alias("has_item"),
        item["title"].alias("title"),
        item["url"].alias("page_url"),
        item["text"].alias("item_text"),
        epoch_to_utc(item["time"], run_ts).alias("published_at"),
        ranked_metadata(item["score"], item["descendants"], item["by"], F.col("id")).alias("raw_metadata"),
        F.when(item.isNotNull(), url).alias("url"),
        F.when(item.isNotNull(), canonical_key(url)).alias("canonical_key"),
    )
    listed = stage(listed, "listed")
    if seen is not None:
        listed = stage(only_new(listed, seen, hot_rows=hot_rows), "new")
    links_out = ~is_missing(F.col("page_url"))
    linked = listed.where(links_out).drop("item_text")
    bodies = with_landing_time(pages).withColumnRenamed("url", "page_url")
    landed = page_lookup(linked, bodies, "page_url", "pos", hot_rows)
    found = landed.withColumn("page_text", html_to_text(F.col("html"))).withColumn("item_text", F.lit(None).cast("string"))
    found = found if raw else found.drop("html")

    every = with_unmatched(listed, fold_copies(stage(found, "pages")))
    content = chosen_content(F.col("page_url"), F.col("page_text"), F.col("item_text"))
    texts = every.select(
        "source", "pos", "id", "has_item", "title", "published_at", "raw_metadata", "url", "canonical_key",
        F.when(links_out, F.coalesce("http_status", F.lit(0))).otherwise(200).alias("http_status"),
        content.alias("content"),
        *([chosen_content(F.col("page_url"), F.col("html"), F.col("item_text")).alias("body")] if raw else []),
    )
    ok = F.col("has_item") & ~is_missing(F.col("content"))
    return texts.withColumn("ok", ok if raw else ok & is_http_url(F.col("url")))


def ranked_walk(ranked, items, pages, seen, run_ts, limit=None, raw=False, hot_rows=HOT_ROWS, **options) -> Walk:
    """One run over the id list. The caller cuts the list, by habit to twice ``limit``."""
    candidates = ranked_candidates(ranked, items, pages, seen, run_ts, raw=raw, hot_rows=hot_rows, **options)
    return walk(candidates, limit, hot_rows=hot_rows)


def ranked_records(done: Walk, run_ts: dt.datetime, **analysis) -> DataFrame:
    """v2.0 records of a run."""
    return records_of(done, run_ts, F.col("raw_metadata"), **analysis)


def ranked_raw_records(done: Walk, run_ts: dt.datetime) -> DataFrame:
    """v1.0 records of a raw run."""
    return raw_records(done.accepted, F.col("body"), isoformat(F.col("published_at")), run_ts)
