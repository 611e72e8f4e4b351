"""Record projections and the small row rules of the two sources."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.constants import ITEM_PAGE, PREVIEW_CHARS, RAW_VERSION, UNKNOWN_TITLE
from newsflow.functions.times import isoformat, run_time
from newsflow.schemas import ARTICLE, RAW_RECORD


def is_missing(text: Column) -> Column:
    """Null or empty."""
    return F.coalesce(text, F.lit("")) == ""


def drop_missing_items(df: DataFrame, item: str = "item") -> DataFrame:
    """Rows whose looked-up item is there; the others are errors."""
    return df.where(F.col(item).isNotNull())


def item_url(url: Column, item_id: Column, page: str = ITEM_PAGE) -> Column:
    """The item's own URL, else its discussion page."""
    return F.when(is_missing(url), F.concat(F.lit(page), item_id.cast("string"))).otherwise(url)


def chosen_content(url: Column, page_text: Column, item_text: Column) -> Column:
    """Page text for items that link out (empty if the page failed), else the item's text as it is."""
    return F.coalesce(F.when(is_missing(url), item_text).otherwise(page_text), F.lit(""))


def chosen_title(extracted: Column, feed_title: Column) -> Column:
    """The feed title stands in for an empty or placeholder title, if it has one."""
    unknown = is_missing(extracted) | (extracted == UNKNOWN_TITLE)
    return F.when(unknown & ~is_missing(feed_title), feed_title).otherwise(extracted)


def raw_body_feed(content: Column, html: Column) -> Column:
    """Text measured in raw mode: cleaned content, else the page as landed, else nothing."""
    return F.when(~is_missing(content), content).otherwise(F.coalesce(html, F.lit("")))


def raw_records(df: DataFrame, body: Column, published_at: Column, run_ts: dt.datetime) -> DataFrame:
    """v1.0 records: length and preview of ``body``, published text as given."""
    values = {
        "schema_version": F.lit(RAW_VERSION),
        "source": F.col("source"),
        "title": F.col("title"),
        "url": F.col("url"),
        "published_at": published_at,
        "raw_text_length": F.length(body),
        "raw_text_preview": F.substring(body, 1, PREVIEW_CHARS),
        "http_status": F.col("http_status"),
        "collected_at": isoformat(run_time(run_ts)),
    }
    carried = [c for c in ("canonical_key", "pos") if c in df.columns]
    return df.select(*[values[f.name].alias(f.name) for f in RAW_RECORD], *carried)


def ranked_metadata(score: Column, descendants: Column, by: Column, item_id: Column) -> Column:
    """Source metadata of a ranked item as JSON, nulls written."""
    fields = F.struct(
        score.alias("hn_score"), descendants.alias("comment_count"), by.alias("by"), item_id.alias("id")
    )
    return F.to_json(fields, {"ignoreNullFields": "false"})


def feed_metadata(run_ts: dt.datetime) -> Column:
    """Source metadata of a feed article as JSON."""
    return F.to_json(F.struct(isoformat(run_time(run_ts)).alias("parsed_at")))


def articles(df: DataFrame, raw_metadata: Column) -> DataFrame:
    """Article rows with their metadata."""
    carried = [c for c in df.columns if c in ("canonical_key", "pos", "status")]
    return df.withColumn("raw_metadata", raw_metadata).select(*ARTICLE.fieldNames(), *carried)


def to_json_record(df: DataFrame) -> Column:
    """The whole row as JSON text, nulls kept."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def preview(df: DataFrame, pos: str = "pos", n: int = 5) -> DataFrame:
    """The first ``n`` records in short form, funding as ``amount (stage)``."""
    shown = lambda c: F.coalesce(F.col(c), F.lit("None"))
    funding = F.format_string("%s (%s)", shown("funding_amount"), shown("funding_stage"))
    return df.orderBy(pos).limit(n).select(
        "source", "title", "event_type", "company", funding.alias("funding"), "summary", "investment_relevant"
    )


def latest(df: DataFrame, n: int = 10, columns=("source", "title", "investment_relevant")) -> DataFrame:
    """The ``n`` articles inserted last; ties go by key."""
    return df.orderBy(F.desc("inserted_at"), "canonical_key").limit(n).select(*columns)
