"""Timestamps: epoch seconds, ISO text, feed dates, free-form page dates (session zone is UTC)."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: date formats tried in turn after ISO 8601 --------------------------------
FEED_FORMATS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z")
PAGE_FORMATS = FEED_FORMATS + (
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy",
    "d MMMM yyyy HH:mm:ss",
    "d MMMM yyyy",
    "MMM d, yyyy HH:mm:ss",
    "MMM d, yyyy h:mm a",
    "MMM d, yyyy",
    "MMMM d, yyyy HH:mm:ss",
    "MMMM d, yyyy h:mm a",
    "MMMM d, yyyy",
    "M/d/yyyy HH:mm:ss",
    "M/d/yyyy",
    "yyyy/M/d HH:mm:ss",
    "yyyy/M/d",
    "yyyyMMdd'T'HHmmssX",
    "yyyyMMdd'T'HHmmss",
    "yyyyMMdd",
    "MMM d yyyy HH:mm:ss",
    "MMM d yyyy",
    "MMMM d yyyy",
    "MMM d HH:mm:ss yyyy",
    "d-MMM-yyyy",
    "yyyy.M.d",
)
TIME_ONLY = r"\A\d{1,2}:\d{2}(?::\d{2})?\z"


def utc(ts: dt.datetime) -> dt.datetime:
    """A naive clock value read as UTC, whatever the zone of the driver."""
    return ts if ts.tzinfo else ts.replace(tzinfo=dt.UTC)


def run_time(run_ts: dt.datetime) -> Column:
    """One clock value per run, so that a re-run or a lost task writes the same rows."""
    return F.lit(utc(run_ts)).cast("timestamp")


def epoch_to_utc(seconds: Column, run_ts: dt.datetime) -> Column:
    """Epoch seconds to a timestamp; absent means the run time."""
    return F.coalesce(F.timestamp_seconds(seconds), run_time(run_ts))


def isoformat(ts: Column) -> Column:
    """ISO text; microseconds are printed only when they are not zero."""
    fraction = F.when(
        F.date_format(ts, "SSSSSS") != "000000", F.date_format(ts, ".SSSSSS")
    ).otherwise("")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction)


def _parse(text: Column, formats: tuple[str, ...]) -> Column:
    trimmed = F.trim(text)
    no_weekday = F.regexp_replace(trimmed, r"(?i)\A(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", "")
    plain = F.regexp_replace(F.regexp_replace(no_weekday, r"(?i)(?<=\d)(?:st|nd|rd|th)\b", ""), r"\s+", " ")
    # without a year the cast would take the date from the clock of the executor
    dated = F.when(trimmed.rlike(r"\A[+-]?\d{4}"), trimmed)
    return F.coalesce(
        F.try_to_timestamp(dated),
        *[F.try_to_timestamp(plain, F.lit(f)) for f in formats],
    )


def parse_feed_date(text: Column) -> Column:
    """RFC 822 feed dates (and ISO text) to a timestamp, null if unreadable."""
    return _parse(text, FEED_FORMATS)


def parse_page_date(text: Column, run_ts: dt.datetime) -> Column:
    """Published time of a page: absent text means the run time, unreadable text means null.

    A bare time of day belongs to the date of the run.
    """
    absent = F.coalesce(text, F.lit("")) == ""
    day = utc(run_ts).astimezone(dt.UTC).strftime("%Y-%m-%d ")
    timed = F.when(F.trim(text).rlike(TIME_ONLY), F.concat(F.lit(day), F.trim(text)))
    return F.when(absent, run_time(run_ts)).otherwise(
        F.coalesce(F.try_to_timestamp(timed), _parse(text, PAGE_FORMATS))
    )
