"""Output audit: counters, source distribution, verdict, findings per record."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.constants import SHORT_TEXT, SHORT_TITLE, UNKNOWN_SOURCE
from newsflow.functions.urls import is_well_formed_url
from newsflow.operators.dedupe import with_duplicate_flag
from newsflow.operators.skew import HOT_ROWS


def _has_url():
    return F.coalesce(F.col("url"), F.lit("")) != ""


def _short_title(df: DataFrame):
    if "title" not in df.columns:
        return F.lit(True)
    return F.length(F.coalesce(F.col("title"), F.lit(""))) < SHORT_TITLE


def _short_text(df: DataFrame):
    if "raw_text_length" not in df.columns:
        return F.lit(False)
    return F.coalesce(F.col("raw_text_length") < SHORT_TEXT, F.lit(False))


def audit(df: DataFrame) -> DataFrame:
    """One summary row in one pass; only duplicates fail the audit, other findings warn.

    Rows without a URL count as such and take no part in the other checks.
    """
    has = _has_url()
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(F.when(has, F.col("url"))).alias("unique_urls"),
        F.count_if(has).alias("_with_url"),
        F.count_if(~has).alias("missing_urls"),
        F.count_if(has & ~is_well_formed_url(F.col("url"))).alias("invalid_urls"),
        F.count_if(has & _short_title(df)).alias("short_titles"),
        F.count_if(has & _short_text(df)).alias("short_texts"),
    )
    duplicates = F.col("_with_url") - F.col("unique_urls")
    return counts.withColumn("duplicates", duplicates).drop("_with_url").withColumn(
        "passed", F.col("duplicates") == 0
    )


def source_distribution(df: DataFrame) -> DataFrame:
    """Records per source, rows without a URL left out."""
    source = F.coalesce(F.col("source"), F.lit(UNKNOWN_SOURCE)) if "source" in df.columns else F.lit(UNKNOWN_SOURCE)
    return df.where(_has_url()).groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("records"))


def findings(df: DataFrame, pos: str = "pos", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(pos, url, findings)`` of every record with at least one finding."""
    has = _has_url()
    flagged = with_duplicate_flag(df, "url", pos, hot_rows)
    checks = {
        "missing_url": ~has,
        "invalid_url": has & ~is_well_formed_url(F.col("url")),
        "duplicate_url": F.col("is_duplicate"),
        "short_title": has & _short_title(df),
        "short_text": has & _short_text(df),
    }
    names = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()]))
    return flagged.select(pos, "url", names.alias("findings")).where(F.size("findings") > 0)
