"""Landed pages in buckets of their URL, so that a run opens only the files its listing points to."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.skew import BROADCAST_BYTES, HOT_ROWS, wide_lookup

#: The partition column names the number of buckets, so readers cannot use another one.
BUCKET = "url_bucket_of_"
BUCKETS = 1024


def url_bucket(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def bucket_column(pages: DataFrame) -> str | None:
    """Name of the bucket column if the pages were landed in buckets."""
    return next((c for c in pages.columns if re.fullmatch(BUCKET + r"\d+", c)), None)


def land_pages(pages: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Add landed pages under ``path``, one folder per bucket of ``url``.

    Rows are rebalanced by bucket: small buckets become one file each and large ones, such as that of a page
    that landed very often, are split. All landings under a path need the same number of buckets; Spark refuses
    to read a path that mixes them. Rows without a URL go to the folder for null and are found by no look-up.
    """
    name = f"{BUCKET}{buckets}"
    bucket = F.when(F.col("url").isNotNull(), url_bucket(F.col("url"), buckets))
    placed = pages.withColumn(name, bucket).hint("rebalance", F.col(name))
    placed.write.mode("append").partitionBy(name).parquet(path)


def page_lookup(
    listed: DataFrame,
    pages: DataFrame,
    key: str,
    spread: str,
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``wide_lookup`` of staged ``listed`` by its URL column ``key`` in ``pages``, which calls it the same.

    Of pages landed in buckets, the buckets of the listing alone are read: a small listing is joined by bucket
    and URL, and its broadcast prunes the partitions. A listing too large to broadcast touches all buckets.
    """
    name = bucket_column(pages)
    if name is None:
        return wide_lookup(listed, pages, key, spread, hot_rows, broadcast_bytes)
    columns = [*listed.columns, *[c for c in pages.columns if c not in (key, name)]]
    buckets = int(name.removeprefix(BUCKET))
    # the comparison, true of every bucket, tells the optimizer that the listing is worth pruning by
    placed = listed.withColumn(name, url_bucket(F.col(key), buckets)).where(F.col(name) >= 0)
    return wide_lookup(placed, pages, key, spread, hot_rows, broadcast_bytes, also=(name,)).select(*columns)
