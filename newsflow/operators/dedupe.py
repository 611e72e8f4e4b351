"""Keys seen before and first-wins duplicates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.skew import HOT_ROWS, lookup_join, with_own_totals

ACCEPTED, DUPLICATE, ERROR = "accepted", "duplicate", "error"


def only_new(
    df: DataFrame, seen: DataFrame, key: str = "canonical_key", spread="pos", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows whose key is not in ``seen`` (one row per key)."""
    return lookup_join(df, seen.select(key), key, spread, "left_anti", hot_rows=hot_rows)


def seen_flag(
    df: DataFrame, seen: DataFrame, key: str = "canonical_key", spread="pos", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``is_processed``."""
    flags = seen.select(key, F.lit(True).alias("_seen"))
    joined = lookup_join(df, flags, key, spread, "left", hot_rows=hot_rows)
    return joined.withColumn("is_processed", F.col("_seen").isNotNull()).drop("_seen")


def union_keys(seen: DataFrame, df: DataFrame, key: str = "canonical_key") -> DataFrame:
    """Set union of keys."""
    return seen.select(key).union(df.select(key)).where(F.col(key).isNotNull()).distinct()


def new_keys(seen: DataFrame, df: DataFrame, key: str = "canonical_key") -> DataFrame:
    """Distinct keys of ``df`` that ``seen`` lacks."""
    fresh = df.select(key).where(F.col(key).isNotNull()).distinct()
    return fresh.join(seen.select(key), key, "left_anti")


def _first_positions(df: DataFrame, key: str, pos: str, ok) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.when(ok, F.col(pos))).alias("_first")
    )


def with_status(
    df: DataFrame,
    key: str = "canonical_key",
    pos: str = "pos",
    ok: str = "ok",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``status``: the first good row of a key is accepted and makes later rows duplicates.

    A failed row stays an error and blocks nothing, unless a good one came before it. Needs only the
    first good position per key, so no group is sorted or gathered.
    """
    firsts = _first_positions(df, key, pos, F.col(ok))
    joined = with_own_totals(df, firsts, key, pos, hot_rows)
    status = (
        F.when(F.col(pos) > F.col("_first"), DUPLICATE)
        .when(F.col(ok), ACCEPTED)
        .otherwise(ERROR)
    )
    return joined.withColumn("status", status).drop("_first")


def with_duplicate_flag(
    df: DataFrame, key: str = "url", pos: str = "pos", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``is_duplicate``: true from the second row of a key on; rows without a key are never flagged."""
    has_key = F.coalesce(F.col(key), F.lit("")) != ""
    firsts = _first_positions(df, key, pos, F.lit(True))
    joined = with_own_totals(df, firsts, key, pos, hot_rows)
    late = F.coalesce(F.col(pos) > F.col("_first"), F.lit(False))
    return joined.withColumn("is_duplicate", has_key & late).drop("_first")
