"""Look-up joins that hold when one key has a large share of the rows.

A look-up has at most one row per key on the right; the left side may repeat a key without limit. Keys with
more than ``HOT_ROWS`` left rows are found by counting (combined map-side), their left rows are spread over one
salt per ``HOT_ROWS`` rows, and their one right row is repeated once per salt. Every other key joins on salt 0.
The result is the same whichever keys count as hot.

There are at most ``rows / HOT_ROWS`` hot keys, so the list grows, slowly, with the input. It is fetched up to
``LISTED_KEYS``; a list that fits is handed to the tasks by broadcast, and an empty one costs no join. A longer
one is attached by a join on the key, whose left side adaptive execution splits where a key is large. Salts come
from a hash of a row identifier, never from a random number, so a re-run task sends each row to the same place.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_ROWS = 1_000_000
LISTED_KEYS = 100_000


def hot_keys(counts: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(key, _salts)`` of the keys with more than ``hot_rows`` rows, from ``(key, _n)`` counts."""
    salts = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("long")
    return counts.where((F.col("_n") > hot_rows) & F.col(key).isNotNull()).select(
        key, F.greatest(salts, F.lit(2)).alias("_salts")
    )


def listed(hot: DataFrame, listed_keys: int = LISTED_KEYS) -> DataFrame | None:
    """The short list ``hot`` ready for joins: broadcast if it is short, as it is if not, None if it is empty."""
    rows = hot.limit(listed_keys + 1).collect()
    if not rows:
        return None
    if len(rows) > listed_keys:
        return hot
    return F.broadcast(hot.sparkSession.createDataFrame(rows, hot.schema))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: str | Column,
    how: str = "left",
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    listed_keys: int = LISTED_KEYS,
) -> DataFrame:
    """Join ``left`` to ``right`` (unique on ``key``) by ``key``; ``how``: left, inner, left_semi or left_anti.

    ``spread`` identifies a left row and decides its salt. ``counts`` is ``(key, _n)`` if the caller has
    it already; counts over more rows than ``left`` do as well. Null keys match nothing; each goes by its own hash.
    Counting runs a job, so ``left`` should be a scan or a staged table.
    """
    hot = listed(hot_keys(counts if counts is not None else key_counts(left, key), key, hot_rows), listed_keys)
    place = F.xxhash64(spread)
    salt = F.when(F.col(key).isNull(), place)
    if hot is None:
        salted_left = left.withColumn("_salt", salt.otherwise(F.lit(0).cast("long")))
        # a zero the optimizer cannot fold out of the join keys, which would gather null keys in one task
        salted_right = right.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1).cast("long")))
    else:
        salt = salt.when(F.col("_salts").isNotNull(), F.pmod(place, F.col("_salts"))).otherwise(F.lit(0))
        salted_left = left.join(hot, key, "left").withColumn("_salt", salt.cast("long")).drop("_salts")
        last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
        salted_right = right.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        salted_right = salted_right.drop("_salts")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


def with_own_totals(
    df: DataFrame,
    totals: DataFrame,
    key: str,
    spread: str | Column,
    hot_rows: int = HOT_ROWS,
    listed_keys: int = LISTED_KEYS,
) -> DataFrame:
    """Give each row the totals of its key; ``totals`` is ``df`` aggregated by ``key``, with row count ``_n``.

    The counts are in the totals, so finding hot keys costs no second pass over ``df``. Null keys get nulls.
    """
    values = [c for c in totals.columns if c not in (key, "_n")]
    joined = lookup_join(
        df, totals.where(F.col(key).isNotNull()), key, spread, "left", totals.select(key, "_n"), hot_rows, listed_keys
    )
    return joined.select(*df.columns, *values)


def data_size(df: DataFrame) -> int:
    """Upper estimate of the bytes in ``df``: text lengths plus a fixed share per field. One small job."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.typeName() == "string"]
    per_row = F.lit(32 * len(df.columns))
    for length in text:
        per_row = per_row + length
    return df.agg(F.coalesce(F.sum(per_row.cast("long")), F.lit(0)).alias("n")).first().n


def wide_lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: str | Column,
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Inner look-up into a table of wide rows, such as page bodies. ``left`` should be a staged table.

    ``also`` names columns of both sides that follow from the key, such as the folder a row is stored in.

    A left side that measures small is broadcast, so that the wide table is filtered where it is scanned
    and never shuffled. A larger one takes the salted join.
    """
    columns = [*left.columns, *[c for c in right.columns if c not in (key, *also)]]
    if data_size(left) <= broadcast_bytes:
        return right.join(F.broadcast(left), [key, *also]).select(*columns)
    return lookup_join(left, right.drop(*also), key, spread, "inner", hot_rows=hot_rows).select(*columns)
