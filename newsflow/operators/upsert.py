"""Keyed upsert of article rows, as a join of two versions of the table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.ordering import with_prior_count
from newsflow.session import stage

UPDATED = ("title", "published_at", "company", "investment_relevant", "event_type", "summary", "raw_data")
EXTRA_UPDATED = ("funding_amount", "funding_stage", "investors")
KEPT = ("source", "url", "inserted_at")


def collapse_incoming(
    incoming: DataFrame, kept: list[str], updated: list[str], key: str = "canonical_key", pos: str = "pos"
) -> DataFrame:
    """One row per key: kept columns of its first row, updated columns of its last.

    Both are aggregates, so copies of one key are folded map-side before the shuffle.
    """
    folded = incoming.groupBy(key).agg(
        F.min_by(F.struct(*kept), F.col(pos)).alias("_kept"),
        F.max_by(F.struct(*updated), F.col(pos)).alias("_updated"),
        F.min(pos).alias(pos),
    )
    return folded.select(key, "_kept.*", "_updated.*", pos)


def upsert_articles(
    existing: DataFrame,
    incoming: DataFrame,
    key: str = "canonical_key",
    pos: str = "pos",
    kept: tuple[str, ...] = KEPT,
    updated: tuple[str, ...] | None = None,
) -> DataFrame:
    """New version of ``existing`` (unique on ``key``) after writing ``incoming`` in ``pos`` order.

    ``updated`` are by default all columns a later write replaces, so far as ``existing`` has them.

    A known key takes the updated columns of the incoming row, nulls included, and keeps ``id`` and the
    kept columns. New keys get the next ids in order of first appearance. Both sides of the join have one
    row per key, so a repeated incoming key cannot skew it; ``existing`` needs no shuffle if it is
    bucketed by the key.
    """
    if updated is None:
        updated = tuple(c for c in UPDATED + EXTRA_UPDATED if c in existing.columns)
    old = existing.select("id", key, *kept, *updated).alias("e")
    new = collapse_incoming(incoming, list(kept), list(updated), key, pos).alias("i")
    joined = old.join(new, F.col(f"e.{key}") == F.col(f"i.{key}"), "full")
    hit, known = F.col(f"i.{key}").isNotNull(), F.col(f"e.{key}").isNotNull()
    merged = joined.select(
        "e.id",
        F.coalesce(f"e.{key}", f"i.{key}").alias(key),
        *[F.when(known, F.col(f"e.{c}")).otherwise(F.col(f"i.{c}")).alias(c) for c in kept],
        *[F.when(hit, F.col(f"i.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in updated],
        f"i.{pos}",
    )
    return merged


def assign_ids(merged: DataFrame, existing: DataFrame, pos: str = "pos") -> DataFrame:
    """Fill the ids of new rows: highest existing id plus rank by ``pos``. ``merged`` is read twice."""
    top = F.coalesce(existing.agg(F.max("id")).scalar(), F.lit(0))
    fresh = with_prior_count(merged.where(F.col("id").isNull()), pos, out="_rank")
    fresh = fresh.withColumn("id", top + F.col("_rank") + 1)
    kept = merged.where(F.col("id").isNotNull())
    return kept.unionByName(fresh.select(*merged.columns)).drop(pos)


def fold_articles(rows: DataFrame, key: str = "canonical_key") -> DataFrame:
    """The article table ``rows`` with one row per key and unique ids, after runs that overlapped.

    A key keeps the id and the kept columns of its first row and takes the updated columns of its last, by
    ``inserted_at``, then ``id``, then the values themselves. Of keys that share an id the smallest keeps it;
    the others get the next ids. Copies are folded map-side; only thin rows are numbered.
    """
    updated = [c for c in UPDATED + EXTRA_UPDATED if c in rows.columns]
    kept = ["id", *KEPT]
    order = lambda own: F.struct("inserted_at", "id", *own)
    folded = stage(
        rows.groupBy(key).agg(
            F.min_by(F.struct(*kept), order(KEPT)).alias("_kept"), F.max_by(F.struct(*updated), order(updated)).alias("_updated")
        ).select(key, "_kept.*", "_updated.*"),
        "folded",
    )
    owner = folded.groupBy("id").agg(F.min(key).alias("_owner"))
    thin = folded.select("id", key, "inserted_at").join(owner, "id")
    late = thin.where(F.col(key) != F.col("_owner")).orderBy("inserted_at", "id", key)
    late = stage(late.select(key, F.monotonically_increasing_id().alias("pos")), "late")
    merged = folded.join(late, key, "left").withColumn("id", F.when(F.col("pos").isNull(), F.col("id")))
    return assign_ids(stage(merged, "merged"), folded).select(*[c for c in rows.columns if c in folded.columns])


def merge_sql(target: str, incoming: str, key: str = "canonical_key") -> str:
    """The same upsert as a MERGE statement, for table formats that have one."""
    columns = [key, *KEPT, *UPDATED, *EXTRA_UPDATED]
    sets = ", ".join(f"t.{c} = s.{c}" for c in UPDATED + EXTRA_UPDATED)
    return (
        f"MERGE INTO {target} t USING {incoming} s ON t.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) "
        f"VALUES ({', '.join('s.' + c for c in columns)})"
    )
