"""Run-to-run comparison: by position, by key, as multisets, and field by field.

The comparisons shuffle positions or keys with 64-character digests, never whole records; records are
fetched only for pairs that differ.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.constants import INGESTION_FIELDS, VOLATILE_FIELDS
from newsflow.operators.ordering import with_prior_count


def _fields(columns: list[str], mode: str, exclude: tuple[str, ...]) -> list[str]:
    kept = [c for c in columns if c not in VOLATILE_FIELDS and c not in exclude]
    if mode == "full":
        return kept
    if mode == "ingestion":
        return [c for c in kept if c in INGESTION_FIELDS]
    raise ValueError(f"unknown mode {mode!r}")


def comparison_view(df: DataFrame, mode: str = "full") -> DataFrame:
    """Columns that must not change between runs: all but the volatile ones, or the ingested ones only."""
    return df.select(*_fields(df.columns, mode, ()))


def fingerprint(df: DataFrame, mode: str = "full", exclude: tuple[str, ...] = ("pos",)):
    """Hex SHA-256 over the key-sorted JSON of the comparison view."""
    names = sorted(_fields(df.columns, mode, exclude))
    return F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)


def align(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the union of their columns; one that is absent reads as null."""

    def widen(df, other):
        extra = [f for f in other.schema if f.name not in df.columns]
        return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])

    return widen(a, b), widen(b, a)


def _digests(df: DataFrame, pos: str, mode: str, ranked: bool) -> DataFrame:
    thin = df.select(pos, fingerprint(df, mode, (pos,)).alias("digest"))
    if ranked:
        return thin.select(F.col(pos).alias("index"), "digest", F.col(pos).alias("_pos"))
    return with_prior_count(thin, pos, out="index").select("index", "digest", F.col(pos).alias("_pos"))


def diff_positional(
    a: DataFrame, b: DataFrame, pos: str = "pos", mode: str = "full", ranked: bool = False
) -> DataFrame:
    """``(index, left_pos, right_pos)`` of record pairs that differ; record *i* meets record *i*.

    ``ranked`` says that ``pos`` already counts 0, 1, 2, ... Otherwise it is ranked first, without
    sorting everything in one task. Call ``same_count`` before: only equally long runs are comparable.
    """
    left = _digests(a, pos, mode, ranked).withColumnsRenamed({"digest": "_l", "_pos": "left_pos"})
    right = _digests(b, pos, mode, ranked).withColumnsRenamed({"digest": "_r", "_pos": "right_pos"})
    pairs = left.join(right, "index")
    return pairs.where(F.col("_l") != F.col("_r")).drop("_l", "_r")


def same_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(left_count, right_count, same)`` in one row."""
    sides = a.select(F.lit(1).alias("l"), F.lit(0).alias("r")).union(
        b.select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = sides.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_count"), F.coalesce(F.sum("r"), F.lit(0)).alias("right_count")
    )
    return counts.withColumn("same", F.col("left_count") == F.col("right_count"))


def comparison_summary(
    a: DataFrame, b: DataFrame, pos: str = "pos", mode: str = "full", ranked: bool = False
) -> DataFrame:
    """One row: counts, mismatches and verdict. Runs of different length fail before any comparison."""
    left = _digests(a, pos, mode, ranked).select("index", F.col("digest").alias("_l"))
    right = _digests(b, pos, mode, ranked).select("index", F.col("digest").alias("_r"))
    pairs = left.join(right, "index", "full")
    counted = pairs.agg(
        F.count("_l").alias("left_count"),
        F.count("_r").alias("right_count"),
        F.count_if(F.col("_l") != F.col("_r")).alias("_differ"),
    )
    return _verdict(counted)


def _verdict(counted: DataFrame) -> DataFrame:
    same = F.col("left_count") == F.col("right_count")
    mismatches = F.when(same, F.col("_differ"))
    return counted.select(
        "left_count",
        "right_count",
        mismatches.alias("mismatches"),
        F.coalesce(mismatches == 0, F.lit(False)).alias("identical"),
    )


def _as_text(df: DataFrame, name: str):
    complex_type = isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(name) if complex_type else F.col(name).cast("string")


def _cells(df: DataFrame, names: list[str], prefix: str) -> list:
    return [_as_text(df, n).alias(f"{prefix}{n}") for n in names]


def _explode_diffs(pairs: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    diffs = F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.col(f"_l_{n}").eqNullSafe(F.col(f"_r_{n}")),
                    F.struct(
                        F.lit(n).alias("field"),
                        F.col(f"_l_{n}").alias("left_value"),
                        F.col(f"_r_{n}").alias("right_value"),
                    ),
                )
                for n in names
            ]
        )
    )
    return pairs.select(*keys, F.explode(diffs).alias("_d")).select(*keys, "_d.*")


def field_diff_positional(
    a: DataFrame, b: DataFrame, pos: str = "pos", mode: str = "full", ranked: bool = False
) -> DataFrame:
    """``(index, field, left_value, right_value)`` for every differing field of the pairs that differ.

    ``mode`` decides which pairs differ; the fields shown are always those of the full view.
    """
    a, b = align(a, b)
    names = _fields(a.columns, "full", (pos,))
    differing = diff_positional(a, b, pos, mode, ranked)
    left = a.select(F.col(pos).alias("left_pos"), *_cells(a, names, "_l_"))
    right = b.select(F.col(pos).alias("right_pos"), *_cells(b, names, "_r_"))
    pairs = differing.join(left, "left_pos").join(right, "right_pos")
    return _explode_diffs(pairs, names, ["index"])


def field_diff_keyed(a: DataFrame, b: DataFrame, key: str = "url", pos: str = "pos") -> DataFrame:
    """Field diffs of records matched by ``key`` and, among equal keys, by order of appearance.

    ``(key, occurrence)`` is unique on both sides, so copies of a key are paired one to one. A record
    with no partner reads as nulls on the other side.
    """
    a, b = align(a, b)
    names = _fields(a.columns, "full", (pos, key))

    def side(df, prefix):
        thin = df.select(pos, key, fingerprint(df, "full", (pos,)).alias("digest"))
        numbered = with_prior_count(thin, pos, [key], out="occ").withColumnRenamed(key, "key")
        return numbered.select(*[F.col(c).alias(prefix + c.replace(pos, "pos")) for c in ("key", "occ", pos, "digest")])

    left, right = side(a, "_l_"), side(b, "_r_")
    matched = left.join(
        right, F.col("_l_key").eqNullSafe(F.col("_r_key")) & (F.col("_l_occ") == F.col("_r_occ")), "full"
    ).where(~F.col("_l_digest").eqNullSafe(F.col("_r_digest")))
    pairs = matched.select(
        F.coalesce("_l_key", "_r_key").alias(key),
        F.coalesce("_l_occ", "_r_occ").alias("occurrence"),
        F.col("_l_pos").alias("_lp"),
        F.col("_r_pos").alias("_rp"),
    )
    cells_a = a.select(F.col(pos).alias("_lp"), *_cells(a, names, "_l_"))
    cells_b = b.select(F.col(pos).alias("_rp"), *_cells(b, names, "_r_"))
    pairs = pairs.join(cells_a, "_lp", "left").join(cells_b, "_rp", "left")
    return _explode_diffs(pairs, names, [key, "occurrence"])


def _digest_counts(a: DataFrame, b: DataFrame, mode: str, exclude: tuple[str, ...]) -> DataFrame:
    def side(df, left, right):
        return df.select(
            fingerprint(df, mode, exclude).alias("digest"), F.lit(left).alias("_l"), F.lit(right).alias("_r")
        )

    return side(a, 1, 0).union(side(b, 0, 1)).groupBy("digest").agg(
        F.sum("_l").alias("left_count"), F.sum("_r").alias("right_count")
    )


def multiset_diff(a: DataFrame, b: DataFrame, mode: str = "full", exclude: tuple[str, ...] = ("pos",)) -> DataFrame:
    """``(digest, left_count, right_count)`` of records that do not occur equally often on both sides.

    The order-free comparison. Copies are counted map-side, so a record repeated in a third of all rows
    still costs one row per task.
    """

    counts = _digest_counts(*align(a, b), mode, exclude)
    return counts.where(F.col("left_count") != F.col("right_count"))


def content_summary(a: DataFrame, b: DataFrame, mode: str = "full", exclude: tuple[str, ...] = ("pos",)) -> DataFrame:
    """The order-free verdict: one row like ``comparison_summary``, a mismatch being a left record too many."""
    a, b = align(a, b)
    extra = F.greatest(F.col("left_count") - F.col("right_count"), F.lit(0))
    counted = _digest_counts(a, b, mode, exclude).agg(
        F.coalesce(F.sum("left_count"), F.lit(0)).alias("left_count"),
        F.coalesce(F.sum("right_count"), F.lit(0)).alias("right_count"),
        F.coalesce(F.sum(extra), F.lit(0)).alias("_differ"),
    )
    return _verdict(counted)
