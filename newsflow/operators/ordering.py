"""Ordered running counts without a window over a whole group.

Positions are longs that are unique within a group. Their high bits split a group into ranges of at
most 2**21 positions, ranges into blocks of at most 2**21 ranges, and at most 2**22 blocks cover
every long, so each window below sees a bounded number of rows whatever the size of the group or
the spread of its positions. Range and block totals are combined map-side.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE_BITS = 21


def with_prior_count(
    df: DataFrame,
    pos: str,
    group: list[str] | None = None,
    flag: str | None = None,
    out: str = "prior",
    below: int | None = None,
    bits: int = RANGE_BITS,
) -> DataFrame:
    """Add ``out``: how many rows of the group (with ``flag`` true) stand at smaller positions.

    ``below`` keeps only rows whose count is smaller; whole ranges past it are dropped before the
    rows are sorted. Rows are shuffled once, by group and range, for both the join and the window.
    ``df`` is read twice, so it should be a scan or a staged table. A null group is a group.
    """
    one = F.lit(1) if flag is None else F.when(F.col(flag), 1).otherwise(0)
    keys = {}
    for i, name in enumerate(group or []):
        keys[f"_g{i}"] = F.coalesce(F.col(name).cast("string"), F.lit(""))
        keys[f"_null{i}"] = F.col(name).isNull()
    rows = df.withColumns({**keys, "_range": F.shiftright(F.col(pos).cast("long"), bits)})

    ranges = rows.groupBy(*keys, "_range").agg(F.sum(one).alias("_n"))
    ranges = ranges.withColumn("_block", F.shiftright("_range", bits))
    blocks = ranges.groupBy(*keys, "_block").agg(F.sum("_n").alias("_n"))

    before = Window.rowsBetween(Window.unboundedPreceding, -1)

    def running(partition, order):
        return F.coalesce(F.sum("_n").over(before.partitionBy(*partition).orderBy(order)), F.lit(0))

    blocks = blocks.select(*keys, "_block", running(keys or [F.lit(0)], "_block").alias("_block_base"))
    ranges = ranges.select(*keys, "_block", "_range", running([*keys, "_block"], "_range").alias("_range_base"))
    bases = ranges.join(blocks, [*keys, "_block"]).select(
        *keys, "_range", (F.col("_range_base") + F.col("_block_base")).alias("_base")
    )

    rows = rows.join(bases, [*keys, "_range"])
    if below is not None:
        rows = rows.where(F.col("_base") < below)
    in_range = before.partitionBy(*keys, "_range").orderBy(pos)
    counted = rows.select(
        *df.columns, (F.col("_base") + F.coalesce(F.sum(one).over(in_range), F.lit(0))).alias(out)
    )
    return counted if below is None else counted.where(F.col(out) < below)
