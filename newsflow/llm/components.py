"""Connected components of an edge table, by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.session import stage

MAX_ROUNDS = 60


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang neighbours onto the smallest vertex near them. Minima combine map-side, so a hub is one row per task."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    near = both.join(low, "u")
    hung = near.where(F.col("v") != F.col("m") if small else F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    if small:
        hung = hung.unionByName(low.where("u <> m").select("u", F.col("m").alias("v")))
    return hung.where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = MAX_ROUNDS) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; the component is its smallest node.

    Edges may repeat, point either way and be loops. No edges give no rows. Each round is written to the
    shared folder, so that lineage stays short and a lost executor costs a task. The number of rounds grows
    with the logarithm of the node count.
    """
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _signature(edges)
    for _ in range(rounds):
        edges = stage(_star(_star(edges, small=False), small=True), "stars")
        after = _signature(edges)
        if after == before:
            members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = after
    raise RuntimeError(f"components not settled after {rounds} rounds")
