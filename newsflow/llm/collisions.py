"""Near-duplicate embeddings by counting window collisions on many one-dimensional projections.

Vectors of one label are compared by cosine. The difference of two unit vectors with cosine ``c`` falls on a random
Gaussian direction as a normal variable of variance ``2 * (1 - c)``, whatever the data are. So the chance that one
vector lies in the window around the other on a projection is known for pairs at the threshold, and the number of such
collisions over ``PROJECTIONS`` independent directions is binomial.

1. Equal vectors of a label form one class with a weight; only classes are compared.
2. Classes are dealt to cells by the signs of ``bits`` projections, in as many tables as it takes until a pair at
   the threshold shares no cell with probability below ``MISSED``. How many bits pay is priced on the measured cell sizes of
   all rows: a small table is one cell per label, a large one has many. A cell beyond ``BLOCK_ROWS`` is dealt to blocks,
   and each pair of blocks is a task's work.
3. In a cell every projection is sorted; the window around a query is a range of ranks. Pairs that collide at least
   as often as all but ``MISSED`` of the pairs at the threshold do are verified on the vectors themselves. A pair that shares
   cells in several tables counts in the first.
4. A task returns the weight linked to each class and a spanning forest of its links, no pairs. Components of the
   forests give the groups.
"""

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_groups
from newsflow.llm.components import components
from newsflow.operators.skew import hot_keys, key_counts, listed, lookup_join
from newsflow.session import stage

PROJECTIONS = 32
MISSED = 1e-4
MAX_BITS = 20
BLOCK_ROWS = 2048
QUERIES_AT_ONCE = 256
#: What moving a row once more costs, in compared pairs.
ROW_COST = 100


def least_collisions(trials: int, chance: float, missed: float) -> int:
    """The greatest count that a binomial variable stays below with probability at most ``missed``."""
    below = 0.0
    for n in range(trials + 1):
        below += math.comb(trials, n) * chance**n * (1 - chance) ** (trials - n)
        if below > missed:
            return n
    return trials


@lru_cache(maxsize=8)
def directions(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


@dataclass(frozen=True)
class Plan:
    """Cells and windows for a threshold. With 0 bits there is one table of one cell."""

    threshold: float
    bits: int
    missed: float = MISSED

    @property
    def tables(self) -> int:
        together = (1 - math.acos(self.threshold) / math.pi) ** self.bits
        return 1 if together >= 1 else math.ceil(math.log(self.missed) / math.log(1 - together))

    @property
    def window(self) -> float:
        return math.sqrt(2 * (1 - self.threshold))

    @property
    def least(self) -> int:
        return least_collisions(PROJECTIONS, math.erf(math.sqrt(0.5)), self.missed)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """The cell of each row in each table. Tables use different numbers."""
        if not self.bits:
            return np.zeros((len(unit), 1), dtype=np.int64)
        signs = unit @ directions(unit.shape[1], self.tables * self.bits, 1) > 0
        codes = signs.reshape(len(unit), self.tables, self.bits) @ (1 << np.arange(self.bits, dtype=np.int64))
        return codes + (np.arange(self.tables, dtype=np.int64) << self.bits)


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in double precision, scaled where squares would leave its range, and their lengths."""
    raw = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    top = np.abs(raw).max(1, initial=0.0)
    raw = np.where(((top > 1e100) | (top < 1e-100))[:, None], raw / top[:, None], raw)
    return raw, np.sqrt(np.einsum("ij,ij->i", raw, raw))


def by_dimension(batch: pa.RecordBatch, name: str):
    """``(dim, rows)`` of a batch whose vectors may differ in length."""
    lengths = np.diff(batch.column(name).offsets.to_numpy())
    for dim in np.unique(lengths):
        yield int(dim), batch.filter(pa.array(lengths == dim)) if (lengths != dim).any() else batch


def _cells(plan: Plan):
    def run(batches):
        for batch in batches:
            for dim, rows in by_dimension(batch, "vec"):
                raw, norm = matrix(rows.column("vec"), dim)
                cells = plan.cells(raw / norm[:, None])
                flat = pa.array(cells.ravel(), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1) * cells.shape[1], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "cells"])

    return run


class Labels:
    """Components of positions by vectorised union of many links at once."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root[:] = root[root]


def colliding(left: np.ndarray, right: np.ndarray, window: float, least: int):
    """``(i, j)`` positions of pairs with at least ``least`` projections on which j lies in the window around i.

    Rows are vectors, columns projections. Each projection of ``right`` is sorted once; the window of a query is a
    range of ranks.
    """
    order = np.argsort(right, axis=0, kind="stable")
    small = np.uint16 if len(right) < 1 << 16 else np.uint32
    rank = np.empty(right.shape[::-1], dtype=small)
    for j in range(right.shape[1]):
        rank[j, order[:, j]] = np.arange(len(right), dtype=small)
    ordered = np.take_along_axis(right, order, axis=0)
    for start in range(0, len(left), QUERIES_AT_ONCE):
        queries = left[start : start + QUERIES_AT_ONCE]
        count = np.zeros((len(queries), len(right)), dtype=np.uint8)
        for j in range(right.shape[1]):
            low = np.searchsorted(ordered[:, j], queries[:, j] - window, "left")
            high = np.searchsorted(ordered[:, j], queries[:, j] + window, "right")
            # unsigned: ranks below the window wrap around to large numbers
            count += (rank[j] - low.astype(small)[:, None]) < (high - low).astype(small)[:, None]
        i, j = np.nonzero(count >= least)
        yield start + i, j


def _compare(plan: Plan):
    def run(key, table):
        if table.num_rows < 2:
            return None
        dim, low, high = key[1], key[3], key[4]
        raw, norm = matrix(table.column("vec").combine_chunks(), dim)
        unit = raw / norm[:, None]
        block, cls = table.column("block").to_numpy(), table.column("cls").to_numpy()
        rep, weight = table.column("rep").to_numpy(), table.column("weight").to_numpy()
        cells = plan.cells(unit)
        earlier = cells[:, : table.column("at")[0].as_py()]
        projected = unit @ directions(dim, PROJECTIONS, 2)
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        linked, labels = np.zeros(len(unit), dtype=np.int64), Labels(len(unit))
        for i, j in colliding(projected[left], projected[right], plan.window, plan.least):
            i, j = left[i], right[j]
            if low == high:
                i, j = i[i < j], j[i < j]
            for start in range(0, len(i), 16_384):
                a, b = i[start : start + 16_384], j[start : start + 16_384]
                cosine = np.einsum("ij,ij->i", raw[a], raw[b]) / (norm[a] * norm[b])
                near = (cosine >= plan.threshold) & ~(earlier[a] == earlier[b]).any(1)
                a, b = a[near], b[near]
                np.add.at(linked, a, weight[b])
                np.add.at(linked, b, weight[a])
                labels.link(a, b)
        tied, counted = np.flatnonzero(labels.root != np.arange(len(unit))), np.flatnonzero(linked)
        none = [None]
        return pa.table(
            {
                "u": pa.array([*rep[tied].tolist(), *none * len(counted)], pa.int64()),
                "v": pa.array([*rep[labels.root[tied]].tolist(), *none * len(counted)], pa.int64()),
                "cls": pa.array([*none * len(tied), *cls[counted].tolist()], pa.int64()),
                "n": pa.array([*none * len(tied), *linked[counted].tolist()], pa.int64()),
            }
        )

    return run


def choose_bits(classes: DataFrame, threshold: float, row_cost: int = ROW_COST) -> int:
    """The number of sign bits with the least price: pairs compared plus rows moved, over all tables.

    Cell sizes are counted over all rows for the first table; the rows fetched are one per number of bits tried.
    """
    tried = list(range(0, MAX_BITS + 1, 2))
    most = Plan(threshold, MAX_BITS)

    def codes(batches):
        for batch in batches:
            for dim, rows in by_dimension(batch, "vec"):
                raw, norm = matrix(rows.column("vec"), dim)
                signs = raw / norm[:, None] @ directions(dim, most.bits, 1) > 0
                yield pa.RecordBatch.from_arrays(
                    [rows.column("label"), pa.array(signs @ (1 << np.arange(most.bits, dtype=np.int64)), pa.int64())], names=["label", "code"]
                )

    coded = classes.select("label", "vec").mapInArrow(codes, "label string, code long")
    prefix = coded.select("label", "code", F.explode(F.array(*map(F.lit, tried))).alias("bits"))
    cells = prefix.groupBy("label", "bits", F.expr("code & (shiftleft(1L, bits) - 1)").alias("code")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    sizes = cells.groupBy("bits").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("n")).alias("pairs")).collect()
    prices = [(Plan(threshold, r.bits).tables * (r.pairs / 2 + r.rows * row_cost), r.bits) for r in sizes]
    return min(prices, default=(0, 0))[1]


def near_duplicate_vectors(
    df: DataFrame,
    vec_id: str = "vec_id",
    vec: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    bits: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``.

    Rows of one label and one dimension are linked when their cosine, in double precision, is at least ``threshold``.
    No pair below it is linked; a pair at it is missed with a probability of at most ``2 * MISSED``, a closer one
    less often. ``n_links`` counts other rows linked directly, ``component_id`` is the smallest id reachable and ``kept`` marks it.
    Rows whose vector is null, empty, zero or holds null or non-finite components, or whose label is null, link with
    nothing. Rows without an id do so too; their component is null and they are kept. Rows that share an id share a
    component if they can link at all. Other columns are not read. An empty table gives no rows. ``bits`` overrides the
    priced choice.
    """
    rows = df.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vec).alias("vec")
    )
    sound = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound, F.lit(False))
    # 128 bits of two hashes and the label name a class; equal vectors always share it
    digest = F.concat_ws(":", F.hex(F.xxhash64(F.lit(1), "vec")), F.hex(F.xxhash64(F.lit(2), F.reverse("vec"))), "label")
    named = rows.withColumn("class", F.when(usable, digest))
    classes = stage(
        named.where("class is not null")
        .groupBy("class")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"), F.first("vec").alias("vec"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "vector-classes",
    )
    plan = Plan(threshold, choose_bits(classes, threshold) if bits is None else bits)

    element = classes.schema["vec"].dataType.simpleString()
    thin = "label string, cls long, rep long, weight long"
    celled = classes.select("label", "cls", "rep", "weight", "vec").mapInArrow(_cells(plan), f"{thin}, vec {element}, cells array<long>")
    dealt = celled.select("label", "cls", "rep", "weight", "vec", F.size("vec").alias("dim"), F.posexplode("cells").alias("at", "cell"))
    dealt = dealt.withColumn("place", F.xxhash64("label", "dim", "cell"))
    large = listed(hot_keys(key_counts(dealt, "place"), "place", block_rows))
    if large is None:
        dealt = dealt.withColumn("n_blocks", F.lit(1))
    else:
        dealt = dealt.join(large, "place", "left").withColumn("n_blocks", F.coalesce("_salts", F.lit(1)).cast("int"))
    block = F.pmod(F.xxhash64(F.lit(3), "cls"), F.col("n_blocks")).cast("int")
    candidates = (
        dealt.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select("label", "dim", "cell", "low", "high", "block", "at", "cls", "rep", "weight", "vec")
    )
    compared = stage(
        map_groups(candidates, ["label", "dim", "cell", "low", "high"], ["cls"], _compare(plan), "u long, v long, cls long, n long"),
        "vector-links",
    )
    linked = compared.where("cls is not null").groupBy("cls").agg(F.sum("n").alias("n"))

    # an id in several classes ties them; other members need no edge
    member = lookup_join(stage(named.select("vec_id", "class"), "vector-members"), classes.select("class", "cls", "rep", "weight"), "class", "vec_id")
    member = stage(member, "vector-classed")
    shared = member.where("rep is not null").groupBy("vec_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a <> b")
    ties = member.where("rep is not null").join(shared.select("vec_id"), "vec_id", "left_semi").where("vec_id <> rep")
    edges = compared.where("u is not null").select("u", "v").unionByName(ties.select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
    found = components(edges)

    results = (
        classes.select("class", "cls", "rep", "weight")
        .join(linked, "cls", "left")
        .join(found, F.col("rep") == F.col("node"), "left")
        .select(
            "class",
            (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    return lookup_join(member.select("vec_id", "class"), stage(results, "vector-results"), "class", "vec_id").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
