"""Exact top-k search by integer inner product over KD-trees, one per shard.

Every vector component becomes ``floor(scale * x)``. Rows are dealt to shards along median splits of a bounded
sample, so a shard is a region, and large shards are dealt further by a hash of the id. Each shard builds one
KD-tree: median splits on the widest side, tight bounding boxes around what a node holds, leaves of a few hundred
rows. The largest product a box can reach is the sum over dimensions of the better of its two sides.

A query first searches the shard it falls into. The k-th score found there is a bound that goes along to all other
shards: nodes are visited best bound first, and a tree is left as soon as its best node cannot reach the k-th
score. A node that could only tie is still visited, because a tie may have the smaller id.

Queries meet all shards in blocks, which exact search needs; every row takes part whatever its shard.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.ann import blocks_of, top_ranks
from newsflow.llm.common import hash_sample, usable_vectors, vectors
from newsflow.session import stage

SCALE = 1024
SHARD_ROWS = 16_384
SAMPLE_ROWS = 4_096
LEAF_ROWS = 256
BLOCK_QUERIES = 2_048
EXACT_FLOAT = float(1 << 53)


class Tree:
    """A KD-tree over integer rows. Nodes are numbered; ``left`` is -1 for a leaf, which holds rows ``start:end``."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.arange(len(rows))
        self.left, self.right, self.start, self.end, low, high = [], [], [], [], [], []

        def add(start: int, end: int) -> int:
            own = rows[order[start:end]]
            node = len(self.left)
            self.left.append(-1)
            self.right.append(-1)
            self.start.append(start)
            self.end.append(end)
            low.append(own.min(0))
            high.append(own.max(0))
            return node

        todo = [add(0, len(rows))] if len(rows) else []
        while todo:
            node = todo.pop()
            start, end = self.start[node], self.end[node]
            side = high[node] - low[node]
            if end - start <= leaf_rows or not side.any():
                continue
            axis = int(side.argmax())
            mid = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(rows[order[start:end], axis], mid)]
            self.left[node], self.right[node] = add(start, start + mid), add(start + mid, end)
            todo += [self.left[node], self.right[node]]
        self.rows, self.ids = rows[order], ids[order]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """For each node the largest inner product any point of its box has with the query."""
        return np.where(query >= 0, self.high * query, self.low * query).sum(1)

    def search(self, query: np.ndarray, query_id: int, k: int, known: float) -> list[tuple[float, int]]:
        """The ``k`` best ``(score, id)`` of the tree that can matter beside a k-th score ``known`` elsewhere."""
        if not len(self.ids):
            return []
        bounds = self.bounds(query)
        heap = [(-bounds[0], 0)]
        best: list[tuple[float, int]] = []
        kth = known
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < kth:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if bounds[child] >= kth:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            own = slice(self.start[node], self.end[node])
            scores = self.rows[own] @ query
            ids = self.ids[own]
            good = np.flatnonzero((scores >= kth) & (ids != query_id))
            if not len(good):
                continue
            merged = {i: s for s, i in best}
            for s, i in zip(scores[good].tolist(), ids[good].tolist(), strict=True):
                merged[i] = max(s, merged.get(i, s))
            best = sorted(((s, i) for i, s in merged.items()), key=lambda x: (-x[0], x[1]))[:k]
            if len(best) == k:
                kth = max(kth, best[-1][0])
        return best


def _numbers(rows: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * rows.astype(np.float64))


def _exact(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every product sum is exact in doubles, else as 64-bit integers."""
    most = (np.abs(rows).max(initial=0)) * (np.abs(queries).max(initial=0)) * max(1, rows.shape[1])
    kind = np.float64 if most < EXACT_FLOAT else np.int64
    return rows.astype(kind), queries.astype(kind)


def fit_splits(sample: np.ndarray, shards: int) -> list[tuple[int, float]]:
    """``shards - 1`` median splits (axis, value) in heap order; ``shards`` is a power of two."""
    splits: list[tuple[int, float]] = []
    level = [sample]
    while len(splits) < shards - 1:
        below = []
        for part in level:
            axis = int((part.max(0) - part.min(0)).argmax()) if len(part) else 0
            value = float(np.median(part[:, axis])) if len(part) else 0.0
            splits.append((axis, value))
            below += [part[part[:, axis] < value], part[part[:, axis] >= value]] if len(part) else [part, part]
        level = below
    return splits


def shard_of(rows: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(rows), dtype=np.int64)
    for _ in range((len(splits) + 1).bit_length() - 1):
        axis = np.array([a for a, _ in splits])[node]
        value = np.array([v for _, v in splits])[node]
        node = 2 * node + 1 + (rows[np.arange(len(rows)), axis] >= value)
    return node - len(splits)


def _search_block(dim: int, k: int, scale: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            rows = _numbers(vectors(left["vec"].combine_chunks(), dim), scale)
            queries = _numbers(vectors(right["asked"].combine_chunks(), dim), scale)
            rows, queries = _exact(rows, queries)
            tree = Tree(rows, left["vec_id"].to_numpy())
            known = right["known"].to_pylist()
            for query, query_id, bound in zip(queries, right["query_id"].to_pylist(), known, strict=True):
                best = tree.search(query, query_id, k, -np.inf if bound is None else bound)
                found += [(query_id, i, int(s)) for s, i in best]
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    return run


def search(
    base: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 10,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that meets ``is_query`` (a condition on ``vec_id``) the ``k``
    other rows with the greatest integer inner product, greatest first, ties to smaller ids.

    Rows that ``usable_vectors`` leaves out (null ids and vectors, null or non-finite components, odd lengths) take
    no part; zero vectors do. An id that repeats is one candidate, at its greatest score, and one query, with the
    best of all its vectors. An empty table gives no rows. Other columns are not read.
    """
    points, dim = usable_vectors(base, id_col, vec_col, nonzero=False)
    total = points.count()
    shards = 1 << max(0, int(np.ceil(np.log2(max(1, total) / shard_rows))))
    shards = min(shards, SAMPLE_ROWS // 4)
    sample = hash_sample(points, "vec_id", SAMPLE_ROWS, total).toArrow().sort_by([("vec_id", "ascending")])
    matrix = vectors(sample["vec"].combine_chunks(), dim).astype(np.float64) if dim else np.zeros((0, 1))
    shared = base.sparkSession.sparkContext.broadcast(fit_splits(matrix, shards))

    def place(batches):
        for batch in batches:
            rows = vectors(batch.column(1), dim).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard_of(rows, shared.value), pa.int32()), batch.column(0), batch.column(1)],
                names=["region", "vec_id", "vec"],
            )

    kind = points.schema["vec"].dataType.simpleString()
    placed = stage(points.mapInArrow(place, f"region int, vec_id long, vec {kind}"), "regions")
    # at most 1,024 regions; one with many rows becomes several shards
    sizes = blocks_of(placed, "region", 2 * shard_rows, "n_shards")
    sharded = placed.join(F.broadcast(sizes), "region").select(
        "region", F.pmod(F.xxhash64(F.lit(9), "vec_id"), F.col("n_shards")).cast("int").alias("part"), "vec_id", "vec"
    )
    queries = placed.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("asked"), F.col("region").alias("home"))
    blocks = max(1, -(-queries.count() // block_queries))
    queries = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(9), "query_id"), F.lit(blocks)).cast("int"))

    def meet(asked: DataFrame) -> DataFrame:
        """Search every (region, part) of ``asked`` in blocks of queries."""
        keys = ["region", "part", "block"]
        rows = sharded.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return (
            rows.groupBy(*keys)
            .cogroup(asked.groupBy(*keys))
            .applyInArrow(_search_block(dim, k, scale), "query_id long, vec_id long, score long")
        )

    at_home = queries.withColumns({"region": F.col("home"), "part": F.lit(0), "known": F.lit(None).cast("long")})
    first = stage(meet(at_home.select("region", "part", "block", "query_id", "asked", "known")), "home")
    # the k-th best of k scores is their minimum; fewer than k prove nothing
    known = first.groupBy("query_id").agg(F.when(F.count_distinct("vec_id") >= k, F.min("score")).alias("known"))

    spread = (
        queries.join(known, "query_id", "left")
        .withColumn("region", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .join(F.broadcast(sizes), "region")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)))
        .where(~((F.col("region") == F.col("home")) & (F.col("part") == 0)))
        .select("region", "part", "block", "query_id", "asked", "known")
    )
    return top_ranks(first.unionByName(meet(spread)), k, "high")
