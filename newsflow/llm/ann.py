"""Approximate nearest neighbours by learned partitions.

On a sample of at most ``2 * sample_rows`` vectors: the neighbour graph is cut into balanced partitions with few
cut edges, and a small network learns to tell from a vector which partitions hold its neighbours. Every row of
the table is then indexed in the partition the network finds most probable, and a query is routed to its several
most probable partitions, where exact distances rank all rows of those partitions.

The number of partitions a query visits is the smallest that reaches ``target`` recall on sample rows the network
was not trained on, so hard data costs more visits rather than recall.

Partitions and the query lists routed to them are dealt to blocks of bounded size by a hash of the id, so a
partition that holds a third of the rows, or gets a third of the queries, is many tasks. What is broadcast is
the network: ``(dim + parts) * hidden`` numbers.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import hash_sample, usable_vectors, vectors
from newsflow.session import stage

SAMPLE_ROWS = 6_000
PARTS = 16
HIDDEN = 128
GRAPH_NEIGHBOURS = 10
TARGET = 0.96
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 2_048
SLACK = 1.05


def nearest(queries: np.ndarray, base: np.ndarray, k: int, skip_self: bool = False) -> np.ndarray:
    """Positions of the ``k`` nearest rows of ``base`` for each query."""
    norms = (base**2).sum(1)
    found = np.empty((len(queries), min(k, len(base) - skip_self)), dtype=np.int64)
    for a in range(0, len(queries), 512):
        d = norms[None, :] - 2 * queries[a : a + 512] @ base.T
        if skip_self:
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        n = found.shape[1]
        part = np.argpartition(d, n - 1, axis=1)[:, :n] if n else np.zeros((len(d), 0), dtype=np.int64)
        found[a : a + 512] = part
    return found


def balanced_partition(rows: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 30) -> np.ndarray:
    """A partition number for each node of a neighbour graph: sizes within ``SLACK`` of equal, few edges cut.

    Starts from balanced median splits along principal directions, then moves nodes to the partition of most of
    their neighbours, largest gain first, while the target has room.
    """
    n = len(rows)
    where = np.zeros(n, dtype=np.int64)
    for _ in range(int(np.log2(parts))):
        fresh = where * 2
        for p in np.unique(where):
            own = np.flatnonzero(where == p)
            centred = rows[own] - rows[own].mean(0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            fresh[own[np.argsort(centred @ axis, kind="stable")[len(own) // 2 :]]] += 1
        where = fresh
    sources = np.repeat(np.arange(n), graph.shape[1])
    ends = np.concatenate([graph.ravel(), sources])
    starts = np.concatenate([sources, graph.ravel()])
    room = int(np.ceil(n / parts * SLACK))
    least = int(n / parts / SLACK)
    for _ in range(rounds):
        votes = np.bincount(starts * parts + where[ends], minlength=n * parts).reshape(n, parts)
        own = votes[np.arange(n), where]
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - own
        sizes = np.bincount(where, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            a, b = where[i], best[i]
            if sizes[b] < room and sizes[a] > least:
                where[i] = b
                sizes[a] -= 1
                sizes[b] += 1
                moved += 1
        if not moved:
            break
    return where


@dataclass
class Router:
    """A network with one hidden layer; ``visits`` partitions are searched per query."""

    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray
    visits: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        # scaling keeps very long vectors apart by direction only; ranks of partitions do not depend on units
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
        hidden = np.maximum(0, rows / np.where(norms == 0, 1, norms) @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def home(self, rows: np.ndarray) -> np.ndarray:
        return self.scores(rows).argmax(1)

    def route(self, rows: np.ndarray) -> np.ndarray:
        return np.argsort(-self.scores(rows), axis=1, kind="stable")[:, : self.visits]


def _train(rows: np.ndarray, targets: np.ndarray, seed: int = 3, epochs: int = 40, rate: float = 0.003) -> Router:
    """Fit the network to the distribution of each row's neighbours over partitions (cross entropy, Adam)."""
    rng = np.random.default_rng(seed)
    dim, parts = rows.shape[1], targets.shape[1]
    net = Router(
        rng.normal(0, (2 / dim) ** 0.5, (dim, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, parts)), np.zeros(parts), parts,
    )
    names = ("first", "first_bias", "second", "second_bias")
    moments = {k: [np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))] for k in names}
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True).clip(1e-300)
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 256)):
            x = unit[batch]
            hidden = np.maximum(0, x @ net.first + net.first_bias)
            logits = hidden @ net.second + net.second_bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            error = (p / p.sum(1, keepdims=True) - targets[batch]) / len(batch)
            back = (error @ net.second.T) * (hidden > 0)
            grads = {
                "first": x.T @ back + 1e-4 * net.first, "first_bias": back.sum(0),
                "second": hidden.T @ error + 1e-4 * net.second, "second_bias": error.sum(0),
            }
            step += 1
            lift = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():
                m = moments[k]
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                setattr(net, k, getattr(net, k) - lift * m[0] / (np.sqrt(m[1]) + 1e-8))
    return net


def fit_router(sample: np.ndarray, parts: int, k: int, target: float = TARGET) -> Router:
    """Partition the sample's neighbour graph, train the network, choose the number of visits on held-out rows."""
    n = len(sample)
    if n < 4 * parts:
        dim = sample.shape[1] if n else 1
        return Router(np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = nearest(sample, sample, GRAPH_NEIGHBOURS, skip_self=True)
    where = balanced_partition(sample, graph, parts)
    targets = np.zeros((n, parts))
    for column in graph.T:
        targets[np.arange(n), where[column]] += 1
    targets[np.arange(n), where] += 1
    targets /= targets.sum(1, keepdims=True)
    probe = np.arange(n) % 8 == 0
    net = _train(sample[~probe], targets[~probe])
    home = net.home(sample)
    order = np.argsort(-net.scores(sample[probe]), axis=1, kind="stable")
    truth = home[nearest(sample, sample, k, skip_self=True)[probe]]
    rank = np.argsort(order, axis=1)
    hit = np.take_along_axis(rank, truth, axis=1)
    for visits in range(1, parts + 1):
        if (hit < visits).mean() >= target:
            break
    net.visits = visits
    return net


def parts_for(rows: int) -> int:
    """Partitions of a table: 16 up to 262,144 rows, then doubling with it up to 1,024."""
    return int(min(1024, max(PARTS, 2 ** np.ceil(np.log2(max(1, rows) / 16_384)))))


def build(points: DataFrame, dim: int, k: int = 10, sample_rows: int = SAMPLE_ROWS, target: float = TARGET) -> tuple[DataFrame, Router]:
    """``(part, vec_id, vec)`` of every row of ``points``, staged, and the router."""
    total = points.count()
    sample = hash_sample(points, "vec_id", sample_rows, total).toArrow().sort_by([("vec_id", "ascending")])
    matrix = vectors(sample["vec"].combine_chunks(), dim).astype(np.float64) if dim else np.zeros((0, 1))
    router = fit_router(matrix, parts_for(total), k, target)
    shared = points.sparkSession.sparkContext.broadcast(router)

    def place(batches):
        for batch in batches:
            rows = vectors(batch.column(1), dim).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shared.value.home(rows), pa.int32()), batch.column(0), batch.column(1)],
                names=["part", "vec_id", "vec"],
            )

    kind = points.schema["vec"].dataType.simpleString()
    return stage(points.mapInArrow(place, f"part int, vec_id long, vec {kind}"), "index"), router


def _block_search(dim: int, k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left["vec_id"].to_numpy()
        query_ids = right["query_id"].to_numpy()
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(ids) and len(query_ids):
            base = vectors(left["vec"].combine_chunks(), dim).astype(np.float64)
            asked = vectors(right["vec"].combine_chunks(), dim).astype(np.float64)
            norms = (base**2).sum(1)
            for a in range(0, len(asked), 256):
                part = asked[a : a + 256]
                rough = norms[None, :] - 2 * part @ base.T
                rough[query_ids[a : a + 256, None] == ids[None, :]] = np.inf
                n = min(k, len(ids))
                kth = np.partition(rough, n - 1, axis=1)[:, n - 1]
                for i, q in enumerate(part):
                    # rounding of the expanded form is far below this margin; exact distances decide
                    margin = 1e-9 * (abs(kth[i]) + 2 * q @ q + 1) if np.isfinite(kth[i]) else 0
                    at = np.flatnonzero((rough[i] <= kth[i] + margin) & np.isfinite(rough[i]))
                    exact = np.sqrt(((base[at] - q) ** 2).sum(1))
                    best = np.lexsort((ids[at], exact))
                    _, once = np.unique(ids[at][best], return_index=True)
                    best = best[np.sort(once)][:k]
                    out["query_id"].append(np.full(len(best), query_ids[a + i]))
                    out["vec_id"].append(ids[at][best])
                    out["score"].append(exact[best])
        flat = {c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()}
        return pa.table(
            {
                "query_id": pa.array(flat["query_id"].astype(np.int64)),
                "vec_id": pa.array(flat["vec_id"].astype(np.int64)),
                "score": pa.array(flat["score"].astype(np.float64)),
            }
        )

    return search


def blocks_of(df: DataFrame, key: str, rows: int, out: str) -> DataFrame:
    """``(key, out)``: into how many blocks of about ``rows`` rows each key's rows are dealt."""
    return df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias(out))


def top_ranks(found: DataFrame, k: int, best_first) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of each query, one row per candidate id, ties to smaller ids."""
    # one id may come from several partitions if it repeats in the table; its best score counts
    once = found.groupBy("query_id", "vec_id").agg((F.min if best_first == "low" else F.max)("score").alias("score"))
    order = F.col("score").asc() if best_first == "low" else F.col("score").desc()
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search(
    base: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 10,
    sample_rows: int = SAMPLE_ROWS,
    target: float = TARGET,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that meets ``is_query`` (a condition on ``vec_id``) its ``k``
    nearest found among all other rows, by Euclidean distance in double precision, nearest first, ties to smaller ids.

    Rows that ``usable_vectors`` leaves out (null ids and vectors, zero vectors, null or non-finite components, odd
    lengths) take no part. An id that repeats is one candidate, at its least distance, and one query, with the
    nearest of all its vectors. An empty table gives no rows. Other columns are not read.
    """
    points, dim = usable_vectors(base, id_col, vec_col, nonzero=True)
    index, router = build(points, dim, k, sample_rows, target)
    shared = base.sparkSession.sparkContext.broadcast(router)

    def route(batches):
        for batch in batches:
            rows = vectors(batch.column(1), dim).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared.value.route(rows).tolist(), pa.list_(pa.int32()))],
                names=["query_id", "vec", "parts"],
            )

    kind = index.schema["vec"].dataType.simpleString()
    routed = index.where(is_query).select("vec_id", "vec").mapInArrow(route, f"query_id long, vec {kind}, parts array<int>")
    routed = stage(routed.select("query_id", "vec", F.explode("parts").alias("part")), "routed")

    # at most 1,024 partitions, so both tables of block counts are small by construction
    rows_in = blocks_of(index, "part", block_rows, "n_rows")
    asked_in = blocks_of(routed, "part", block_queries, "n_queries")
    dealt = rows_in.join(asked_in, "part")
    row_block = F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.col("n_rows")).cast("int")
    query_block = F.pmod(F.xxhash64(F.lit(7), "query_id"), F.col("n_queries")).cast("int")
    left = index.join(F.broadcast(dealt), "part").select(
        "part",
        row_block.alias("row_block"),
        F.explode(F.sequence(F.lit(0), F.col("n_queries") - 1)).alias("query_block"),
        "vec_id",
        "vec",
    )
    right = routed.join(F.broadcast(dealt), "part").select(
        "part",
        F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1)).alias("row_block"),
        query_block.alias("query_block"),
        "query_id",
        "vec",
    )
    keys = ["part", "row_block", "query_block"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_block_search(dim, k), "query_id long, vec_id long, score double")
    )
    return top_ranks(found, k, "low")
