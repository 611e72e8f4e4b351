import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import ann, kdtree

ODD = [
    (None, [1.0] * 8), (5000, None), (5001, []), (5002, [float("nan")] * 8), (5003, [float("inf")] + [0.0] * 7),
    (5004, [None] * 8), (5005, [1.0] * 3), (5006, [0.0] * 8),
]
SCHEMA = "vec_id long, embedding array<float>, rank string, part string"


def rows_of(n=1500, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    rows = (centres[rng.integers(0, 12, n)] + rng.normal(scale=0.4, size=(n, 8))).astype(np.float32)
    rows[n // 2 : n // 2 + 300] = rows[0]  # a third of the rows are one vector
    return rows


def table(spark, rows, extra=()):
    data = [(i, r.tolist(), "x", "y") for i, r in enumerate(rows)] + [(*r, "x", "y") for r in extra]
    return spark.createDataFrame(data, SCHEMA)


def test_exact_search_equals_brute_force(spark):
    rows = rows_of()
    numbers = np.floor(1024 * rows.astype(np.float64)).astype(np.int64)
    got = kdtree.search(table(spark, rows, ODD), F.col("vec_id") % 50 == 0, shard_rows=128, block_queries=8).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids = np.array([*range(len(rows)), 5006])
    numbers = np.vstack([numbers, np.zeros((1, 8), dtype=np.int64)])
    for q in [*range(0, len(rows), 50)]:
        scores = numbers @ numbers[q]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:10]
        assert sorted(found[q]) == [(n + 1, ids[i], scores[i]) for n, i in enumerate(order)]


def test_tree_prunes_and_keeps_ties():
    rng = np.random.default_rng(1)
    rows = np.vstack([rng.integers(-5, 5, (400, 3)), np.full((200, 3), 90)]).astype(np.float64)
    tree = kdtree.Tree(rows, np.arange(600)[::-1].copy(), leaf_rows=16)
    best = tree.search(np.array([1.0, 1.0, 1.0]), -1, 5, -np.inf)
    assert best == [(270.0, i) for i in range(5)]
    assert tree.search(np.array([1.0, 1.0, 1.0]), -1, 5, 271.0) == []


def test_learned_partitions_recall(spark):
    rows = rows_of(3000, 2)
    got = ann.search(table(spark, rows, ODD), F.col("vec_id") % 20 == 0, sample_rows=1000, block_rows=200, block_queries=16)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    wide = rows.astype(np.float64)
    hits = total = 0
    for q in range(0, len(rows), 20):
        exact = np.sqrt(((wide - wide[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(len(rows)), exact)) if i != q][:10]
        mine = sorted(found[q])
        assert [n for n, *_ in mine] == list(range(1, len(mine) + 1))
        assert all(np.isclose(s, exact[i], rtol=1e-12, atol=0) for _, i, s in mine)
        assert mine == sorted(mine, key=lambda x: (x[2], x[1]))
        hits += len({i for _, i, _ in mine} & set(order))
        total += len(order)
    assert hits / total >= 0.9


def test_learned_partitions_recall_on_given_vectors(spark):
    base = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = base.select("vec_id", "embedding").toPandas()
    wide = np.stack(data.embedding).astype(np.float64)
    ids = data.vec_id.to_numpy()
    got = ann.search(base, F.col("vec_id") % 20 == 0).toPandas()
    hits = total = 0
    for q, own in got.groupby("query_id"):
        exact = ((wide - wide[ids == q][0]) ** 2).sum(1)
        order = [i for i in ids[np.lexsort((ids, exact))] if i != q][:10]
        hits += len(set(own.vec_id) & set(order))
        total += len(order)
    assert total == 1000 and hits / total >= 0.9


@pytest.mark.parametrize("search", [ann.search, kdtree.search])
def test_small_and_empty_tables(spark, search):
    empty = table(spark, np.zeros((0, 8), dtype=np.float32))
    assert search(empty, F.col("vec_id") >= 0).count() == 0
    assert search(table(spark, np.zeros((0, 8), np.float32), ODD[:6]), F.col("vec_id") >= 0).count() == 0
    three = table(spark, np.eye(3, 8, dtype=np.float32))
    got = search(three, F.col("vec_id") >= 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 0), (2, 2, 1)]
    # an id that repeats is one candidate and one query
    twice = table(spark, np.eye(3, 8, dtype=np.float32)).unionByName(table(spark, np.eye(2, 8, dtype=np.float32)))
    got = search(twice, F.col("vec_id") >= 0).collect()
    assert len({(r.query_id, r.vec_id) for r in got}) == len(got) == 6


def test_partition_is_balanced_and_cuts_little():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(16, 8))[rng.integers(0, 16, 1600)] * 5 + rng.normal(size=(1600, 8))
    graph = ann.nearest(rows, rows, 10, skip_self=True)
    where = ann.balanced_partition(rows, graph, 16)
    sizes = np.bincount(where, minlength=16)
    assert sizes.max() <= np.ceil(100 * ann.SLACK) + 1 and sizes.min() >= 100 / ann.SLACK - 2
    assert (where[graph] == where[:, None]).mean() > 0.6
