import random

import numpy as np
import pytest

from newsflow.llm import components, neardup


def naive_set(text, size):
    words = neardup.words(text)
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def naive(rows, size, threshold):
    """Component of each id by comparing all pairs."""
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, naive_set(t, size)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}


def corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" if i % 7 else f"é{i}" for i in range(3000)]
    rows = []
    for g in range(25):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 12, 40, 150]))
        for _ in range(rng.randint(1, 8)):
            copy = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(copy)))
    # a chain: each text links with its neighbours only
    chain = rng.choices(vocabulary, k=400)
    for k in range(12):
        rows.append((len(rows), " ".join(chain[k * 10 : k * 10 + 200])))
    return rows


@pytest.mark.parametrize("size,threshold", [(3, 85), (5, 80)])
@pytest.mark.parametrize("block", [neardup.BLOCK_SHINGLES, 300])
def test_equals_all_pairs(spark, size, threshold, block):
    rows = corpus() + [(9000, None), (9001, ""), (9002, " \n\t "), (9003, " \n\t ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(docs, shingle=size, threshold=threshold, block_shingles=block).collect()
    assert {r.doc_id: r.component_id for r in got} == naive(rows, size, threshold)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(naive_set(t, size)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_dense_group_over_blocks(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(docs, shingle=3, threshold=85, block_shingles=4000).collect()
    assert {r.doc_id: r.component_id for r in got} == naive(rows, 3, 85)


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(30))
    rows = [(5, text), (3, text), (3, other), (8, other), (None, text), (None, None), (5, text)]
    docs = spark.createDataFrame([(i, t, "c", "r") for i, t in rows], "doc_id long, text string, component string, rep string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()), key=str)
    assert got == sorted(
        [(5, 26, 3, False), (3, 26, 3, True), (3, 26, 3, True), (8, 26, 3, False), (None, 26, None, True),
         (None, 0, None, True), (5, 26, 3, False)], key=str)
    left = neardup.one_of_each(docs)
    assert left.columns == docs.columns
    assert [r.doc_id for r in left.where("doc_id is not null").collect()] == [3]
    assert left.where("doc_id is null").count() == 2
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(2)
    share = rng.integers(0, 2**63, 4000).astype(np.uint64)
    a = np.unique(np.concatenate([share, rng.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2)]))
    b = np.unique(np.concatenate([share, rng.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2)]))
    a, b = np.unique(neardup._mix(a)), np.unique(neardup._mix(b))
    real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    equal = (neardup.registers(a) == neardup.registers(b)).mean()
    assert abs(neardup.similarity(np.array(equal)) - real) < 0.12


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)]
    edges += [(500, i) for i in range(501, 560)] + [(7, 7)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for u, v in edges:
        if u != v:
            x, y = sorted((find(u), find(v)))
            root[y] = x
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    assert {r.node: r.component for r in got.collect()} == {i: find(i) for i in root}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0
