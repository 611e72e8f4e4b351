"""Linked vectors against all pairs by plain arithmetic."""

import math

import numpy as np
import pytest

from newsflow.llm import collisions

SCHEMA = "vec_id long, embedding array<float>, label int, cell int, n string"


def brute(rows, threshold=0.93):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sound = []
    for i, (vec_id, vec, label) in enumerate(rows):
        good = vec_id is not None and label is not None and vec and all(x is not None and math.isfinite(x) for x in vec) and any(vec)
        sound.append(np.array(vec, dtype=np.float32).astype(float) if good else None)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, x in enumerate(sound):
        for j in range(i):
            y = sound[j]
            if x is None or y is None or rows[i][2] != rows[j][2] or len(x) != len(y):
                continue
            x1, y1 = x / np.abs(x).max(), y / np.abs(y).max()
            if x1 @ y1 / math.sqrt((x1 @ x1) * (y1 @ y1)) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(rows[i][0]), find(rows[j][0])))
                root[b] = a
    out = []
    for (vec_id, _, _), x, n in zip(rows, sound, links, strict=True):
        component = vec_id if x is None else find(vec_id)
        out.append((vec_id, n, component, vec_id is None or component == vec_id))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()], key=repr)


def planted(rng, n, dim=64, labels=3):
    """Unrelated vectors, chains of neighbours right at the threshold, tight groups and exact copies."""
    rows = []
    for _ in range(n):
        base = rng.standard_normal(dim)
        base /= np.linalg.norm(base)
        label = int(rng.integers(labels))
        for _ in range(int(rng.choice([1, 1, 1, 2, 6]))):
            side = rng.standard_normal(dim)
            side -= side @ base * base
            side /= np.linalg.norm(side)
            cosine = rng.choice([0.99, 0.95, 0.931, 0.929, 0.9])
            base = cosine * base + math.sqrt(1 - cosine**2) * side
            rows.append(((base * rng.choice([0.01, 1, 30])).astype(np.float32).tolist(), label))
    rows += [rows[0]] * 40 + [(rows[0][0], labels)] * 2
    ids = rng.permutation(len(rows)).tolist()
    return [(i, vec, label) for i, (vec, label) in zip(ids, rows, strict=True)]


@pytest.mark.parametrize("bits, block_rows", [(None, 2048), (0, 50), (4, 2048), (3, 20)])
def test_links_equal_all_pairs(spark, bits, block_rows):
    rows = planted(np.random.default_rng(3), 250)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    want = brute(rows)
    assert got(collisions.near_duplicate_vectors(df, bits=bits, block_rows=block_rows)) == want
    assert max(r[1] for r in want) >= 40 and sum(r[1] > 0 for r in want) > 200


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [0.0, 3.0], 0), (4, [1.0, 0.0], None), (5, None, 0),
        (6, [], 0), (7, [0.0, 0.0], 0), (8, [1.0, None], 0), (9, [nan, 1.0], 0), (10, [inf, 1.0], 0), (None, [1.0, 0.0], 0),
        (11, [1.0, 0.0, 0.0], 0), (12, [1e-40, 0.0], 0), (13, [3e38, 1e30], 0), (14, [-1.0, 0.0], 0), (1, [1.0, 0.0], 0),
        (15, [-0.0, 1.0], 7), (16, [0.0, 1.0], 7),
    ]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    assert got(collisions.near_duplicate_vectors(df)) == brute(rows)
    assert collisions.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_calibration_holds_at_the_threshold():
    """Pairs exactly at the threshold, over many random directions: both ways of missing stay within the bound."""
    rng = np.random.default_rng(9)
    plan = collisions.Plan(0.93, 8)
    n, dim = 20_000, 64
    a = rng.standard_normal((n, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = rng.standard_normal((n, dim))
    side -= (side * a).sum(1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * side
    away = (a - b) @ collisions.directions(dim, collisions.PROJECTIONS, 2)
    assert ((np.abs(away) <= plan.window).sum(1) >= plan.least).mean() > 0.999
    assert (plan.cells(a) == plan.cells(b)).any(1).mean() > 0.998


def test_more_rows_choose_more_cells(spark):
    rng = np.random.default_rng(1)
    few = spark.createDataFrame([("0", v.tolist()) for v in rng.standard_normal((300, 8))], "label string, vec array<double>")
    assert collisions.choose_bits(few, 0.93) == 0
    assert collisions.choose_bits(few, 0.93, row_cost=0) > 0
    assert collisions.Plan(0.93, 12).tables > collisions.Plan(0.93, 4).tables > 1


def test_windows_count_like_a_direct_comparison():
    rng = np.random.default_rng(2)
    left, right = rng.standard_normal((300, 8)), rng.standard_normal((90, 8))
    right[5] = left[7]
    pairs = [(int(i), int(j)) for part in collisions.colliding(left, right, 0.4, 4) for i, j in zip(*part, strict=True)]
    inside = (np.abs(left[:, None] - right[None]) <= 0.4).sum(2) >= 4
    assert sorted(pairs) == [tuple(x) for x in np.argwhere(inside).tolist()] and (7, 5) in pairs
