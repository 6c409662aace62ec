"""Near-duplicate vectors against all pairs, and the grid's traversal and recall."""

import random

import numpy as np
import pytest

from spanlake.llm import vector_duplicates as vd

SCHEMA = "vec_id bigint, embedding array<{}>, label int, key string, cells int"


def brute(rows, threshold=vd.THRESHOLD):
    """``(id, links, component)`` of each row, by all pairs."""
    vectors = []
    for _, e, label in rows:
        ok = label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
        vectors.append(np.array(e, np.float64) if ok else None)
    near = [set() for _ in rows]
    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            x, y = a / np.abs(a).max(), b / np.abs(b).max()
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                near[i].add(j)
                near[j].add(i)
    made = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        made.append((row[0], len(near[i]), min(ids, default=None)))
    return sorted(made, key=repr)


def found(spark, rows, kind="float", **how):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA.format(kind))
    return sorted((tuple(r) for r in vd.near_vectors(df, **{"recall": 1.0, **how}).collect()), key=repr)


def clustered(seed, groups, size, dims, spread):
    rng = np.random.default_rng(seed)
    made = []
    for g in range(groups):
        centre = rng.standard_normal(dims)
        for _ in range(rng.integers(1, size)):
            v = centre + spread * rng.standard_normal(dims)
            made.append((len(made), v.astype(np.float32).tolist(), int(g % 3)))
    return made


@pytest.mark.parametrize("block", [7, 1024])
def test_equal_to_all_pairs(spark, block):
    rows = clustered(1, 60, 9, 16, 0.2)
    rows += [(1000 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(40)]
    assert found(spark, rows, block=block) == brute(rows)


def test_one_group_of_near_copies_over_many_blocks(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + 0.15 * rng.standard_normal(32)).tolist(), 1) for i in range(400)]
    assert found(spark, rows, "double", block=50) == brute(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
        (5, [1.0, 0.0], None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1),
        (10, [inf, 1.0], 1), (11, [None, 1.0], 1), (12, [1.0, 0.0, 0.0], 1), (13, [1.0, 0.0, 0.0], 1),
        (None, [0.0, 1.0], 1), (None, [0.0, 3.0], 1), (2, [1.0, 0.0], 1), (20, [-1.0, -0.0], 1),
        (21, [-1.0, 0.0], 1), (22, [1e-30, 1e-30], 1), (23, [1e30, 1e30], 1), (24, [5.0], 7),
    ]
    assert found(spark, rows) == brute(rows)
    big = [(1, [1e300, 1e300], 1), (2, [1e-300, 1e-300], 1), (3, [1e300, -1e300], 1)]
    assert found(spark, big, "double") == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_no_rows_and_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1), (None, [1.0], None)]) == [(1, 0, 1), (None, 0, None)]


def test_cells_come_nearest_first_and_all_within_reach():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice([rng.random(), 0.5]) for _ in range(rng.randint(1, 9))] for _ in "ab")
        reach = rng.random()
        made = vd.nearest_cells(np.array(a), np.array(b), reach)
        far = [a[i] + b[j] for i, j in made]
        assert far == sorted(far) and len(set(made)) == len(made)
        assert set(made) == {(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] + b[j] <= reach}


def test_recall_of_all_links(spark):
    """Links that the production reach finds among clusters around the threshold."""
    rows = clustered(3, 150, 9, 24, 0.22)
    made, all_links = found(spark, rows, recall=vd.RECALL), brute(rows)
    assert all(a[1] <= b[1] for a, b in zip(made, all_links))
    assert sum(r[1] for r in made) >= 0.98 * sum(r[1] for r in all_links)


@pytest.mark.parametrize("recall", [0.99, 1.0])
@pytest.mark.parametrize("shape", ["all", "first", "second", "few"])
def test_recall_of_pairs_at_the_threshold(shape, recall):
    """Pairs of one shape right at the threshold meet in a grid of many cells."""
    rng = np.random.default_rng(9)
    sample, others = (vd.unit(rng.standard_normal((20_000, 32))) for _ in "ab")
    grid = vd.fitted(sample, 24, vd.THRESHOLD, recall)
    mine = others[:2_000]
    near = vd.neighbours(mine, vd.THRESHOLD, shape, rng)
    a, b = vd.cells(grid, mine), vd.cells(grid, near)
    met = sum(x[0] in y or y[0] in x for x, y in zip(a, b))
    assert met >= recall * len(a)
