"""Nearest centre through ball trees: one result at every number and layout of centres."""

import math
from collections import Counter

import numpy as np
import pytest

from regiopanel.operators.balltree import BallTree, nearest_centre

POINTS = "id long, f array<double>, note string"


def _brute(x, centres):
    """Position of the nearest centre, of equally near ones the first, by loops over dimensions."""
    d2 = np.zeros((len(x), len(centres)))
    for k in range(x.shape[1]):
        d2 += (x[:, k, None] - centres[None, :, k]) ** 2
    return d2.argmin(axis=1), d2.min(axis=1)


@pytest.mark.parametrize("k,d,kind", [(1, 2, "normal"), (33, 3, "normal"), (700, 2, "grid"), (2000, 8, "clusters"), (300, 4, "same"), (900, 64, "normal")])
def test_tree_equals_all_distances(k, d, kind):
    rng = np.random.default_rng(k + d)
    c = {"normal": lambda: rng.normal(size=(k, d)), "grid": lambda: rng.integers(0, 6, (k, d)).astype(float),
         "clusters": lambda: rng.normal(size=(20, d))[rng.integers(0, 20, k)] * 50 + rng.normal(size=(k, d)),
         "same": lambda: np.ones((k, d))}[kind]()
    x = np.concatenate([c[rng.integers(0, k, 150)] + rng.normal(size=(150, d)) * 0.3, rng.integers(0, 6, (100, d)) + 0.5, c[:40]])
    tree = BallTree(c)
    best = np.full(len(x), np.inf)
    at = tree.nearest(x, best, np.full(len(x), -1, np.int64))
    want, d2 = _brute(x, c)
    assert (at == want).all() and (best == d2).all()
    if kind == "clusters":
        assert tree.computed < 0.2 * len(x) * k   # most balls are never opened, though a third of the rows lie between clusters


def test_a_known_bound_prunes_the_next_tree():
    rng = np.random.default_rng(4)
    near, far = rng.normal(size=(500, 5)), rng.normal(size=(500, 5)) + 100
    x = near[:200] + 0.01
    best = np.full(200, np.inf)
    BallTree(near).nearest(x, best, np.full(200, -1, np.int64))
    tree = BallTree(far)
    assert (tree.nearest(x, best, np.full(200, -1, np.int64)) == -1).all() and tree.computed == 0


@pytest.mark.parametrize("part_values", [2_000_000, 900, 60, 3])
def test_one_result_at_every_part_size(spark, part_values):
    rng = np.random.default_rng(2)
    c = np.concatenate([rng.normal(size=(40, 3)), rng.integers(0, 2, (20, 3)).astype(float)])
    x = np.concatenate([rng.normal(size=(60, 3)), np.full((30, 3), 0.5)])
    if part_values == 3:
        c = c[-8:]
    # Ids out of order; of equally near centres the lowest id wins, wherever its part is.
    ids = rng.permutation(len(c))
    order = np.argsort(ids)
    cents = spark.createDataFrame([(int(i), v) for i, v in zip(ids, c.tolist())], "cid int, c array<double>").repartition(4)
    pts = spark.createDataFrame([(i, v, "n") for i, v in enumerate(x.tolist())], POINTS).repartition(3)
    got = {r.id: (r.near, r.dist) for r in nearest_centre(pts, "f", cents, "cid", "c", "near", "dist", part_values).collect()}
    want, d2 = _brute(x, c[order])
    assert got == {i: (int(want[i]), math.sqrt(d2[i])) for i in range(len(x))}


def test_rows_stay_rows(spark):
    """Repeated and null ids, null and incomplete vectors, text ids of centres, no centres."""
    rows = [(1, [0.0, 0.0], "a"), (1, [0.0, 0.0], "a"), (1, [9.0, 9.0], "b"), (None, [9.0, 9.0], "c"), (None, None, "d"), (2, [1.0, None], "e"),
            (3, [1.0, math.nan], "f"), (4, [1.0], "g"), (5, [], None)]
    pts = spark.createDataFrame(rows, POINTS)
    cents = spark.createDataFrame([("y", [0.0, 1.0]), ("x", [1.0, 0.0]), ("z", [10.0, 10.0]), (None, [0.0, 0.0]), ("w", [0.0, None])],
                                  "cid string, c array<double>")
    for part in (2_000_000, 2):
        got = Counter((r.id, r.note, r.nearest) for r in nearest_centre(pts, "f", cents, "cid", "c", part_values=part).collect())
        assert got == Counter([(1, "a", "x"), (1, "a", "x"), (1, "b", "z"), (None, "c", "z"), (None, "d", None), (2, "e", None),
                               (3, "f", None), (4, "g", None), (5, None, None)])
    none = nearest_centre(pts, "f", cents.filter("cid = 'q'"), "cid", "c", dist_out="d")
    assert none.count() == len(rows) and none.filter("nearest IS NOT NULL OR d IS NOT NULL").count() == 0
    assert nearest_centre(pts.filter("id > 99"), "f", cents, "cid", "c").collect() == []
    with pytest.raises(ValueError):
        nearest_centre(pts, "f", cents.union(spark.createDataFrame([("v", [1.0])], cents.schema)), "cid", "c")


def test_points_are_not_exchanged(spark):
    pts = spark.range(1000).selectExpr("id", "array(cast(id as double), 1.0D) AS f")
    cents = spark.range(50).selectExpr("id AS cid", "array(cast(id * 7 as double), 2.0D) AS c")
    plan = nearest_centre(pts, "f", cents, "cid", "c")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "MapInArrow" in plan
