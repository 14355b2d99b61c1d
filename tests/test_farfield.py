"""Sums of distances by trees of boxes: the same sums as over all pairs, from far fewer of them."""

import numpy as np
import pytest

from regiopanel.operators import farfield, geometry
from regiopanel.operators.farfield import box_sums
from regiopanel.operators.geometry import silhouette_samples


def _all_sums(x, y):
    d = np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))
    return d.sum(axis=1), d.sum(axis=0)


def _rows(kind, n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    if kind == "skewed":
        x[:, 0] = np.exp(3 * x[:, 0])
        x[0] = 1e6
    if kind == "shifted":
        x = x * 1e-2 + 1e5
        x[::2] *= -1
    if kind == "copies":
        x = np.round(x)
    if kind == "line":
        x[:, -1] = 0.25
    return x


@pytest.mark.parametrize("d", [1, 2])
@pytest.mark.parametrize("kind", ["plain", "skewed", "shifted", "copies", "line"])
def test_sums_equal_all_pairs(monkeypatch, kind, d):
    monkeypatch.setattr(farfield, "LEAF_ROWS", 64)
    x, y = _rows(kind, 3000, d, 1), _rows(kind, 1700, d, 2)
    y[:900] = y[0]          # more equal rows than a box holds
    y[900:1000] = x[:100]
    for got, want in zip(box_sums(x, y) + box_sums(x), _all_sums(x, y) + _all_sums(x, x)):
        assert np.allclose(got, want, rtol=1e-11, atol=0)


def test_each_distance_keeps_its_digits():
    """Boxes at every gap that nodes are allowed for."""
    rng = np.random.default_rng(4)
    for half in (0.01, 0.2, 0.45):
        x, y = rng.uniform(-half, half, (500, 2)), rng.uniform(-half, half, (500, 2)) + [1.0, 0.3]
        bx, by = farfield.Boxes(x), farfield.Boxes(y)
        gap = max(0.0, 1.0 - 2 * half)
        nodes = [farfield._enough(gap, b.box[0][3], b.most) for b in (bx, by)]
        if all(nodes):
            farfield._meet(bx, 0, by, 0, *nodes, np.empty((2, farfield.STEP_VALUES)))
            for got, want in zip((bx.sums(), by.sums()), _all_sums(x, y)):
                assert np.allclose(got, want, rtol=1e-10, atol=0)


def test_work_grows_with_the_rows(monkeypatch):
    taken = []
    plain = farfield._distances
    monkeypatch.setattr(farfield, "_distances", lambda a, b, work: taken.append(a.shape[1] * b.shape[1]) or plain(a, b, work))
    used = []
    for n in (10_000, 40_000):
        taken.clear()
        geometry.distance_sums(np.random.default_rng(n).normal(size=(n, 2)))
        used.append(sum(taken))
    assert 0 < used[0] and used[1] < 6 * used[0]  # all pairs would be 16 times as many
    assert used[1] < 0.3 * 40_000 ** 2 / 2


def test_silhouettes_by_boxes_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(geometry, "BOX_PAIRS", 1)
    monkeypatch.setattr(farfield, "LEAF_ROWS", 32)
    rng = np.random.default_rng(6)
    x, lab = rng.normal(size=(600, 2)), rng.integers(0, 3, 600)
    x[5], x[9] = [np.nan, 0.0], x[8]
    df = spark.createDataFrame([(i, int(c), v) for i, (c, v) in enumerate(zip(lab, x.tolist()))], "id long, label int, f array<double>")
    df = df.filter("id <> 5")
    got = {r.id: (r.a, r.b) for r in silhouette_samples(df, "id", "label", "f").collect()}
    assert len(got) == 599
    keep = np.arange(600) != 5
    for i in range(0, 600, 7):
        d = np.sqrt(((x[keep] - x[i]) ** 2).sum(axis=1))
        near = {c: d[lab[keep] == c] for c in range(3)}
        a, b = near[lab[i]].sum() / (len(near[lab[i]]) - 1), min(v.mean() for c, v in near.items() if c != lab[i])
        assert np.allclose(got[i], (a, b), rtol=1e-11)


def test_blocks_are_as_large_as_their_dimensions_allow():
    assert geometry._block_rows(2, None) == geometry.BOX_BLOCK_ROWS and geometry._block_rows(3, None) == geometry.BLOCK_ROWS
    assert geometry._block_rows(64, None) == geometry.BLOCK_ROWS and geometry._block_rows(1 << 14, None) == 64
    assert geometry._block_rows(2, 100) == 100 and geometry._block_rows(1 << 30, 100) == 1
