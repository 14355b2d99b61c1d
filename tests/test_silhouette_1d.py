"""One-dimensional silhouettes with any number of labels against pairwise distances."""

import numpy as np
import pytest

from regiopanel.operators.geometry import silhouette_1d


def _pairwise(x, lab):
    """Silhouette of each row from all distances, cluster by cluster."""
    names, inv = np.unique(lab, return_inverse=True)
    size = np.bincount(inv)
    order = np.argsort(inv, kind="stable")
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    out = np.zeros(len(x))
    for i in range(len(x)):
        d = np.abs(x[i] - x)[order]
        sums = np.add.reduceat(d, first)
        if size[inv[i]] == 1:
            continue
        a = sums[inv[i]] / (size[inv[i]] - 1)
        means = sums / size
        means[inv[i]] = np.inf
        b = means.min()
        out[i] = (b - a) / max(a, b) if np.isfinite(b) and max(a, b) > 0 else 0.0
    return out


def test_five_thousand_labels_equal_the_pairwise_value(spark):
    rng = np.random.default_rng(21)
    lab = np.concatenate([np.arange(5000), rng.integers(0, 5000, 3000), np.full(2000, 17)])   # one hot label
    x = (lab % 97) * 10.0 + rng.normal(size=len(lab)).round(2)
    df = spark.createDataFrame([(i, f"l{c}", float(v)) for i, (c, v) in enumerate(zip(lab, x))], "id long, label string, x double")
    got = {r.id: r.silhouette for r in silhouette_1d(df, "id", "label", "x").collect()}
    assert len(got) == len(lab)
    assert np.allclose([got[i] for i in range(len(lab))], _pairwise(x, lab), atol=1e-8)


@pytest.mark.parametrize("block_size", [2, 3, 512])
def test_blocks_of_any_size_give_the_same(spark, block_size):
    rng = np.random.default_rng(2)
    lab, x = rng.integers(0, 7, 200), rng.integers(0, 40, 200).astype(float)
    rows = [(g, i, int(lab[i]), float(x[i]) * s) for g, s in (("u", 1), (None, -3)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, id long, label int, x double").repartition(6)
    got = {(r.g, r.id): r.silhouette for r in silhouette_1d(df, "id", "label", "x", ["g"], num_partitions=5, block_size=block_size).collect()}
    for g, s in (("u", 1), (None, -3)):
        assert np.allclose([got[g, i] for i in range(200)], _pairwise(x * s, lab), atol=1e-9)


def test_rows_stay_rows(spark):
    """Repeated and null ids, a null label, a null value, one cluster, no rows."""
    rows = [(1, "a", 1.0), (1, "a", 1.0), (None, "a", 2.0), (2, None, 9.0), (3, None, 9.5), (4, "a", None), (5, "z", 4.0)]
    df = spark.createDataFrame(rows, "id long, label string, x double")
    got = silhouette_1d(df, "id", "label", "x", block_size=2).collect()
    assert len(got) == 6
    lab, x = np.array(["a", "a", "a", "0", "0", "z"]), np.array([1.0, 1.0, 2.0, 9.0, 9.5, 4.0])
    assert np.allclose(sorted(r.silhouette for r in got), sorted(_pairwise(x, lab)))
    assert silhouette_1d(df.filter("x > 100"), "id", "label", "x").collect() == []
    assert [r.silhouette for r in silhouette_1d(df.filter("label = 'a'"), "id", "label", "x").collect()] == [0.0] * 3
