"""Exact silhouettes with clusters left out by bounds: same values, fewer tiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from regiopanel.operators import geometry
from regiopanel.operators.geometry import silhouette_samples


def _all_sums(x, y):
    d = np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))
    return d.sum(axis=1), d.sum(axis=0)


def _brute(x, lab):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        means = [d[i, lab == c].mean() for c in set(lab.tolist()) - {lab[i]}]
        if not means:
            out.append(0.0)
            continue
        b = min(means)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.array(out)


def _clusters(rng, k, n, d, apart):
    middle = rng.normal(size=(k, d)) * apart
    lab = rng.integers(0, k, n)
    return middle[lab] + rng.normal(size=(n, d)), lab


def _frame(spark, x, lab, kind="int"):
    rows = [(i, f"c{c}" if kind == "string" else int(c), v) for i, (c, v) in enumerate(zip(lab, x.tolist()))]
    return spark.createDataFrame(rows, f"id long, label {kind}, f array<double>")


@pytest.mark.parametrize("apart,kind", [(0.0, "int"), (1.5, "string"), (30.0, "int")])
def test_values_equal_all_pairs(spark, apart, kind):
    rng = np.random.default_rng(int(apart) + 1)
    x, lab = _clusters(rng, 6, 300, 3, apart)
    lab[7] = 11                        # a cluster of one
    x[20], lab[20] = x[21], lab[21]    # a repeated row
    got = {r.id: r.silhouette for r in silhouette_samples(_frame(spark, x, lab, kind), "id", "label", "f", block_size=32).collect()}
    assert np.allclose([got[i] for i in range(300)], _brute(x, lab), atol=1e-12)


def test_clusters_in_parts_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x, lab = _clusters(rng, 25, 400, 2, 6.0)
    df = _frame(spark, x, lab)
    whole = {r.id: r.silhouette for r in silhouette_samples(df, "id", "label", "f", block_size=64).collect()}
    monkeypatch.setattr(geometry, "PART_VALUES", 12)   # 5 parts
    parts = {r.id: r.silhouette for r in silhouette_samples(df, "id", "label", "f", block_size=64).collect()}
    assert whole.keys() == parts.keys() and np.allclose(list(whole.values()), [parts[i] for i in whole], atol=1e-12)
    assert np.allclose([whole[i] for i in range(400)], _brute(x, lab), atol=1e-12)


def test_groups_side_by_side(spark):
    rng = np.random.default_rng(3)
    x, lab = _clusters(rng, 3, 80, 2, 3.0)
    y, lab2 = _clusters(rng, 5, 60, 2, 3.0)
    df = _frame(spark, x, lab).withColumn("g", F.lit("x")).unionByName(_frame(spark, y, lab2).withColumn("g", F.lit(None).cast("string")))
    got = {(r.g, r.id): r.silhouette for r in silhouette_samples(df, "id", "label", "f", ["g"], block_size=16).collect()}
    assert len(got) == 140
    assert np.allclose([got["x", i] for i in range(80)], _brute(x, lab)) and np.allclose([got[None, i] for i in range(60)], _brute(y, lab2))


def test_far_clusters_cost_no_tile(spark, monkeypatch):
    seen = []
    plain = geometry.silhouette_tiles
    monkeypatch.setattr(geometry, "silhouette_tiles", lambda *a: seen.append(plain(*a)) or seen[-1])
    rng = np.random.default_rng(5)
    middle = np.array([[i * 100.0, (i % 4) * 100.0] for i in range(16)])
    lab = np.repeat(np.arange(16), 64)
    x = middle[lab] + rng.normal(size=(1024, 2))
    got = {r.id: r.silhouette for r in silhouette_samples(_frame(spark, x, lab), "id", "label", "f", block_size=16).collect()}
    assert np.allclose([got[i] for i in range(1024)], _brute(x, lab), atol=1e-12)
    blocks = 16 * 4
    tiles = seen[0].count()
    # All pairs of blocks would be 2080 tiles; own clusters are 160, and each cluster has few that may be nearest.
    assert 160 < tiles < 0.35 * blocks * (blocks + 1) / 2


def test_empty_and_single_cluster(spark):
    df = _frame(spark, np.random.default_rng(1).normal(size=(20, 2)), np.zeros(20, int))
    assert [r.silhouette for r in silhouette_samples(df, "id", "label", "f").collect()] == [0.0] * 20
    assert silhouette_samples(df.filter("id < 0"), "id", "label", "f").collect() == []


@pytest.mark.parametrize("d,shift,scale", [(2, 0.0, 1.0), (5, 1e6, 1.0), (64, -30.0, 1e-3), (1, 0.0, 1e5)])
def test_sums_by_matrix_products_keep_their_digits(d, shift, scale):
    rng = np.random.default_rng(d)
    x, y = (rng.normal(size=(n, d)) * scale + shift for n in (700, 523))
    y[::7] = x[:len(y[::7])]                # copies
    y[3::7] = x[:len(y[3::7])] * (1 + 1e-12)  # next to one another
    y[5] = 1e4 * y[5]                       # far from all
    for got, want in zip(geometry.distance_sums(x, y), _all_sums(x, y)):
        assert np.allclose(got, want, rtol=1e-9, atol=0)
    for got, want in zip(geometry.distance_sums(x), _all_sums(x, x)):
        assert np.allclose(got, want, rtol=1e-9, atol=0)


def test_sums_of_equal_and_of_odd_rows():
    same = np.full((600, 3), 0.1) + 1e7
    assert not any(s.any() for s in geometry.distance_sums(same) + geometry.distance_sums(same, same[:300]))
    x = np.random.default_rng(0).normal(size=(40, 3))
    x[3, 1], x[9, 0], x[11] = np.nan, np.inf, 1e200
    y = x[::-1][:25].copy()
    with np.errstate(all="ignore"):
        for got, want in zip(geometry.distance_sums(x, y) + geometry.distance_sums(x), _all_sums(x, y) + _all_sums(x, x)):
            assert np.allclose(got, want, equal_nan=True)
    assert [len(s) for s in geometry.distance_sums(x, y[:0])] == [40, 0]


def test_sums_need_little_memory():
    import tracemalloc
    x = np.random.default_rng(2).normal(size=(6000, 16))
    tracemalloc.start()
    geometry.distance_sums(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6  # all pairs would be 288 MB


def test_rows_travel_in_few_blocks_of_bounded_values(spark, monkeypatch):
    seen = []
    plain = geometry.silhouette_tiles
    monkeypatch.setattr(geometry, "silhouette_tiles", lambda *a: seen.append(plain(*a)) or seen[-1])
    rng = np.random.default_rng(8)
    x, lab = _clusters(rng, 3, 9000, 2, 0.0)
    df = _frame(spark, x, lab)
    got = {r.id: r.silhouette for r in silhouette_samples(df, "id", "label", "f").collect()}
    assert seen[0].count() == 6  # three clusters of 3,000 rows, a block each
    monkeypatch.setattr(geometry, "BLOCK_VALUES", 2 * 1100)
    small = {r.id: r.silhouette for r in silhouette_samples(df, "id", "label", "f").collect()}
    assert seen[1].count() == 45  # three blocks each
    assert got.keys() == small.keys() and np.allclose([got[i] for i in small], list(small.values()), atol=1e-12)
    rows = rng.choice(9000, 50, replace=False)
    for i in rows:
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        a, b = d[lab == lab[i]].sum() / ((lab == lab[i]).sum() - 1), min(d[lab == c].mean() for c in {0, 1, 2} - {lab[i]})
        assert abs(got[i] - (b - a) / max(a, b)) < 1e-12


def test_rows_of_one_id_and_label_are_one(spark):
    """As ``GROUP BY id, label`` over all pairs: their sums and counts add up."""
    x = [(1, 0, [0.0]), (1, 0, [2.0]), (None, 0, [4.0]), (2 ** 53 + 1, 1, [9.0]), (2 ** 53, 1, [10.0]), (None, 1, [11.0]), (1, 1, [12.0])]
    df = spark.createDataFrame(x, "id long, label int, f array<double>")
    got = {(r.id, r.label): (r.a, r.b) for r in silhouette_samples(df, "id", "label", "f").collect()}
    want = {}
    for i, c, _ in x:
        mine = [v[0] for j, k, v in x if (j, k) == (i, c)]
        sums = {k: (sum(abs(p - v[0]) for p in mine for _, o, v in x if o == k), len(mine) * sum(o == k for _, o, _ in x)) for k in (0, 1)}
        want[i, c] = (sums[c][0] / (sums[c][1] - 1), sums[1 - c][0] / sums[1 - c][1])
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
