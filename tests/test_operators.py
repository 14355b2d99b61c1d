"""Edge cases on hand-made frames: nulls, zero denominators, carry-forward gaps,
duplicate keys, hot groups, singleton clusters, blocked fallbacks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from regiopanel.functions.expr import (code_prefix_filter, count_when, guarded_ratio, padded_code,
                                       padded_code_prefix_range, recode)
from regiopanel.operators.geometry import (as_array, inertia_by_label, nearest_centroid,
                                           silhouette_samples, silhouette_squared,
                                           silhouette_squared_samples, total_inertia)
from regiopanel.operators.panel import column_profile, merge_panel, rename_columns, require_columns
from regiopanel.operators.ranking import exact_percentiles, group_rank
from regiopanel.operators.reshape import carry_forward, replicate_years, unpivot_columns
from regiopanel.operators.stats import boxplot_stats, group_describe, zscore


def test_guarded_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1, 4.0, 2.0), (2, 1.0, 0.0), (3, None, 1.0), (4, 1.0, None)], "k int, a double, b double")
    got = {r.k: r.q for r in df.select("k", guarded_ratio("a", "b").alias("q")).collect()}
    assert got == {1: 2.0, 2: None, 3: None, 4: None}


def test_count_when_not_in_keeps_null_out(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,), ("C",)], "g string")
    groups = {"ab": ["A", "B"]}
    row = df.agg(count_when(F.col("g").isin("A", "B")).alias("ab"),
                 count_when(~F.col("g").isin("A", "B")).alias("other")).first()
    assert (row.ab, row.other) == (2, 1)  # null is in no bucket
    assert df.select(recode("g", groups).alias("r")).where("r IS NULL").count() == 2


def test_prefix_range_is_exact(spark):
    assert padded_code_prefix_range("0000", 5) == (0, 9)
    assert padded_code_prefix_range("19", 5) is None
    keys = [-5, 0, 7, 9, 10, 99, 123456, 1000000]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    by_string = {r.k for r in df.where(padded_code("k").startswith("0000")).collect()}
    by_filter = {r.k for r in df.where(code_prefix_filter("k", "0000")).collect()}
    assert by_string == by_filter == {0, 7, 9}


def test_carry_forward_only_keys_with_last_year(spark):
    df = spark.createDataFrame([("a", 1996, 1.0), ("a", 1998, 3.0), ("b", 1997, 5.0)], "code string, year int, v double")
    got = sorted((r.code, r.year, r.v) for r in carry_forward(df, "year", 1998, 2000).collect())
    assert got == [("a", 1996, 1.0), ("a", 1998, 3.0), ("a", 1999, 3.0), ("a", 2000, 3.0), ("b", 1997, 5.0)]


def test_replicate_and_unpivot(spark):
    df = spark.createDataFrame([("a", 1.0, None)], "code string, y1 double, y2 double")
    assert replicate_years(df, 2019, 2023).count() == 5
    long = unpivot_columns(df, ["code"], [(1, "y1"), (2, "y2"), (3, "y2")], "year", "v").collect()
    assert [(r.year, r.v) for r in long] == [(1, 1.0), (2, None), (3, None)]


def test_merge_panel_outer_and_checks(spark):
    a = spark.createDataFrame([("x", 1, 1.0), ("y", 1, 2.0)], "code string, year int, m1 double")
    b = spark.createDataFrame([("y", 1, 5), ("z", 2, 6)], "code string, year int, m2 bigint")
    got = sorted(tuple(r) for r in merge_panel({"a": a, "b": b}).collect())
    assert got == [("x", 1, 1.0, None), ("y", 1, 2.0, 5.0), ("z", 2, None, 6.0)]
    dup = spark.createDataFrame([("x", 1, 1.0), ("x", 1, 2.0)], "code string, year int, m3 double")
    with pytest.raises(Exception, match="duplicate"):
        merge_panel({"a": a, "dup": dup}).collect()
    clash = spark.createDataFrame([("x", 1, 1.0)], "code string, year int, m1 double")
    with pytest.raises(ValueError, match="m1"):
        merge_panel({"a": a, "clash": clash})


def test_panel_union_form_equals_chained_outer_joins(spark):
    a = spark.createDataFrame([("x", 1, 1.0), ("y", 2, 2.0)], "code string, year int, m1 double")
    b = spark.createDataFrame([("y", 2, 3.0), ("w", 1, 4.0)], "code string, year int, m2 double")
    c = spark.createDataFrame([("x", 1, 7.0), ("v", 3, 8.0)], "code string, year int, m3 double")
    chained = a.join(b, ["code", "year"], "full").join(c, ["code", "year"], "full")
    got = sorted(tuple(r) for r in merge_panel({"a": a, "b": b, "c": c}).collect())
    want = sorted(tuple(r) for r in chained.select("code", "year", "m1", "m2", "m3").collect())
    assert got == want


def test_rename_and_required(spark):
    df = spark.createDataFrame([(1, 2)], "anio int, v int")
    assert rename_columns(df, {"anio": "year", "absent": "x"}).columns == ["year", "v"]
    with pytest.raises(ValueError, match="missing"):
        require_columns(df, ["anio", "code"])
    prof = {r.column_name: r.non_null for r in column_profile(
        spark.createDataFrame([(1, None), (2, "a")], "a int, b string")).collect()}
    assert prof == {"a": 2, "b": 1}


def test_group_rank_hot_group_over_many_partitions(spark):
    rows = [("hot", i) for i in range(3000)] + [("cold", i) for i in range(7)] + [(None, i) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = group_rank(df, ["g"], ["v"], rank_col="r", size_col="n", num_partitions=16)
    res = {(r.g, r.v): (r.r, r.n) for r in got.collect()}
    assert len(res) == len(rows)
    assert all(res[("hot", i)] == (i + 1, 3000) for i in range(3000))
    assert all(res[(None, i)] == (i + 1, 3) for i in range(3))
    # The hot group really was split across partitions.
    parts = df.repartitionByRange(16, "g", "v").where("g = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert parts > 1


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = {"a": rng.normal(size=1001), "b": rng.normal(size=4), "c": np.array([1.0, 2, 4, 9])}
    rows = [(g, float(v)) for g, vs in vals.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q1, r.med, r.q3) for r in
           exact_percentiles(df, ["g"], "v", [0.25, 0.5, 0.75], ["q1", "med", "q3"], num_partitions=7).collect()}
    for g, vs in vals.items():
        want = np.percentile(vs, [25, 50, 75])
        assert np.allclose(got[g], want, rtol=0, atol=1e-12), g
    assert math.isclose(got["c"][1], 3.0)


def test_zscore_population_and_zero_variance(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 4.0, 5.0)], "id int, a double, b double")
    z = {r.id: (r.a, r.b) for r in zscore(df, ["a", "b"]).collect()}
    a = np.array([1.0, 2.0, 4.0])
    want = (a - a.mean()) / a.std()
    assert np.allclose([z[i][0] for i in (1, 2, 3)], want)
    assert all(z[i][1] == 0.0 for i in (1, 2, 3))


def test_describe_std_of_single_row_is_null(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 2.0)], "label int, x double")
    got = {r.label: (r["mean"], r.median, r.std) for r in group_describe(df, "label", ["x"]).collect()}
    assert got[0] == (2.0, 2.0, pytest.approx(math.sqrt(2.0)))
    assert got[1] == (2.0, 2.0, None)


def test_boxplot_whiskers_and_outliers(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(0, x) for x in xs], "label int, x double")
    r = boxplot_stats(df, "label", ["x"]).first()
    q1, q3 = np.percentile(xs, [25, 75])
    assert (r.q1, r.q3) == (q1, q3)
    assert r.whisker_hi == 5.0 and r.whisker_lo == 1.0 and r.n_outliers == 1


def _brute_silhouette(x, lab):
    n = len(x)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = np.zeros(n)
    for i in range(n):
        own = lab == lab[i]
        if own.sum() <= 1:
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        out[i] = (b - a) / max(a, b)
    return out


def test_silhouette_tiles_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 3))
    lab = rng.integers(0, 4, size=90)
    lab[0] = 9  # a singleton cluster scores 0
    df = spark.createDataFrame([(i, int(lab[i]), [float(v) for v in x[i]]) for i in range(90)],
                               "id long, label int, f array<double>")
    want = _brute_silhouette(x, lab)
    for block in (2048, 16):  # one tile, and many tiles
        got = {r.id: r.silhouette for r in silhouette_samples(df, "id", "label", "f", block_size=block).collect()}
        assert np.allclose([got[i] for i in range(90)], want, atol=1e-12)
    assert got[0] == 0.0


def test_squared_silhouette_matches_spark_ml(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 4))
    lab = rng.integers(0, 3, size=200)
    df = spark.createDataFrame([(i, int(lab[i]), [float(v) for v in x[i]]) for i in range(200)],
                               "id long, label int, f array<double>")
    mine = silhouette_squared_samples(df, "label", "f").agg(F.avg("silhouette_sq")).first()[0]
    assert mine == pytest.approx(silhouette_squared(df, "label", "f"), abs=1e-9)


def test_nearest_centroid_inline_equals_blocked(spark):
    rng = np.random.default_rng(7)
    pts = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=3)]) for i in range(50)],
                                "id long, f array<double>")
    cents = spark.createDataFrame([(c, [float(v) for v in rng.normal(size=3)]) for c in range(30)],
                                  "cid int, c array<double>")
    inline = {r.id: r.nearest for r in nearest_centroid(pts, "f", cents, "cid", "c", id_col="id").collect()}
    blocked = {r.id: r.nearest for r in nearest_centroid(pts, "f", cents, "cid", "c", id_col="id",
                                                         max_values=20, block_size=7).collect()}
    assert inline == blocked


def test_inertia_identities(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, 2))
    lab = np.repeat([0, 1], 20)
    df = spark.createDataFrame([(int(lab[i]), float(x[i, 0]), float(x[i, 1])) for i in range(40)],
                               "label int, a double, b double")
    by = {r.label: r.inertia for r in inertia_by_label(df, "label", ["a", "b"]).collect()}
    for c in (0, 1):
        xc = x[lab == c]
        assert by[c] == pytest.approx(((xc - xc.mean(0)) ** 2).sum())
    assert total_inertia(df, ["a", "b"]).first().inertia == pytest.approx(((x - x.mean(0)) ** 2).sum())
    assert as_array(["a", "b"]) is not None


def test_silhouette_1d_equals_brute_force_with_ties_and_hot_values(spark):
    from regiopanel.operators.geometry import silhouette_1d
    rng = np.random.default_rng(11)
    n = 400
    vals = np.where(rng.random(n) < 0.35, 0.0, rng.normal(size=n)).round(2)  # a third of rows share one value
    lab = rng.integers(0, 3, size=n)
    lab[5] = 7  # singleton cluster
    rows = [("v1", i, int(lab[i]), float(vals[i])) for i in range(n)] + \
           [("v2", i, int(lab[i]), float(-vals[i] * 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, id long, label int, x double")
    got = {(r.g, r.id): r.silhouette for r in
           silhouette_1d(df, "id", "label", "x", ["g"], num_partitions=9).collect()}
    for g, v in (("v1", vals), ("v2", -vals * 2)):
        want = _brute_silhouette(v[:, None], lab)
        assert np.allclose([got[(g, i)] for i in range(n)], want, atol=1e-9)


def test_nearest_centre_ties_go_to_lower_label(spark):
    pts = spark.createDataFrame([(1, [0.0, 0.0]), (2, [2.0, 0.0])], "id long, f array<double>")
    cents = spark.createDataFrame([(5, [1.0, 0.0]), (3, [-1.0, 0.0]), (4, [1.0, 0.0])], "cid int, c array<double>")
    got = {r.id: r.nearest for r in nearest_centroid(pts, "f", cents, "cid", "c", id_col="id").collect()}
    assert got == {1: 3, 2: 4}  # point 1 ties 3/4/5 -> 3; point 2 ties 4/5 -> 4


def test_long_keys_are_never_cut(spark):
    from regiopanel.functions.expr import padded_code
    df = spark.createDataFrame([(7,), (99999,), (123456,), (123457,)], "k long")
    got = [r.c for r in df.select(padded_code("k").alias("c")).orderBy("k").collect()]
    assert got == ["00007", "99999", "123456", "123457"]


def test_group_rank_sizes_across_partitions_and_batches(spark):
    from regiopanel.operators.ranking import group_rank
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(i, None if i % 5 == 0 else (0 if i % 3 else i % 11)) for i in range(400)]
        out = group_rank(spark.createDataFrame(rows, "id long, g int"), ["g"], ["id"], size_col="n", num_partitions=5).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    groups = {}
    for i, g in rows:
        groups.setdefault(g, []).append(i)
    assert {(r.id, r.rank, r.n) for r in out} == {(i, k + 1, len(m)) for m in groups.values() for k, i in enumerate(m)}
