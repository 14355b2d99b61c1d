"""Invariants of the fitted models (no other library's random draws to compare with)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from regiopanel.operators.anomaly import average_path_length, isolation_forest
from regiopanel.operators.classify import (classification_report, coefficient_table, fit_logit,
                                           stratified_folds, stratified_split)
from regiopanel.operators.cluster import (attach_labels, covariance, exclude_refit_label, fit_pca,
                                          kmeans_labels, pca_from_cov, pca_scores)
from regiopanel.plans.fixtures import UP_FEATURES
from regiopanel.plans.stats_q import user_panel_z


@pytest.fixture(scope="module")
def upz(spark):
    return user_panel_z(spark, "/root/testdata/sf0.01").cache()


def test_kmeans_labels_are_nearest_centres_and_cost(spark, upz):
    labelled, centres, cost = kmeans_labels(upz, UP_FEATURES, k=3, seed=42)
    pdf = labelled.toPandas()
    x = pdf[UP_FEATURES].to_numpy()
    d = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(-1)
    assert (d.argmin(1) == pdf["cluster"].to_numpy()).all()
    assert cost == pytest.approx(d.min(1).sum(), rel=1e-6)
    # canonical order: centres sorted lexicographically
    assert [tuple(c) for c in centres] == sorted(tuple(c) for c in centres)


def test_pca_orthonormal_and_centred(spark, upz):
    pca = fit_pca(upz, UP_FEATURES, len(UP_FEATURES))
    v = pca["components"]
    assert np.allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-9)
    assert pca["ratio"].sum() == pytest.approx(1.0)
    sc = pca_scores(upz, pca).toPandas()
    assert np.allclose(sc.mean().to_numpy(), 0.0, atol=1e-9)
    # largest |loading| positive in each component
    assert all(v[np.argmax(np.abs(v[:, j])), j] > 0 for j in range(v.shape[1]))
    mean, cov, n = covariance(upz, UP_FEATURES)
    comps, ratio = pca_from_cov(cov, 2)
    assert np.allclose(np.abs(comps), np.abs(v[:, :2]), atol=1e-6)


def test_isolation_forest_flags_contamination_share(spark, upz):
    out = isolation_forest(upz, "user_id", UP_FEATURES, contamination=0.05, n_trees=50).toPandas()
    n = len(out)
    assert n == upz.count()
    assert abs(out["is_anomalous"].sum() - 0.05 * n) <= 1
    assert ((out["score"] > 0) & (out["score"] < 1)).all()
    # decision < 0 exactly for flagged rows; lower decision = higher score
    assert ((out["decision"] < 0) == (out["is_anomalous"] == 1)).all()
    assert np.corrcoef(out["decision"], -out["score"])[0, 1] > 0.999


def test_average_path_length():
    assert list(average_path_length(np.array([0, 1, 2]))) == [0.0, 0.0, 1.0]
    n = 256.0
    assert average_path_length(np.array([n]))[0] == pytest.approx(2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n)


def test_split_and_folds_are_exact_and_stratified(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "label")
    split = stratified_split(emb, "vec_id", "label", 0.2, seed=7).toPandas()
    for _, g in split.groupby("label"):
        assert g["is_test"].sum() == round(0.2 * len(g))
    folds = stratified_folds(emb, "vec_id", "label", 5, seed=7).toPandas()
    assert len(folds) == emb.count() and folds["vec_id"].is_unique
    for _, g in folds.groupby("label"):
        counts = g["fold"].value_counts()
        assert counts.max() - counts.min() <= 1


def test_logit_odds_and_report(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("f"))
    model, classes = fit_logit(emb, "f", "label", max_iter=50)
    assert classes == sorted(classes)
    coef = coefficient_table(spark, model, classes, [f"e{i}" for i in range(64)])
    assert coef.count() == len(classes) * 64
    pred = emb.withColumn("p", F.col("label"))
    rep = {r["class"]: r for r in classification_report(pred, "label", "p").collect()}
    assert rep["accuracy"]["f1"] == 1.0 and rep["macro avg"]["precision"] == 1.0


def test_attach_labels_by_key_and_refit(spark, upz):
    small = spark.createDataFrame([(1, "0"), (3, "2")], "id long, c string")
    full = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    got = {r.id: r.c for r in attach_labels(full, small, "id", "c").collect()}
    assert got == {1: "0", 2: "Anomalo", 3: "2"}
    flagged = upz.withColumn("flag", (F.col("user_id") % 10 == 0).cast("int"))
    out = exclude_refit_label(flagged, "user_id", UP_FEATURES, "flag", k=4).toPandas()
    assert (out.loc[out["flag"] == 1, "cluster_label"] == "Anomalo").all()
    assert set(out.loc[out["flag"] == 0, "cluster_label"]) <= {"0", "1", "2", "3"}


def test_kmeans_sweep_fixed_point_and_cost(spark, upz):
    from regiopanel.operators.cluster import SweepModel, kmeans_sweep
    pair = [UP_FEATURES[0], UP_FEATURES[5]]
    fits = kmeans_sweep(upz, "user_id", [SweepModel("k3", UP_FEATURES, 3), SweepModel("k5", UP_FEATURES, 5),
                                         SweepModel("pair", pair, 2)], seed=1, tol=1e-9)
    x_all = upz.select(*UP_FEATURES).toPandas().to_numpy()
    for key, x in (("k3", x_all), ("k5", x_all), ("pair", x_all[:, [0, 5]])):
        c = fits[key]["centres"]
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(-1)
        lab = d.argmin(1)
        assert fits[key]["cost"] == pytest.approx(d.min(1).sum(), rel=1e-9)
        # converged Lloyd: every centre is the mean of its points
        for j in range(len(c)):
            if (lab == j).any():
                assert np.allclose(c[j], x[lab == j].mean(0), atol=1e-6)


def test_elbow_equals_the_fit_of_the_labels(spark, upz):
    from regiopanel.operators.cluster import SweepModel, elbow_sweep, kmeans_sweep
    fits = kmeans_sweep(upz, "user_id", [SweepModel("k3", UP_FEATURES, 3)], seed=42)
    _, centres, cost = kmeans_labels(upz, UP_FEATURES, k=3, seed=42, order_col="user_id")
    assert np.allclose(fits["k3"]["centres"], centres) and fits["k3"]["cost"] == pytest.approx(cost)
    assert dict(elbow_sweep(upz, "user_id", UP_FEATURES, ks=[3]))[3] == pytest.approx(cost)


def test_kmeans_fit_does_not_depend_on_input_partitioning(spark, upz):
    a = kmeans_labels(upz.repartition(1), UP_FEATURES, k=4, seed=3, order_col="user_id")[1]
    b = kmeans_labels(upz.repartition(7, "n_click"), UP_FEATURES, k=4, seed=3, order_col="user_id")[1]
    assert np.allclose(a, b)


def test_isolation_forest_is_independent_of_partitioning(spark, upz):
    a = isolation_forest(upz.repartition(1), "user_id", UP_FEATURES, n_trees=20, seed=5).toPandas()
    b = isolation_forest(upz.repartition(6, "n_view"), "user_id", UP_FEATURES, n_trees=20, seed=5).toPandas()
    m = a.merge(b, on="user_id", suffixes=("_a", "_b"))
    assert len(m) == len(a) == len(b)
    assert np.allclose(m["score_a"], m["score_b"], atol=1e-12)
    assert (m["is_anomalous_a"] == m["is_anomalous_b"]).all()


def test_holdout_parts_are_disjoint_and_supports_add_up(spark):
    from regiopanel.operators.classify import classification_report, holdout_predictions
    rows = [(i, [float(i % 7), float(i % 3)], f"c{i % 3}") for i in range(150)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label string")
    for scope in ("all", "fold"):
        held = holdout_predictions(df, "id", "features", "label", 0.2, seed=1, fit_scope=scope).toPandas()
        assert held["id"].is_unique and held["label"].value_counts().to_dict() == {"c0": 10, "c1": 10, "c2": 10}
        assert (held["label"] == held["prediction"]).mean() > 0.9
    rep = classification_report(spark.createDataFrame(held), "label", "prediction").toPandas().set_index("class")
    assert rep.loc["accuracy", "support"] == len(held)


def test_report_reads_the_confusion_table_once(spark):
    from regiopanel.operators.classify import classification_report
    df = spark.range(100).selectExpr("id % 3 AS label", "id % 4 AS pred")
    plan = classification_report(df, "label", "pred")._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and "Scan ExistingRDD" in plan


def test_forest_decisions_need_no_join(spark, upz):
    out = isolation_forest(upz, "user_id", UP_FEATURES, n_trees=5, seed=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_forest_samples_are_exact_and_fixed_by_the_rows(spark):
    from regiopanel.operators.anomaly import sample_rows
    rows = spark.range(30_000)
    a = sorted(map(tuple, sample_rows(rows.repartition(2), "id", 30_000, 40, 64, 7).select("_tree", "id").collect()))
    b = sorted(map(tuple, sample_rows(rows.repartition(9), "id", 30_000, 40, 64, 7).select("_tree", "id").collect()))
    assert a == b and len(a) == len(set(a)) == 40 * 64
    assert {t for t, _ in a} == set(range(40))
    ids = np.array([i for _, i in a])
    assert abs(ids.mean() - 15_000) < 4 * 30_000 / np.sqrt(12 * len(ids))
    few = sample_rows(spark.range(10), "id", 10, 5, 10, 7)
    assert few.count() == 50 and sample_rows(spark.range(0), "id", 0, 5, 0, 7).count() == 0


def test_candidates_are_independent_draws(spark):
    from pyspark.sql import functions as F
    from regiopanel.operators.anomaly import candidate_trees
    n, t, p = 40_000, 20, 0.05
    got = spark.range(n).select(F.explode(candidate_trees("id", 3, t, p)).alias("t"), "id").toPandas()
    hit = np.zeros((t, n))
    hit[got["t"], got["id"]] = 1
    assert got.duplicated().sum() == 0
    sd = np.sqrt(n * p * (1 - p))
    assert (np.abs(hit.sum(axis=1) - n * p) < 5 * sd).all()
    both = hit @ hit.T
    off = both[~np.eye(t, dtype=bool)]
    assert (np.abs(off - n * p * p) < 6 * np.sqrt(n * p * p)).all()


def test_gradient_vanishes_at_the_optimum_and_not_beside_it(spark):
    from regiopanel.operators.classify import fit_logit, loss_gradient
    rows = [(float(a), float(b), ["x", "y", "z"][(a * 3 + b * 5 + a * b) % 3]) for a in range(-4, 5) for b in range(-4, 5)]
    df = spark.createDataFrame(rows, "a double, b double, label string")
    names = ["a", "b"]
    best, classes = fit_logit(df, names, "label", tol=1e-12)
    early, _ = fit_logit(df, names, "label", max_iter=1, tol=1e-12)
    size = lambda m: max(abs(r.gradient) for r in loss_gradient(df, m, classes, names, "label", names).collect())
    assert size(best) < 1e-5 < 1e-3 < size(early)
    # Against differences of the objective itself, in a model that is not at its optimum.
    x = np.array([[r[0], r[1]] for r in rows])
    y = np.array([classes.index(r[2]) for r in rows])
    w0 = np.column_stack([early.coefficientMatrix.toArray(), early.interceptVector.toArray()])

    def objective(w):
        z = x @ w[:, :2].T + w[:, 2]
        return (0.5 * (w[:, :2] ** 2).sum() + (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).sum()) / len(y)
    got = {(r["class"], r["feature"]): r["gradient"] for r in loss_gradient(df, early, classes, names, "label", names).collect()}
    for i, c in enumerate(classes):
        for j, f in enumerate([*names, "intercept"]):
            step = np.zeros_like(w0)
            step[i, j] = 1e-6
            assert abs(got[(c, f)] - (objective(w0 + step) - objective(w0 - step)) / 2e-6) < 1e-6
    assert loss_gradient(df.filter("false"), best, classes, names, "label", names).count() == 0


def test_sweep_metric_is_named(spark):
    import pytest
    from regiopanel.operators.cluster import pca_sensitivity, subset_sensitivity
    from regiopanel.operators.geometry import silhouette_squared, silhouette_squared_samples
    rng = np.random.default_rng(3)
    pts = [(i, *[float(v) for v in rng.normal(size=4) + 4 * (i % 3)]) for i in range(60)]
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame(pts, "id long, a double, b double, c double, d double")
    for study in (lambda m: pca_sensitivity(df, "id", cols, ns=(2, 3), k=3, metric=m),
                  lambda m: subset_sensitivity(df, "id", cols, size=3, k=3, metric=m)):
        exact, squared = dict(study("euclidean")), dict(study("sqeuclidean"))
        assert exact.keys() == squared.keys()
        assert all(squared[k] > exact[k] > 0.3 for k in exact)  # three clusters far apart
    with pytest.raises(ValueError):
        pca_sensitivity(df, "id", cols, metric="cosine")
    # Models of a group column, of different lengths, score as each alone.
    one = df.select("id", F.pmod("id", F.lit(3)).alias("label"), F.array("a", "b").alias("f"), F.lit("m1").alias("m"))
    two = df.select("id", F.pmod("id", F.lit(2)).alias("label"), F.array("a", "b", "c").alias("f"), F.lit("m2").alias("m"))
    for width in (1, 64):
        both = silhouette_squared_samples(one.unionByName(two), "label", "f", width, group_col="m")
        got = {r["m"]: r["s"] for r in both.groupBy("m").agg(F.avg("silhouette_sq").alias("s")).collect()}
        assert abs(got["m1"] - silhouette_squared(one, "label", "f")) < 1e-9
        assert abs(got["m2"] - silhouette_squared(two, "label", "f")) < 1e-9
