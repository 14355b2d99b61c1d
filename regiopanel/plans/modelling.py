"""Modelling-stage queries: k-means, PCA, sensitivity, isolation forest, classification.

k-means, PCA, the component study and a two-feature logistic fit are recomputed
by recursive SQL; forests and the larger fits are checked by row count only
(their random draws differ from any other library's).
"""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from regiopanel.operators.anomaly import isolation_forest, leave_one_out_importance
from regiopanel.operators.classify import (classification_report, coefficient_table, cross_validate,
                                           fit_logit, holdout_predictions, loss_gradient, predict_logit, stratified_folds, stratified_split,
                                           weighted_scores, zscore_array)
from regiopanel.operators.cluster import (ROUNDS, attach_labels, elbow_sweep, exclude_refit_label, fit_pca,
                                          kmeans_labels, pair_kmeans, pca_scores, pca_sensitivity,
                                          subset_sensitivity)
from regiopanel.operators.geometry import nearest_centroid
from regiopanel.plans.fixtures import UP_FEATURES, embeddings, tables
from regiopanel.plans.registry import register
from regiopanel.plans.sqlfrag import UPZ_SQL, euclid, jacobi_sql, sqeuclid
from regiopanel.session import materialize
from regiopanel.plans.stats_q import _emb_centres, user_panel_z

def _kmeans_sql(ks: list[int], points: str = "p", cols: list[str] | None = None, tag: str = "") -> str:
    """CTEs of k-means on ``points`` (user_id and ``cols``): ``fin`` + tag (model k, cid, centre after all Lloyd rounds).

    Seeds by farthest point one after the other, shared by all k; then ROUNDS rounds by recursion.
    """
    feats = cols or UP_FEATURES
    cols = ", ".join(feats)
    far = [f"c1{tag} AS MATERIALIZED (SELECT {cols} FROM {points} ORDER BY user_id LIMIT 1)",
           f"m1{tag} AS MATERIALIZED (SELECT p.*, {sqeuclid('p', 'c', feats)} AS m FROM {points} p, c1{tag} c)"]
    for j in range(2, max(ks) + 1):
        far.append(f"c{j}{tag} AS MATERIALIZED (SELECT {cols} FROM m{j - 1}{tag} ORDER BY m DESC, user_id LIMIT 1)")
        old = ", ".join(f"o.{c}" for c in ["user_id", *feats])
        far.append(f"m{j}{tag} AS MATERIALIZED (SELECT {old}, least(o.m, {sqeuclid('o', 'c', feats)}) AS m FROM m{j - 1}{tag} o, c{j}{tag} c)")
    seeds = " UNION ALL ".join(f"SELECT 0 AS r, {k} AS k, {j} AS cid, {cols} FROM c{j}{tag}" for k in ks for j in range(1, k + 1))
    point = ", ".join(f"p.{c}" for c in ["user_id", *feats])
    means = ", ".join(f"AVG({c})" for c in feats)
    return f"""{", ".join(far)},
l{tag}(r, k, cid, {cols}) AS (
  {seeds} UNION ALL
  SELECT r + 1, k, cid, {means} FROM (
    SELECT l.r, l.k, {point}, arg_min(l.cid, {sqeuclid("p", "l", feats)}) AS cid
    FROM l{tag} l JOIN {points} p ON l.r < {ROUNDS} GROUP BY l.r, l.k, {point}) GROUP BY r, k, cid),
fin{tag} AS (SELECT * FROM l{tag} WHERE r = {ROUNDS})"""


_POINTS = f"WITH RECURSIVE p AS MATERIALIZED ({UPZ_SQL})"
_ORDER = ", ".join(f"ROUND({c}, 12)" for c in UP_FEATURES)


@register("kmeans_labels", stage="model", sql=f"{_POINTS}, {_kmeans_sql([3])}" + f""",
named AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}) - 1 AS name FROM fin)
SELECT p.user_id, CAST(arg_min(n.name, {sqeuclid("p", "n", UP_FEATURES)}) AS INTEGER) AS cluster FROM p, named n GROUP BY p.user_id
""")
def q_kmeans_labels(spark, sf_dir):
    labelled, _, _ = kmeans_labels(user_panel_z(spark, sf_dir), UP_FEATURES, k=3, order_col="user_id")
    return labelled.select("user_id", "cluster")


@register("elbow_sweep", stage="model", sql=f"{_POINTS}, {_kmeans_sql(list(range(1, 11)))}" + f"""
SELECT CAST(k AS INTEGER) AS k, ROUND(SUM(d), 6) AS inertia FROM (
  SELECT n.k, p.user_id, MIN({sqeuclid("p", "n", UP_FEATURES)}) AS d FROM p, fin n GROUP BY 1, 2) GROUP BY 1
""")
def q_elbow_sweep(spark, sf_dir):
    rows = elbow_sweep(user_panel_z(spark, sf_dir), "user_id", UP_FEATURES, ks=range(1, 11))
    return spark.createDataFrame([(k, float(v)) for k, v in rows], "k int, inertia double").withColumn("inertia", F.round("inertia", 6))


def _up_pca(spark, sf_dir, k):
    z = user_panel_z(spark, sf_dir)
    return z, fit_pca(z, UP_FEATURES, k)


_PCA_SQL = f"{_POINTS}, {jacobi_sql('p', UP_FEATURES)}"
_FEATURE_LIST = ", ".join(f"'{c}'" for c in UP_FEATURES)


def _score_sql(component: int) -> str:
    """Centred score of a row of ``p``, with ``load(component, l)`` the loadings as one list."""
    terms = " + ".join(f"({c} - AVG({c}) OVER ()) * l{component}[{i + 1}]" for i, c in enumerate(UP_FEATURES))
    return f"({terms})"


@register("pca_scores", stage="model", sql=_PCA_SQL + f""",
lists AS (SELECT list(loading ORDER BY i) FILTER (WHERE component = 1) AS l1, list(loading ORDER BY i) FILTER (WHERE component = 2) AS l2 FROM vec)
SELECT user_id, ROUND({_score_sql(1)}, 6) AS pc1, ROUND({_score_sql(2)}, 6) AS pc2 FROM p, lists
""")
def q_pca_scores(spark, sf_dir):
    z, pca = _up_pca(spark, sf_dir, 2)
    return pca_scores(z, pca, keep=["user_id"]).select("user_id", *[F.round(c, 6).alias(c) for c in ("pc1", "pc2")])


@register("pca_variance", stage="model", sql=_PCA_SQL + """,
share AS (SELECT component, value / SUM(value) OVER () AS ratio FROM eig)
SELECT CAST(component AS INTEGER) AS component, ROUND(ratio, 6) AS explained_variance_ratio,
       ROUND(SUM(ratio) OVER (ORDER BY component), 6) AS cumulative FROM share
""")
def q_pca_variance(spark, sf_dir):
    _, pca = _up_pca(spark, sf_dir, len(UP_FEATURES))
    ratio = [float(v) for v in pca["ratio"]]
    cum = [float(sum(ratio[:i + 1])) for i in range(len(ratio))]
    return spark.createDataFrame([(i + 1, round(r, 6), round(c, 6)) for i, (r, c) in enumerate(zip(ratio, cum))],
                                 "component int, explained_variance_ratio double, cumulative double")


@register("loadings_table", stage="model", sql=_PCA_SQL + f"""
SELECT left([{_FEATURE_LIST}][i + 1], 10) AS variable, CAST(component AS INTEGER) AS component, ROUND(loading, 6) AS loading
FROM vec WHERE component <= 2
""")
def q_loadings_table(spark, sf_dir):
    _, pca = _up_pca(spark, sf_dir, 2)
    comps = pca["components"]
    rows = [(name, j + 1, round(float(comps[i, j]), 6)) for i, name in enumerate(UP_FEATURES) for j in range(comps.shape[1])]
    df = spark.createDataFrame(rows, "variable string, component int, loading double")
    # Variable names shortened to 10 characters, as in the reference's tables.
    return df.withColumn("variable", F.left(F.col("variable"), F.lit(10)))


def _sensitivity_sql(ns: list[int], k: int, squared: bool) -> str:
    """``sil(n_components, silhouette)``: k-means on the first n scores of every row, scored by all pairs of rows."""
    every = max(ns)
    lists = ", ".join(f"list(loading ORDER BY i) FILTER (WHERE component = {j}) AS l{j}" for j in range(1, every + 1))
    parts = [_PCA_SQL, f"lists AS (SELECT {lists} FROM vec)", "sc AS MATERIALIZED (SELECT user_id, " + ", ".join(
        f"{_score_sql(j)} AS s{j}" for j in range(1, every + 1)) + " FROM p, lists)"]
    for n in ns:
        cols = [f"s{j}" for j in range(1, n + 1)]
        gap = sqeuclid("x", "y", cols) if squared else euclid("x", "y", cols)
        parts += [_kmeans_sql([k], "sc", cols, f"_{n}"), f"""
lab_{n} AS MATERIALIZED (SELECT p.*, t.cid FROM sc p JOIN (
  SELECT p.user_id, arg_min(c.cid, {sqeuclid("p", "c", cols)}) AS cid FROM sc p, fin_{n} c GROUP BY 1) t USING (user_id))""", f"""
near_{n} AS (SELECT x.user_id, x.cid AS own, y.cid AS other, SUM({gap}) AS total, COUNT(*) AS n FROM lab_{n} x, lab_{n} y GROUP BY 1, 2, 3)""", f"""
sil_{n} AS (SELECT CASE WHEN n < 2 THEN 0 WHEN b IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM (
  SELECT user_id, MAX(n) FILTER (WHERE own = other) AS n, MAX(total / NULLIF(n - 1, 0)) FILTER (WHERE own = other) AS a,
         MIN(total / n) FILTER (WHERE own <> other) AS b FROM near_{n} GROUP BY user_id))"""]
    union = " UNION ALL ".join(f"SELECT {n} AS n_components, AVG(s) AS silhouette FROM sil_{n}" for n in ns)
    name = "sqeuclidean" if squared else "euclidean"
    return ", ".join(parts) + f""", sil AS ({union})
SELECT CAST(n_components AS INTEGER) AS n_components, ROUND(silhouette, 6) AS silhouette,
       silhouette = MAX(silhouette) OVER () AS is_best, '{name}' AS metric FROM sil"""


def _sensitivity(spark, sf_dir, metric):
    res = pca_sensitivity(user_panel_z(spark, sf_dir), "user_id", UP_FEATURES, ns=(2, 3, 4, 5), k=6, seed=0, metric=metric)
    best = max(res, key=lambda t: t[1])[0]
    return spark.createDataFrame([(n, round(s, 6), n == best, metric) for n, s in res],
                                 "n_components int, silhouette double, is_best boolean, metric string")


@register("pca_sensitivity", stage="model", sql=_sensitivity_sql([2, 3, 4, 5], 6, False))
def q_pca_sensitivity(spark, sf_dir):
    return _sensitivity(spark, sf_dir, "euclidean")


@register("pca_sensitivity_squared", stage="model", sql=_sensitivity_sql([2, 3, 4, 5], 6, True))
def q_pca_sensitivity_squared(spark, sf_dir):
    """The same study at linear cost: squared distances instead of exact ones."""
    return _sensitivity(spark, sf_dir, "sqeuclidean")


@register("subset_sensitivity", stage="model")
def q_subset_sensitivity(spark, sf_dir):
    res = subset_sensitivity(user_panel_z(spark, sf_dir), "user_id", UP_FEATURES, size=4, n_components=2,
                             k=4, seed=42)
    return spark.createDataFrame([(",".join(sub), s, i + 1) for i, (sub, s) in enumerate(res)],
                                 "subset string, silhouette double, rank int")


@register("pair_kmeans", stage="model")
def q_pair_kmeans(spark, sf_dir):
    """k-means on every pair of the four features that matter most to the isolation forest."""
    z = user_panel_z(spark, sf_dir)
    top = leave_one_out_importance(z, "user_id", UP_FEATURES, seed=42).orderBy(F.col("importance").desc(), "feature")
    names = [r["feature"] for r in top.limit(4).collect()]
    res = pair_kmeans(z, "user_id", list(itertools.combinations(names, 2)), k=3, seed=42)
    rows = [(f"{x}|{y}", c, float(cen[c][0]), float(cen[c][1])) for (x, y), cen in res for c in range(len(cen))]
    return spark.createDataFrame(rows, "pair string, cluster int, cx double, cy double")


@register("iforest_scores", stage="model")
def q_iforest_scores(spark, sf_dir):
    out = isolation_forest(user_panel_z(spark, sf_dir), "user_id", UP_FEATURES, contamination=0.05, seed=42)
    return out.select("user_id", "score", "decision")


@register("iforest_flag", stage="model")
def q_iforest_flag(spark, sf_dir):
    out = isolation_forest(user_panel_z(spark, sf_dir), "user_id", UP_FEATURES, contamination=0.05, seed=42)
    return out.select("user_id", "decision", "is_anomalous")


@register("loo_importance", stage="model")
def q_loo_importance(spark, sf_dir):
    imp = leave_one_out_importance(user_panel_z(spark, sf_dir), "user_id", UP_FEATURES, seed=42)
    return imp.orderBy(F.col("importance").desc(), "feature")


@register("exclude_refit_label", stage="model")
def q_exclude_refit_label(spark, sf_dir):
    """The reference's final clustering: drop isolation-forest anomalies, refit PCA(2) + k-means(4)
    on the rest, label all rows, 'Anomalo' for the excluded ones."""
    z = user_panel_z(spark, sf_dir)
    flagged = isolation_forest(z, "user_id", UP_FEATURES, contamination=0.05, seed=42, keep=UP_FEATURES)
    out = exclude_refit_label(flagged, "user_id", UP_FEATURES, "is_anomalous", n_components=2, k=4, seed=42)
    return out.select("user_id", "is_anomalous", "cluster_label")


@register("exclude_and_label", stage="model", sql="""
SELECT vec_id, CASE WHEN label < 8 THEN CAST(label AS VARCHAR) ELSE 'Anomalo' END AS cluster_label
FROM embeddings
""")
def q_exclude_and_label(spark, sf_dir):
    emb = tables(spark, sf_dir)["embeddings"]
    kept = emb.filter(F.col("label") < 8).select("vec_id", F.col("label").cast("string").alias("cluster_label"))
    return attach_labels(emb.select("vec_id"), kept, "vec_id", "cluster_label", default="Anomalo")


@register("stratified_split", stage="model", sql="""
SELECT vec_id, label,
       CASE WHEN row_number() OVER (PARTITION BY label ORDER BY vec_id)
                 <= ROUND(COUNT(*) OVER (PARTITION BY label) * 0.2) THEN 1 ELSE 0 END AS is_test
FROM embeddings
""")
def q_stratified_split(spark, sf_dir):
    emb = tables(spark, sf_dir)["embeddings"].select("vec_id", "label")
    return stratified_split(emb, "vec_id", "label", 0.2, seed=None)


@register("stratified_folds", stage="model", sql="""
SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) % 5 AS INTEGER) AS fold
FROM embeddings
""")
def q_stratified_folds(spark, sf_dir):
    emb = tables(spark, sf_dir)["embeddings"].select("vec_id", "label")
    return stratified_folds(emb, "vec_id", "label", 5, seed=None)


_REPORT_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
u AS (SELECT vec_id, label, unnest(range(1, len(f) + 1)) AS i, unnest(f) AS v FROM e),
c AS (SELECT label AS cl, i, AVG(v) AS m FROM u GROUP BY 1, 2),
d AS (SELECT u.vec_id, u.label, c.cl, SUM((u.v - c.m) * (u.v - c.m)) AS d2
      FROM u JOIN c ON u.i = c.i GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cl) AS rn FROM d),
p AS (SELECT CAST(label AS VARCHAR) AS label, CAST(cl AS VARCHAR) AS pred FROM r WHERE rn = 1),
cls AS (SELECT label AS c FROM p UNION SELECT pred FROM p),
cnt AS (SELECT c, COUNT(*) FILTER (WHERE label = c AND pred = c) AS tp,
               COUNT(*) FILTER (WHERE label = c) AS support,
               COUNT(*) FILTER (WHERE pred = c) AS npred
        FROM cls, p GROUP BY c),
pr AS (SELECT c, tp, support,
              COALESCE(tp::DOUBLE / NULLIF(npred, 0), 0) AS precision,
              COALESCE(tp::DOUBLE / NULLIF(support, 0), 0) AS recall FROM cnt),
per AS (SELECT c AS class, precision, recall,
               COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1, support, tp FROM pr)
SELECT class, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, support FROM per
UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 6), ROUND(AVG(recall), 6), ROUND(AVG(f1), 6),
                 CAST(SUM(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * support) / SUM(support), 6),
                 ROUND(SUM(recall * support) / SUM(support), 6), ROUND(SUM(f1 * support) / SUM(support), 6),
                 CAST(SUM(support) AS BIGINT) FROM per
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(SUM(tp)::DOUBLE / SUM(support), 6), CAST(SUM(support) AS BIGINT)
          FROM per
"""


@register("classification_report", stage="model", sql=_REPORT_SQL)
def q_classification_report(spark, sf_dir):
    emb = embeddings(spark, sf_dir)
    pred = nearest_centroid(emb, "features", _emb_centres(spark, sf_dir), "label", "centre", out="nearest",
                            id_col="vec_id")
    rep = classification_report(pred, "label", "nearest")
    return rep.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("long").alias("support"))


def _emb_z(spark, sf_dir):
    """Features (z-scored embeddings) aligned BY KEY with the saved cluster labels.

    The reference fits the classifier on features from one file and labels from
    another, matched by row position; here the label table (strings, with
    'Anomalo' for excluded rows) is joined on the id.
    """
    feats = zscore_array(embeddings(spark, sf_dir).select("vec_id", "features"), "features")
    labels = q_exclude_and_label(spark, sf_dir).withColumnRenamed("cluster_label", "label")
    # Written once: the count, the label index, the fit and the predictions all read it.
    return materialize(feats.join(labels, "vec_id", "inner"))


def _emb_feature_names(spark, sf_dir):
    dim = tables(spark, sf_dir)["embeddings"].select(F.size("embedding").alias("d")).first()["d"]
    return [f"e{i}" for i in range(dim)]


@register("logit_fit", stage="model")
def q_logit_fit(spark, sf_dir):
    z = _emb_z(spark, sf_dir)
    model, classes = fit_logit(z, "features", "label")
    return predict_logit(z, model, classes, "features").select("vec_id", "label", "prediction")


@register("logit_coefficients", stage="model")
def q_logit_coefficients(spark, sf_dir):
    model, classes = fit_logit(_emb_z(spark, sf_dir), "features", "label")
    return coefficient_table(spark, model, classes, _emb_feature_names(spark, sf_dir))


@register("logit_gradient", stage="model")
def q_logit_gradient(spark, sf_dir):
    """Proof of the optimum: gradient of the penalised mean loss at the fitted weights, all near zero."""
    z = _emb_z(spark, sf_dir)
    model, classes = fit_logit(z, "features", "label")
    return loss_gradient(z, model, classes, "features", "label", _emb_feature_names(spark, sf_dir))


_TWO = ["embedding[1]", "embedding[2]"]
_NEWTON_STEPS = 30


def _newton_sql() -> str:
    """``fit(b, w1, w2)``: penalised Newton steps of the two-class fit on two z-scored coordinates.

    The two classes' weights are opposite halves of ``w``, so 0.5 |W|^2 is 0.25 |w|^2.
    """
    z = ", ".join(f"(CAST({c} AS DOUBLE) - AVG(CAST({c} AS DOUBLE)) OVER ()) / STDDEV_POP(CAST({c} AS DOUBLE)) OVER () AS x{i + 1}"
                  for i, c in enumerate(_TWO))
    det = ("h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02)")
    d0 = "g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)"
    d1 = "h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)"
    d2 = "h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)"
    return f"""WITH RECURSIVE z AS MATERIALIZED (SELECT {z}, CASE WHEN label < 8 THEN 1.0 ELSE 0.0 END AS y FROM embeddings),
newton(r, b, w1, w2) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL
  SELECT r + 1, b - ({d0}) / ({det}), w1 - ({d1}) / ({det}), w2 - ({d2}) / ({det}) FROM (
    SELECT r, b, w1, w2, SUM(p - y) AS g0, SUM((p - y) * x1) + 0.5 * w1 AS g1, SUM((p - y) * x2) + 0.5 * w2 AS g2,
           SUM(p * (1 - p)) AS h00, SUM(p * (1 - p) * x1) AS h01, SUM(p * (1 - p) * x2) AS h02,
           SUM(p * (1 - p) * x1 * x1) + 0.5 AS h11, SUM(p * (1 - p) * x1 * x2) AS h12, SUM(p * (1 - p) * x2 * x2) + 0.5 AS h22
    FROM (SELECT n.*, z.*, 1 / (1 + exp(-(b + w1 * x1 + w2 * x2))) AS p FROM newton n, z WHERE r < {_NEWTON_STEPS}) GROUP BY r, b, w1, w2)),
fit AS (SELECT * FROM newton WHERE r = {_NEWTON_STEPS})"""


@register("logit_two_features", stage="model", sql=_newton_sql() + """,
half AS (SELECT unnest(['e0', 'e1', 'intercept']) AS feature, unnest([w1 / 2, w2 / 2, b / 2]) AS v FROM fit)
SELECT class, feature, ROUND(sign * v, 4) AS coefficient FROM half, (VALUES ('Anomalo', -1), ('Normal', 1)) AS s(class, sign)
""")
def q_logit_two_features(spark, sf_dir):
    """The penalised fit of 'Anomalo' against the rest on two coordinates, to the optimum."""
    emb = embeddings(spark, sf_dir).select("vec_id", F.slice("features", 1, 2).alias("features"),
                                           F.when(F.col("label") < 8, "Normal").otherwise("Anomalo").alias("label"))
    z = materialize(zscore_array(emb, "features"))
    model, classes = fit_logit(z, "features", "label", tol=1e-12)
    table = coefficient_table(spark, model, classes, ["e0", "e1"], intercept="intercept")
    return table.withColumn("coefficient", F.round("coefficient", 4))


@register("odds_ratios", stage="model")
def q_odds_ratios(spark, sf_dir):
    model, classes = fit_logit(_emb_z(spark, sf_dir), "features", "label")
    coef = coefficient_table(spark, model, classes, _emb_feature_names(spark, sf_dir))
    return coef.select("class", "feature", F.exp("coefficient").alias("odds_ratio"))


@register("cv_accuracy", stage="model")
def q_cv_accuracy(spark, sf_dir):
    accs, _ = cross_validate(_emb_z(spark, sf_dir), "vec_id", "features", "label", k=5, seed=42)
    import statistics
    rows = [(str(i), a) for i, a in enumerate(accs)]
    rows += [("mean", float(statistics.fmean(accs))), ("std", float(statistics.pstdev(accs)))]
    return spark.createDataFrame(rows, "fold string, accuracy double")


@register("oof_weighted", stage="model")
def q_oof_weighted(spark, sf_dir):
    _, oof = cross_validate(_emb_z(spark, sf_dir), "vec_id", "features", "label", k=5, seed=42)
    return weighted_scores(oof, "label", "prediction")


def _report_columns(rep):
    return rep.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("long").alias("support"))


@register("logit_report", stage="model")
def q_logit_report(spark, sf_dir):
    """Report of the classifier on the rows it was fitted on."""
    z = _emb_z(spark, sf_dir)
    model, classes = fit_logit(z, "features", "label")
    return _report_columns(classification_report(predict_logit(z, model, classes, "features"), "label", "prediction"))


@register("holdout_report", stage="model")
def q_holdout_report(spark, sf_dir):
    """Fit on 80 % of each class, report on the other 20 %."""
    held = holdout_predictions(_emb_z(spark, sf_dir), "vec_id", "features", "label", 0.2, seed=42)
    return _report_columns(classification_report(held, "label", "prediction"))


_SPLIT_SUPPORT = """
SELECT CASE WHEN label < 8 THEN CAST(label AS VARCHAR) ELSE 'Anomalo' END AS class, COUNT(*) AS n FROM embeddings GROUP BY 1
"""


@register("holdout_support", stage="model", sql=f"""
SELECT class, CAST(ROUND(n * 0.2) AS BIGINT) AS support FROM ({_SPLIT_SUPPORT}) WHERE ROUND(n * 0.2) > 0
UNION ALL SELECT 'total', CAST(SUM(ROUND(n * 0.2)) AS BIGINT) FROM ({_SPLIT_SUPPORT})
""")
def q_holdout_support(spark, sf_dir):
    """Rows of each class that the hold-out classifier has predicted."""
    held = holdout_predictions(_emb_z(spark, sf_dir), "vec_id", "features", "label", 0.2, seed=42)
    per = materialize(held.groupBy(F.col("label").alias("class")).agg(F.count("prediction").alias("support")))
    return per.unionByName(per.agg(F.lit("total").alias("class"), F.sum("support").alias("support")))


@register("pca_total_variance", stage="model", sql=f"""
SELECT {len(UP_FEATURES)} AS components, ROUND({" + ".join(f"VAR_SAMP({c})" for c in UP_FEATURES)}, 6) AS total_variance
FROM ({UPZ_SQL})
""")
def q_pca_total_variance(spark, sf_dir):
    """The variances of all component scores add up to the total variance of the features."""
    z, pca = _up_pca(spark, sf_dir, len(UP_FEATURES))
    scores = pca_scores(z, pca)
    total = sum((F.var_samp(c) for c in scores.columns[1:]), F.var_samp(scores.columns[0]))
    return scores.agg(F.lit(len(scores.columns)).alias("components"), F.round(total, 6).alias("total_variance"))


@register("iforest_flag_count", stage="model", sql="""
SELECT COUNT(*) AS n_rows, CAST(CEIL((COUNT(*) - 1) * CAST(0.05 AS DOUBLE)) AS BIGINT) AS n_flagged FROM (SELECT DISTINCT user_id FROM events)
""")
def q_iforest_flag_count(spark, sf_dir):
    """Rows scored, and rows below the contamination threshold (scores are distinct but for rows with equal features)."""
    flags = q_iforest_flag(spark, sf_dir)
    return flags.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("is_anomalous").cast("long").alias("n_flagged"))


@register("cv_fold_rows", stage="model", sql=f"""
WITH c AS ({_SPLIT_SUPPORT}), f AS (SELECT unnest(range(0, 5)) AS fold)
SELECT CAST(fold AS INTEGER) AS fold, CAST(SUM((n + 4 - fold) // 5) AS BIGINT) AS n FROM c, f GROUP BY 1
""")
def q_cv_fold_rows(spark, sf_dir):
    """Rows that each fold's classifier has predicted; scaling is fitted on the training folds only."""
    feats = embeddings(spark, sf_dir).select("vec_id", "features")
    labels = q_exclude_and_label(spark, sf_dir).withColumnRenamed("cluster_label", "label")
    _, oof = cross_validate(materialize(feats.join(labels, "vec_id")), "vec_id", "features", "label", k=5, seed=42, fit_scope="fold")
    return oof.filter("prediction IS NOT NULL").groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("kmeans_decomposition", stage="model", sql=f"""
SELECT COUNT(*) AS n_rows, ROUND(COUNT(*) * ({" + ".join(f"VAR_POP({c})" for c in UP_FEATURES)}), 6) AS total_squares FROM ({UPZ_SQL})
""")
def q_kmeans_decomposition(spark, sf_dir):
    """Squares within the fitted clusters plus squares between them: the total of the features."""
    labelled, _, _ = kmeans_labels(user_panel_z(spark, sf_dir), UP_FEATURES, k=3, seed=42, order_col="user_id")
    per = materialize(labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in UP_FEATURES],
        *[F.var_pop(c).alias(f"v_{c}") for c in UP_FEATURES]))
    grand = per.agg(F.sum("n").alias("rows"), *[(F.sum(F.col("n") * F.col(f"m_{c}")) / F.sum("n")).alias(f"g_{c}") for c in UP_FEATURES])
    squares = sum((F.col(f"v_{c}") + F.pow(F.col(f"m_{c}") - F.col(f"g_{c}"), 2) for c in UP_FEATURES), F.lit(0.0))
    # One row per cluster against one row of means.
    return per.join(F.broadcast(grand)).agg(F.sum("n").alias("n_rows"), F.round(F.sum(F.col("n") * squares), 6).alias("total_squares"))
