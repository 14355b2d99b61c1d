"""Statistics and cluster-geometry queries over the user panel (UP) and embeddings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from regiopanel.operators.geometry import (as_array, centroids, decision_grid,
                                           inertia_by_label, nearest_centroid, silhouette_1d,
                                           silhouette_samples, silhouette_squared_samples, total_inertia)
from regiopanel.operators.ranking import group_rank
from regiopanel.operators.stats import (boxplot_stats, feature_variances, group_describe,
                                        running_share, to_long, top_k, value_counts, zscore)
from regiopanel.plans.fixtures import EMB_DIM, EMB_FEATURES, UP_FEATURES, emb_columns, embeddings, tables, user_panel
from regiopanel.plans.registry import register
from regiopanel.session import materialize
from regiopanel.plans.sqlfrag import EMB_LONG_SQL, EMB_SQL, UP_SQL, UPZ_SQL, euclid, sqeuclid


def _round_all(df, cols, digits=6):
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def user_panel_z(spark, sf_dir):
    """Z-scored user panel. The panel is written once (one scan of `events`); the
    moments pass and every later fit or projection read the written copy."""
    return zscore(materialize(user_panel(spark, sf_dir)), UP_FEATURES)


@register("zscore", stage="stats", sql=f"""
SELECT user_id, {", ".join(f"ROUND({c}, 6) AS {c}" for c in UP_FEATURES)} FROM ({UPZ_SQL})
""")
def q_zscore(spark, sf_dir):
    return _round_all(user_panel_z(spark, sf_dir), UP_FEATURES)


@register("cluster_describe", stage="stats", sql=f"""
SELECT label, variable, ROUND(AVG(value), 6) AS mean, ROUND(MEDIAN(value), 6) AS median,
       ROUND(STDDEV_SAMP(value), 6) AS std
FROM ({EMB_LONG_SQL}) GROUP BY 1, 2
""")
def q_cluster_describe(spark, sf_dir):
    return _round_all(group_describe(emb_columns(spark, sf_dir), "label", EMB_FEATURES), ["mean", "median", "std"])


@register("boxplot_stats", stage="stats", sql=f"""
WITH l AS ({EMB_LONG_SQL}),
q AS (SELECT label, variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM l GROUP BY 1, 2),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.label, f.variable, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
       ROUND(iqr, 6) AS iqr,
       ROUND(MIN(CASE WHEN value >= lo AND value <= hi THEN value END), 6) AS whisker_lo,
       ROUND(MAX(CASE WHEN value >= lo AND value <= hi THEN value END), 6) AS whisker_hi,
       COUNT(*) FILTER (WHERE NOT (value >= lo AND value <= hi)) AS n_outliers,
       COUNT(value) AS n
FROM f JOIN l ON f.label = l.label AND f.variable = l.variable
GROUP BY f.label, f.variable, q1, median, q3, iqr
""")
def q_boxplot_stats(spark, sf_dir):
    out = boxplot_stats(emb_columns(spark, sf_dir), "label", EMB_FEATURES)
    return _round_all(out, ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"])


@register("cluster_members", stage="stats", sql="""
WITH m AS (SELECT CASE WHEN label < 8 THEN CAST(label AS VARCHAR) ELSE 'Anomalo' END AS label, vec_id
           FROM embeddings)
SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS member_rank,
       COUNT(*) OVER (PARTITION BY label) AS n_members
FROM m
""")
def q_cluster_members(spark, sf_dir):
    emb = tables(spark, sf_dir)["embeddings"].select("vec_id", "label")
    kept = emb.filter(F.col("label") < 8).select(F.col("label").cast("string").alias("label"), "vec_id")
    # The appended group: rows flagged as anomalous stand in the reference's extra row.
    flagged = emb.filter(F.col("label") >= 8).select(F.lit("Anomalo").alias("label"), "vec_id")
    members = kept.unionByName(flagged)
    return group_rank(members, ["label"], ["vec_id"], rank_col="member_rank", size_col="n_members")


@register("value_counts", stage="stats", sql="""
SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1
""")
def q_value_counts(spark, sf_dir):
    return value_counts(tables(spark, sf_dir)["events"], "event_type")


_UP_VAR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, VAR_POP({c}) AS variance FROM ({UP_SQL})" for c in UP_FEATURES)


@register("topk_features", stage="stats", sql=f"""
SELECT feature, ROUND(variance, 6) AS variance FROM ({_UP_VAR_SQL}) ORDER BY variance DESC, feature LIMIT 4
""")
def q_topk_features(spark, sf_dir):
    v = feature_variances(user_panel(spark, sf_dir), UP_FEATURES)
    return _round_all(top_k(v, "variance", 4, ["feature"]), ["variance"])


@register("running_share", stage="stats", sql=f"""
WITH v AS ({_UP_VAR_SQL}),
s AS (SELECT feature, variance, variance / SUM(variance) OVER () AS share FROM v)
SELECT feature, ROUND(variance, 6) AS variance, ROUND(share, 6) AS share,
       ROUND(SUM(share) OVER (ORDER BY variance DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6)
         AS cum_share
FROM s
""")
def q_running_share(spark, sf_dir):
    v = feature_variances(user_panel(spark, sf_dir), UP_FEATURES)
    out = running_share(v, "variance", [F.col("variance").desc(), F.col("feature")])
    return _round_all(out, ["variance", "share", "cum_share"])


@register("centroids", stage="stats", sql=f"""
SELECT label, {", ".join(f"ROUND(AVG(x{i}), 6) AS x{i}" for i in range(EMB_DIM))} FROM ({EMB_SQL}) GROUP BY 1
""")
def q_centroids(spark, sf_dir):
    return _round_all(centroids(emb_columns(spark, sf_dir), "label", EMB_FEATURES), EMB_FEATURES)


# Display names of the labels (the reference names its clusters by hand).
LABEL_NAMES = {0: "alpha", 1: "beta", 2: "gamma", 3: "delta", 4: "epsilon",
               5: "zeta", 6: "eta", 7: "theta", 8: "iota", 9: "kappa"}


@register("cluster_profile", stage="stats", sql=f"""
WITH names(label, name) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in LABEL_NAMES.items())})
SELECT c.label, n.name, {", ".join(f"ROUND(AVG(x{i}), 3) AS x{i}" for i in range(EMB_DIM))}
FROM ({EMB_SQL}) c LEFT JOIN names n ON c.label = n.label
GROUP BY c.label, n.name
""")
def q_cluster_profile(spark, sf_dir):
    cents = centroids(emb_columns(spark, sf_dir), "label", EMB_FEATURES)
    names = spark.createDataFrame(sorted(LABEL_NAMES.items()), "label int, name string")
    prof = cents.join(F.broadcast(names), "label", "left")  # 10-row lookup table
    return prof.select("label", "name", *[F.round(c, 3).alias(c) for c in EMB_FEATURES])


@register("inertia", stage="stats", sql=f"""
WITH e AS ({EMB_SQL}),
c AS (SELECT label, {", ".join(f"AVG(x{i}) AS x{i}" for i in range(EMB_DIM))} FROM e GROUP BY 1)
SELECT e.label, COUNT(*) AS n, ROUND(SUM({sqeuclid("e", "c", EMB_FEATURES)}), 6) AS inertia
FROM e JOIN c ON e.label = c.label GROUP BY 1
""")
def q_inertia(spark, sf_dir):
    return _round_all(inertia_by_label(emb_columns(spark, sf_dir), "label", EMB_FEATURES), ["inertia"])


@register("inertia_k1", stage="stats", sql=f"""
WITH z AS ({UPZ_SQL}),
m AS (SELECT {", ".join(f"AVG({c}) AS {c}" for c in UP_FEATURES)} FROM z)
SELECT COUNT(*) AS n, ROUND(SUM({sqeuclid("z", "m", UP_FEATURES)}), 6) AS inertia FROM z, m
""")
def q_inertia_k1(spark, sf_dir):
    return _round_all(total_inertia(user_panel_z(spark, sf_dir), UP_FEATURES), ["inertia"])


def _emb_centres(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    emb = embeddings(spark, sf_dir)
    return (emb.select("label", array_to_vector("features").alias("v")).groupBy("label")
            .agg(Summarizer.mean(F.col("v")).alias("m"))
            .select("label", vector_to_array("m").alias("centre")))


@register("nearest_centroid", stage="stats", sql="""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
u AS (SELECT vec_id, label, unnest(range(1, len(f) + 1)) AS i, unnest(f) AS v FROM e),
c AS (SELECT label AS cl, i, AVG(v) AS m FROM u GROUP BY 1, 2),
d AS (SELECT u.vec_id, u.label, c.cl, SUM((u.v - c.m) * (u.v - c.m)) AS d2
      FROM u JOIN c ON u.i = c.i GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cl) AS rn FROM d)
SELECT vec_id, label, cl AS nearest, ROUND(sqrt(d2), 6) AS dist FROM r WHERE rn = 1
""")
def q_nearest_centroid(spark, sf_dir):
    emb = embeddings(spark, sf_dir)
    out = nearest_centroid(emb, "features", _emb_centres(spark, sf_dir), "label", "centre",
                           out="nearest", dist_out="dist", id_col="vec_id")
    return out.select("vec_id", "label", "nearest", F.round("dist", 6).alias("dist"))


@register("decision_grid", stage="stats", sql=f"""
WITH e AS ({EMB_SQL}),
ext AS (SELECT MIN(x0) - 1 AS xs, MAX(x0) + 1 AS xe, MIN(x1) - 1 AS ys, MAX(x1) + 1 AS ye FROM e),
c AS (SELECT label, AVG(x0) AS c0, AVG(x1) AS c1 FROM e GROUP BY 1),
gx AS (SELECT xs + CAST(unnest(range(0, CAST(ceil((xe - xs) / 0.05::DOUBLE) AS BIGINT))) AS DOUBLE) * 0.05::DOUBLE
              AS gx FROM ext),
gy AS (SELECT ys + CAST(unnest(range(0, CAST(ceil((ye - ys) / 0.05::DOUBLE) AS BIGINT))) AS DOUBLE) * 0.05::DOUBLE
              AS gy FROM ext),
d AS (SELECT gx, gy, label, (gx - c0) * (gx - c0) + (gy - c1) * (gy - c1) AS d2 FROM gx, gy, c),
r AS (SELECT *, row_number() OVER (PARTITION BY gx, gy ORDER BY d2, label) AS rn FROM d)
SELECT ROUND(gx, 6) AS gx, ROUND(gy, 6) AS gy, label AS nearest FROM r WHERE rn = 1
""")
def q_decision_grid(spark, sf_dir):
    e = emb_columns(spark, sf_dir)
    g = decision_grid(e, "x0", "x1", centroids(e, "label", ["x0", "x1"]), "label", step=0.05, pad=1.0)
    return g.select(F.round("gx", 6).alias("gx"), F.round("gy", 6).alias("gy"), "nearest")


def emb_silhouette(spark, sf_dir):
    e = emb_columns(spark, sf_dir).select("vec_id", "label", as_array(EMB_FEATURES).alias("f"))
    return silhouette_samples(e, "vec_id", "label", "f")


_SIL_SQL = f"""
WITH e AS ({EMB_SQL}),
d AS (SELECT p.vec_id, p.label, q.label AS ol, SUM({euclid("p", "q", EMB_FEATURES)}) AS s, COUNT(*) AS c
      FROM e p, e q GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, label, MAX(CASE WHEN ol = label THEN c END) AS n_own,
              MAX(CASE WHEN ol = label THEN s / NULLIF(c - 1, 0) END) AS a,
              MIN(CASE WHEN ol <> label THEN s / c END) AS b FROM d GROUP BY 1, 2),
sil AS (SELECT vec_id, label, a, b,
               CASE WHEN n_own <= 1 THEN 0 ELSE COALESCE((b - a) / NULLIF(GREATEST(a, b), 0), 0) END AS silhouette
        FROM ab)
"""


@register("silhouette_samples", stage="stats", sql=_SIL_SQL + """
SELECT vec_id, label, ROUND(a, 6) AS a, ROUND(b, 6) AS b, ROUND(silhouette, 6) AS silhouette FROM sil
""")
def q_silhouette_samples(spark, sf_dir):
    return _round_all(emb_silhouette(spark, sf_dir).select("vec_id", "label", "a", "b", "silhouette"),
                      ["a", "b", "silhouette"])


@register("silhouette_rank", stage="stats", sql=_SIL_SQL + """,
rk AS (SELECT vec_id, label, silhouette,
              row_number() OVER (PARTITION BY label ORDER BY silhouette, vec_id) AS rank_in_label FROM sil),
sz AS (SELECT label, COUNT(*) AS n FROM sil GROUP BY 1),
off AS (SELECT label, COALESCE(SUM(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS start FROM sz)
SELECT vec_id, rk.label, ROUND(silhouette, 6) AS silhouette, rank_in_label,
       CAST(start + rank_in_label AS BIGINT) AS position
FROM rk JOIN off ON rk.label = off.label
""")
def q_silhouette_rank(spark, sf_dir):
    sil = emb_silhouette(spark, sf_dir).select("vec_id", "label", "silhouette")
    ranked = group_rank(sil, ["label"], ["silhouette", "vec_id"], rank_col="rank_in_label", size_col="n")
    # Stacked position of the silhouette plot: sizes of the labels before this one, then the rank.
    sizes = ranked.groupBy("label").agg(F.first("n").alias("n"))
    start = sizes.withColumn("start", F.coalesce(F.sum("n").over(
        Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("label", "start")
    out = ranked.join(start, "label", "inner")
    return out.select("vec_id", "label", F.round("silhouette", 6).alias("silhouette"), "rank_in_label",
                      (F.col("start") + F.col("rank_in_label")).cast("long").alias("position"))


@register("silhouette_by_cluster", stage="stats", sql=_SIL_SQL + """
SELECT CAST(label AS VARCHAR) AS label, ROUND(AVG(silhouette), 6) AS mean_silhouette, COUNT(*) AS n
FROM sil GROUP BY 1
UNION ALL
SELECT 'all', ROUND(AVG(silhouette), 6), COUNT(*) FROM sil
""")
def q_silhouette_by_cluster(spark, sf_dir):
    sil = emb_silhouette(spark, sf_dir)
    # One silhouette job: the overall mean is derived from the per-label sums.
    by = sil.groupBy(F.col("label").cast("string").alias("label")).agg(
        F.sum("silhouette").alias("_s"), F.count(F.lit(1)).alias("n"))
    by = materialize(by)
    overall = by.agg(F.lit("all").alias("label"), F.sum("_s").alias("_s"), F.sum("n").alias("n"))
    out = by.unionByName(overall).select("label", (F.col("_s") / F.col("n")).alias("mean_silhouette"), "n")
    return _round_all(out, ["mean_silhouette"])


@register("silhouette_by_variable", stage="stats", sql=f"""
WITH l AS ({EMB_LONG_SQL}),
d AS (SELECT p.variable, p.vec_id, p.label, q.label AS ol, SUM(abs(p.value - q.value)) AS s, COUNT(*) AS c
      FROM l p JOIN l q ON p.variable = q.variable GROUP BY 1, 2, 3, 4),
ab AS (SELECT variable, vec_id, label, MAX(CASE WHEN ol = label THEN c END) AS n_own,
              MAX(CASE WHEN ol = label THEN s / NULLIF(c - 1, 0) END) AS a,
              MIN(CASE WHEN ol <> label THEN s / c END) AS b FROM d GROUP BY 1, 2, 3)
SELECT variable,
       ROUND(AVG(CASE WHEN n_own <= 1 THEN 0 ELSE COALESCE((b - a) / NULLIF(GREATEST(a, b), 0), 0) END), 6)
         AS mean_silhouette
FROM ab GROUP BY 1
""")
def q_silhouette_by_variable(spark, sf_dir):
    long = to_long(emb_columns(spark, sf_dir), ["vec_id", "label"], EMB_FEATURES)
    # One-dimensional: exact by sorted prefix sums, no pair distances.
    sil = silhouette_1d(long, "vec_id", "label", "value", group_cols=["variable"])
    return _round_all(sil.groupBy("variable").agg(F.avg("silhouette").alias("mean_silhouette")),
                      ["mean_silhouette"])


@register("silhouette_sq", stage="stats", sql=f"""
WITH e AS ({EMB_SQL}),
d AS (SELECT p.vec_id, p.label, q.label AS ol, SUM({sqeuclid("p", "q", EMB_FEATURES)}) AS s, COUNT(*) AS c
      FROM e p, e q GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, label, MAX(CASE WHEN ol = label THEN c END) AS n_own,
              MAX(CASE WHEN ol = label THEN s / NULLIF(c - 1, 0) END) AS a,
              MIN(CASE WHEN ol <> label THEN s / c END) AS b FROM d GROUP BY 1, 2)
SELECT ROUND(AVG(CASE WHEN n_own <= 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6)
         AS silhouette_sq, COUNT(*) AS n
FROM ab
""")
def q_silhouette_sq(spark, sf_dir):
    e = emb_columns(spark, sf_dir).select("vec_id", "label", as_array(EMB_FEATURES).alias("f"))
    sil = silhouette_squared_samples(e, "label", "f")
    return sil.agg(F.round(F.avg("silhouette_sq"), 6).alias("silhouette_sq"), F.count(F.lit(1)).alias("n"))
