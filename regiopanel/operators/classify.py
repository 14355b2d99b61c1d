"""Classification: stratified split and folds, reports, multinomial logistic
regression with coefficients and odds ratios, cross-validated accuracy.

Split and folds are exact (rank within class, never approximate ``sampleBy``)
and use the skew-safe ranks, so one dominant class is not ranked in one task.
The report is computed from the confusion counts (classes^2 rows).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.operators.ranking import group_rank
from regiopanel.session import materialize


def stratified_split(df: DataFrame, id_col: str, label_col: str, test_fraction: float = 0.2,
                     seed: int | None = 42, out: str = "is_test") -> DataFrame:
    """Exactly ``round(test_fraction * n_class)`` rows of each class flagged as test.

    Rows are ordered within the class by a seeded hash of the id (``seed=None``
    orders by id), so the split is reproducible and independent of partitioning.
    """
    ranked = group_rank(df.withColumn("_o", F.xxhash64(F.col(id_col), F.lit(seed or 0))),
                        [label_col], (["_o", id_col] if seed is not None else [id_col]),
                        rank_col="_rk", size_col="_n")
    flag = (F.col("_rk") <= F.round(F.col("_n") * F.lit(float(test_fraction)))).cast("int")
    return ranked.withColumn(out, flag).drop("_rk", "_n", "_o")


def stratified_folds(df: DataFrame, id_col: str, label_col: str, k: int = 5, seed: int | None = 42,
                     out: str = "fold") -> DataFrame:
    """Fold = (rank within class - 1) mod k: every fold keeps each class share within one row."""
    ranked = group_rank(df.withColumn("_o", F.xxhash64(F.col(id_col), F.lit(seed or 0))),
                        [label_col], (["_o", id_col] if seed is not None else [id_col]), rank_col="_rk")
    return ranked.withColumn(out, ((F.col("_rk") - 1) % F.lit(k)).cast("int")).drop("_rk", "_o")


def confusion(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    return df.groupBy(F.col(label_col).cast("string").alias("label"),
                      F.col(pred_col).cast("string").alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """Per-class precision, recall, F1 and support; macro and weighted averages; accuracy.

    Undefined ratios are 0 (sklearn's ``zero_division`` default result).
    The accuracy row carries the accuracy in ``f1`` and the total in ``support``.
    """
    # Written once (classes^2 rows): every branch below reads this copy.
    cm = materialize(confusion(df, label_col, pred_col).coalesce(1))
    classes = cm.select(F.col("label").alias("cls")).union(cm.select(F.col("pred").alias("cls"))).distinct()
    tp = cm.filter(F.col("label") == F.col("pred")).select(F.col("label").alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("support"))
    npred = cm.groupBy(F.col("pred").alias("cls")).agg(F.sum("n").alias("npred"))
    per = (classes.join(tp, "cls", "left").join(sup, "cls", "left").join(npred, "cls", "left")
           .fillna(0, ["tp", "support", "npred"]))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("npred").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.select(F.col("cls").alias("class"), p.alias("precision"), r.alias("recall"), "support", "tp")
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    total = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("k"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").alias("support"))
    wsum = F.sum("support")
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / wsum).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / wsum).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / wsum).alias("f1"), wsum.alias("support"))
    acc = total.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                       F.lit(None).cast("double").alias("recall"),
                       (F.col("tp") / F.col("n")).alias("f1"), F.col("n").alias("support"))
    cols = ["class", "precision", "recall", "f1", "support"]
    return per.select(*cols).unionByName(macro.select(*cols)).unionByName(weighted.select(*cols)) \
        .unionByName(acc.select(*cols))


def weighted_scores(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """Support-weighted precision, recall and F1 (one row)."""
    rep = classification_report(df, label_col, pred_col)
    return rep.filter(F.col("class") == "weighted avg").select("precision", "recall", "f1")


# ---------------------------------------------------------------------------
# Multinomial logistic regression


def _vector(df: DataFrame, features: str | Sequence[str], out: str = "_fv") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    arr = F.col(features).cast("array<double>") if isinstance(features, str) else \
        F.array(*[F.col(c).cast("double") for c in features])
    return df.withColumn(out, array_to_vector(arr))


def array_moments(df: DataFrame, col: str) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population std of every element of an array column, from one ``Summarizer`` pass."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    s = df.select(array_to_vector(F.col(col).cast("array<double>")).alias("v")) \
        .agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")).first()["s"]
    n = float(s["count"])
    var_pop = np.asarray(s["variance"]) * ((n - 1.0) / n if n > 1 else 0.0)
    return np.asarray(s["mean"]), np.sqrt(np.clip(var_pop, 0.0, None))


def zscore_array(df: DataFrame, col: str, moments: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Population z-score of every element of an array<double> column (zero variance -> 0).

    ``moments`` default to those of ``df``; pass those of a training part to
    scale a held-out one by it. They are applied with ``zip_with``.
    """
    mean, std = moments or array_moments(df, col)
    m_arr = F.array(*[F.lit(float(v)) for v in mean])
    inv = F.array(*[F.lit(float(1.0 / v) if v > 0 else 0.0) for v in std])
    centred = F.zip_with(F.col(col).cast("array<double>"), m_arr, lambda a, b: a - b)
    return df.withColumn(col, F.zip_with(centred, inv, lambda a, b: a * b))


def fit_logit(df: DataFrame, features: str | Sequence[str], label_col: str, max_iter: int = 1000,
              c: float = 1.0, n_rows: int | None = None, tol: float = 1e-6):
    """Multinomial logistic regression equal in objective to L2 with inverse strength ``c``.

    sklearn minimises ``0.5 |W|^2 + c * sum(loss)``; Spark minimises
    ``mean(loss) + reg * 0.5 |W|^2``; they agree for ``reg = 1 / (c * n)``.
    Classes are indexed alphabetically, like sorted ``classes_``.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer
    data = _vector(df.withColumn("_y", F.col(label_col).cast("string")), features)
    n = n_rows if n_rows is not None else data.count()
    idx = StringIndexer(inputCol="_y", outputCol="_yi", stringOrderType="alphabetAsc").fit(data)
    train = idx.transform(data).select("_fv", "_yi").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lr = LogisticRegression(featuresCol="_fv", labelCol="_yi", family="multinomial", maxIter=max_iter,
                                regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0, standardization=False,
                                tol=tol)
        model = lr.fit(train)
    finally:
        train.unpersist()
    return model, list(idx.labels)


def predict_logit(df: DataFrame, model, classes: Sequence[str], features: str | Sequence[str],
                  out: str = "prediction") -> DataFrame:
    data = _vector(df, features)
    scored = model.setFeaturesCol("_fv").setPredictionCol("_pi").setProbabilityCol("_prob") \
        .setRawPredictionCol("_raw").transform(data)
    name = F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("_pi").cast("int") + 1)
    return scored.withColumn(out, name).drop("_fv", "_pi", "_prob", "_raw")


def coefficient_table(spark, model, classes: Sequence[str], feature_names: Sequence[str],
                      intercept: str | None = None) -> DataFrame:
    """Long (class, feature, coefficient) table from the fitted class x feature matrix; ``intercept`` names rows for it."""
    mat = model.coefficientMatrix.toArray()
    names = list(feature_names)
    if intercept:
        mat, names = np.column_stack([mat, model.interceptVector.toArray()]), [*names, intercept]
    rows = [(classes[i], names[j], float(mat[i, j])) for i in range(mat.shape[0])
            for j in range(mat.shape[1])]
    return spark.createDataFrame(rows, "class string, feature string, coefficient double")


def loss_gradient(df: DataFrame, model, classes: Sequence[str], features: str | Sequence[str], label_col: str,
                  feature_names: Sequence[str], c: float = 1.0, intercept: str = "intercept") -> DataFrame:
    """Gradient of ``0.5 |W|^2 + c * sum(loss)``, divided by ``c * n``, at the fitted weights: (class, feature, gradient).

    All zero at the optimum, whatever solver found the weights: the objective
    is convex. One pass sums a class x feature block a row with partial
    aggregates; intercepts carry no penalty. Rows whose label the model does
    not know are left out. No rows: an empty table.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    known = df.filter(F.col(label_col).cast("string").isin(list(classes)))
    scored = model.setFeaturesCol("_fv").setProbabilityCol("_prob").transform(_vector(known, features))
    x = F.concat(vector_to_array("_fv"), F.array(F.lit(1.0)))
    off = F.transform(F.arrays_zip(vector_to_array("_prob").alias("p"), F.array(*[F.lit(v) for v in classes]).alias("v")),
                      lambda z: z["p"] - (z["v"] == F.col(label_col).cast("string")).cast("double"))
    row = scored.select(x.alias("_x"), off.alias("_off"))
    block = F.flatten(F.transform("_off", lambda r: F.transform("_x", lambda v: r * v)))
    # Grouped by a constant, so that no rows give no row.
    found = row.select(array_to_vector(block).alias("b")).groupBy(F.lit(True)).agg(
        Summarizer.metrics("mean", "count").summary(F.col("b")).alias("s")).first()
    spark, kind = df.sparkSession, "class string, feature string, gradient double"
    if found is None:
        return spark.createDataFrame([], kind)
    s, n = found["s"], int(found["s"]["count"])
    mat = np.column_stack([model.coefficientMatrix.toArray(), np.zeros(len(classes))])
    grad = np.asarray(s["mean"].toArray()).reshape(mat.shape) + mat / (c * n)
    names = [*feature_names, intercept]
    return spark.createDataFrame([(classes[i], names[j], float(grad[i, j])) for i in range(mat.shape[0])
                                  for j in range(mat.shape[1])], kind)


def holdout_predictions(df: DataFrame, id_col: str, features: str, label_col: str, test_fraction: float = 0.2,
                        seed: int | None = 42, max_iter: int = 1000, fit_scope: str = "all") -> DataFrame:
    """Fit on the training part of a stratified split and predict the rest: (id, label, prediction) of the test rows.

    ``fit_scope='fold'`` scales both parts by the training part's moments.
    """
    split = materialize(stratified_split(df, id_col, label_col, test_fraction, seed))
    train, test = split.filter("is_test = 0"), split.filter("is_test = 1")
    if fit_scope == "fold":
        moments = array_moments(train, features)
        train, test = zscore_array(train, features, moments), zscore_array(test, features, moments)
    model, classes = fit_logit(train, features, label_col, max_iter=max_iter)
    held = predict_logit(test, model, classes, features)
    return held.select(id_col, F.col(label_col).cast("string").alias(label_col), "prediction")


def cross_validate(df: DataFrame, id_col: str, features: str | Sequence[str], label_col: str, k: int = 5,
                   seed: int | None = 42, max_iter: int = 1000, parallelism: int | None = None,
                   fit_scope: str = "all"):
    """Stratified k-fold: fit on k-1 folds, predict the held-out fold.

    ``fit_scope='all'`` takes an array column of features as it is (scaled on
    all rows, as the study does); ``'fold'`` scales it by the moments of each
    fold's training rows only.

    Returns (per-fold accuracy list, out-of-fold predictions DataFrame).
    """
    if fit_scope not in ("all", "fold"):
        raise ValueError("fit_scope is 'all' or 'fold'")
    folded = stratified_folds(df, id_col, label_col, k, seed).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    total = sum(sizes.values())

    def one(f: int):
        train, held = folded.filter(F.col("fold") != f), folded.filter(F.col("fold") == f)
        if fit_scope == "fold":
            moments = array_moments(train, features)
            train, held = zscore_array(train, features, moments), zscore_array(held, features, moments)
        model, classes = fit_logit(train, features, label_col, max_iter=max_iter, n_rows=total - sizes.get(f, 0))
        held = predict_logit(held, model, classes, features)
        return held.select(id_col, F.col(label_col).cast("string").alias(label_col), "prediction",
                           F.lit(f).alias("fold"))
    try:
        with ThreadPoolExecutor(parallelism or max(1, min(k, df.sparkSession.sparkContext.defaultParallelism))) as pool:
            parts = list(pool.map(one, range(k)))
        oof = parts[0]
        for p in parts[1:]:
            oof = oof.unionByName(p)
        # Written once (reliable checkpoint): the accuracies and any report read this copy,
        # and nothing stays cached after the caller is done.
        oof = materialize(oof)
        acc = {r["fold"]: float(r["acc"]) for r in oof.groupBy("fold").agg(
            F.avg((F.col(label_col) == F.col("prediction")).cast("double")).alias("acc")).collect()}
        return [acc[f] for f in range(k)], oof
    finally:
        folded.unpersist()
