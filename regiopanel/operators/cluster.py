"""Fitted clustering and projection: k-means, PCA, elbow and sensitivity studies.

k-means is fixed by the data: the first centre is the row of the smallest id,
each further one the row farthest from those before it, then Lloyd rounds up to
a stated number. All models of a sweep share the passes: a round is one narrow
numpy pass over the rows that emits sums per model and cluster, and one small
aggregate. So a fit is the same on any cluster and a database can recompute it.

PCA comes from the distributed covariance. Only the fitted objects reach the
driver: k centres, a d x d covariance, d x k loadings. Scores and labels are
applied back as literal expressions in a narrow projection, so there is no join
and no broadcast of data-sized state.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.operators.geometry import silhouette_samples, silhouette_squared_samples


#: Lloyd rounds at most.
ROUNDS = 50
#: From so many rows on, the rows of a fit are dealt evenly to all cores, in parts of at most the second number.
DEALT_ROWS, PART_ROWS = 16_384, 1 << 20


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.array(*[F.col(c).cast("double") for c in features])))


def canonical_order(centres: np.ndarray) -> list[int]:
    """Old cluster ids in lexicographic order of their centres (run-independent names)."""
    return sorted(range(len(centres)), key=lambda i: tuple(np.round(centres[i], 12)))


def kmeans_labels(df: DataFrame, features: Sequence[str], k: int, seed: int = 42,
                  out: str = "cluster", max_iter: int = ROUNDS,
                  order_col: str | None = None) -> tuple[DataFrame, np.ndarray, float]:
    """Cluster labels in canonical order (cluster 0 has the lexicographically smallest centre), centres and cost.

    The fit of :func:`kmeans_sweep` for one model. Without ``order_col`` rows
    are ordered by their values. ``seed`` is accepted for older callers: nothing is drawn.
    """
    fit = kmeans_sweep(df, order_col, [SweepModel("one", features, k)], max_iter=max_iter)["one"]
    return assign_clusters(df, F.array(*[F.col(c).cast("double") for c in features]), fit["centres"], out), fit["centres"], fit["cost"]


def elbow_sweep(df: DataFrame, id_col: str, features: Sequence[str], ks: Sequence[int] = tuple(range(1, 11)),
                seed: int = 42) -> list[tuple[int, float]]:
    """Inertia for each k; all fits share the passes over the same persisted rows."""
    res = kmeans_sweep(df, id_col, [SweepModel(k, features, k) for k in ks], seed)
    return sorted((k, res[k]["cost"]) for k in ks)


# ---------------------------------------------------------------------------
# PCA


def covariance(df: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean vector, sample covariance (d x d) and n, from Spark's distributed Gram matrix."""
    from pyspark.ml.stat import Correlation, Summarizer
    data = assemble(df.select(*features), features).select("features")
    s = data.agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("features")).alias("s")).first()["s"]
    sd = np.sqrt(np.asarray(s["variance"]))
    corr = np.nan_to_num(Correlation.corr(data, "features").first()[0].toArray())
    cov = corr * np.outer(sd, sd)
    np.fill_diagonal(cov, sd ** 2)
    return np.asarray(s["mean"]), cov, int(s["count"])


def pca_from_cov(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Top-k eigenvectors (d x k, sign: largest |loading| positive) and variance ratios of all d."""
    vals, vecs = np.linalg.eigh(cov)
    idx = np.argsort(vals)[::-1]
    vals, vecs = np.clip(vals[idx], 0.0, None), vecs[:, idx]
    for j in range(vecs.shape[1]):
        if vecs[np.argmax(np.abs(vecs[:, j])), j] < 0:
            vecs[:, j] = -vecs[:, j]
    ratio = vals / vals.sum() if vals.sum() > 0 else np.zeros_like(vals)
    return vecs[:, :k], ratio


def fit_pca(df: DataFrame, features: Sequence[str], k: int) -> dict:
    """Spark ML PCA (distributed covariance + SVD), with sign rule and centring added.

    Spark's ``PCAModel.transform`` does not centre; scores here are
    ``(x - mean) . V`` so they have mean zero like the reference's.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.stat import Summarizer
    data = assemble(df.select(*features), features)
    model = PCA(k=k, inputCol="features", outputCol="_pca").fit(data)
    comps = model.pc.toArray().copy()
    for j in range(comps.shape[1]):
        if comps[np.argmax(np.abs(comps[:, j])), j] < 0:
            comps[:, j] = -comps[:, j]
    mean = np.asarray(data.agg(Summarizer.mean(F.col("features")).alias("m")).first()["m"])
    return {"components": comps, "ratio": np.asarray(model.explainedVariance), "mean": mean,
            "features": list(features)}


def pca_exprs(pca: dict) -> list[Column]:
    """Centred score expressions ``(x - mean) . V[:, j]`` with the loadings as literals."""
    comps, mean, feats = pca["components"], pca["mean"], pca["features"]
    cols = []
    for j in range(comps.shape[1]):
        expr = None
        for i, c in enumerate(feats):
            term = (F.col(c) - F.lit(float(mean[i]))) * F.lit(float(comps[i, j]))
            expr = term if expr is None else expr + term
        cols.append(expr)
    return cols


def pca_scores(df: DataFrame, pca: dict, prefix: str = "pc", keep: Sequence[str] = ()) -> DataFrame:
    """Centred scores as a narrow projection with the loadings inlined as literals."""
    return df.select(*keep, *[e.alias(f"{prefix}{j + 1}") for j, e in enumerate(pca_exprs(pca))])


#: Distances that a sweep may score its models by: exact pairs (up to n^2 work), or squares (linear in n).
METRICS = ("euclidean", "sqeuclidean")


def _sweep_silhouettes(data: DataFrame, id_col: str, group: str, specs, fits, metric: str = "euclidean") -> dict:
    """Silhouette of every fitted model in ONE job (models are a group key), by the distance named."""
    parts = []
    for m in specs:
        view = data.select(F.lit(m.key).alias(group), id_col, m.column().alias("f"))
        parts.append(assign_clusters(view, F.col("f"), fits[m.key]["centres"]))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    if metric == "sqeuclidean":
        sil = silhouette_squared_samples(allp, "cluster", "f", group_col=group).withColumnRenamed("silhouette_sq", "silhouette")
    else:
        sil = silhouette_samples(allp, id_col, "cluster", "f", group_cols=[group])
    return {r[group]: float(r["s"]) for r in sil.groupBy(group).agg(F.avg("silhouette").alias("s")).collect()}


def _known(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric is one of {METRICS}")


def pca_sensitivity(df: DataFrame, id_col: str, features: Sequence[str], ns: Sequence[int] = (2, 3, 4, 5),
                    k: int = 6, seed: int = 0, metric: str = "euclidean") -> list[tuple[int, float]]:
    """Silhouette of k-means on the first n components, for each n.

    One covariance pass serves every n, and one silhouette job scores all models:
    by exact distances, or for very many rows by squared ones (``metric``).
    """
    _known(metric)
    data = df.select(id_col, *features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mean, cov, _ = covariance(data, features)
        specs = []
        for n in ns:
            comps, _ = pca_from_cov(cov, n)
            specs.append(SweepModel(int(n), features, k, mean, comps))
        fits = kmeans_sweep(data, id_col, specs, seed)
        sil = _sweep_silhouettes(data, id_col, "n_components", specs, fits, metric)
        return sorted((int(n), sil[n]) for n in sil)
    finally:
        data.unpersist()


def subset_sensitivity(df: DataFrame, id_col: str, features: Sequence[str], size: int = 4,
                       n_components: int = 2, k: int = 4, seed: int = 42,
                       metric: str = "euclidean") -> list[tuple[tuple[str, ...], float]]:
    """PCA + k-means silhouette for every ``size``-subset of the features.

    One covariance pass serves all subsets (a PCA of a subset is the eigen-
    decomposition of its covariance sub-matrix); one silhouette job scores all
    subsets, by the distance that ``metric`` names.
    """
    _known(metric)
    data = df.select(id_col, *features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mean, cov, _ = covariance(data, features)
        subsets = list(itertools.combinations(range(len(features)), size))
        specs = []
        for sid, subset in enumerate(subsets):
            comps, _ = pca_from_cov(cov[np.ix_(subset, subset)], n_components)
            specs.append(SweepModel(sid, [features[i] for i in subset], k, mean[list(subset)], comps))
        fits = kmeans_sweep(data, id_col, specs, seed)
        sil = _sweep_silhouettes(data, id_col, "subset_id", specs, fits, metric)
        res = [(tuple(features[i] for i in subsets[sid]), s) for sid, s in sil.items()]
        return sorted(res, key=lambda t: (-t[1], t[0]))
    finally:
        data.unpersist()


def pair_kmeans(df: DataFrame, id_col: str, pairs: Sequence[tuple[str, str]], k: int = 3,
                seed: int = 42) -> list[tuple[tuple[str, str], np.ndarray]]:
    """k-means on each pair of variables; canonical centres."""
    specs = [SweepModel(i, [a, b], k) for i, (a, b) in enumerate(pairs)]
    fits = kmeans_sweep(df, id_col, specs, seed)
    return [(pair, fits[i]["centres"]) for i, pair in enumerate(pairs)]


# ---------------------------------------------------------------------------
# Excluding flagged rows and labelling back


def attach_labels(full: DataFrame, labelled: DataFrame, key: str, label_col: str,
                  default: str = "Anomalo") -> DataFrame:
    """Left-join labels back onto every row by key; rows without one get ``default``.

    Labels travel by key, never by row position; the label column is a string
    so the default fits in it.
    """
    lab = labelled.select(key, F.col(label_col).cast("string").alias(label_col))
    return full.join(lab, key, "left").withColumn(label_col, F.coalesce(F.col(label_col), F.lit(default)))


def exclude_refit_label(df: DataFrame, id_col: str, features: Sequence[str], flag_col: str,
                        n_components: int = 2, k: int = 4, seed: int = 42, out: str = "cluster_label",
                        default: str = "Anomalo") -> DataFrame:
    """Drop flagged rows, refit PCA + k-means on the rest, label all rows.

    The input is read by several fits and by the final projection, so its
    lineage (e.g. an isolation-forest scoring pass) is cut once with a reliable
    checkpoint.
    """
    from regiopanel.session import materialize
    df = materialize(df)
    kept = df.filter(F.col(flag_col) == 0)
    pca = fit_pca(kept, features, n_components)
    pcs = [f"pc{j + 1}" for j in range(n_components)]
    scores = pca_scores(kept, pca, keep=[id_col])
    _, centres, _ = kmeans_labels(scores, pcs, k, seed, order_col=id_col)
    # Flagged rows get the default, all others their nearest centre: one projection, no join.
    point = F.array(*pca_exprs(pca))
    named = assign_clusters(df, point, centres, out)
    return named.withColumn(out, F.when(F.col(flag_col) == 0, F.col(out).cast("string")).otherwise(F.lit(default)))


# ---------------------------------------------------------------------------
# Many k-means models over one dataset


class SweepModel:
    """One model of a sweep: its points are ``(X[:, cols] - mean) @ proj`` of the base columns.

    ``mean``/``proj`` are None for a plain column subset; a PCA view passes its
    centring vector and loadings.
    """

    def __init__(self, key, cols: Sequence[str], k: int, mean: np.ndarray | None = None,
                 proj: np.ndarray | None = None):
        self.key, self.cols, self.k = key, list(cols), int(k)
        self.mean = None if mean is None else np.asarray(mean, dtype=float)
        self.proj = None if proj is None else np.asarray(proj, dtype=float)

    @property
    def dim(self) -> int:
        return len(self.cols) if self.proj is None else self.proj.shape[1]

    def points(self, frame: np.ndarray, index: dict[str, int]) -> np.ndarray:
        x = frame[:, [index[c] for c in self.cols]]
        if self.proj is not None:
            x = (x - self.mean) @ self.proj
        return x

    def column(self) -> Column:
        """The same points as an array<double> column expression (for labels downstream)."""
        cols = [F.col(c).cast("double") for c in self.cols]
        if self.proj is None:
            return F.array(*cols)
        out = []
        for j in range(self.proj.shape[1]):
            expr = None
            for i, c in enumerate(cols):
                term = (c - F.lit(float(self.mean[i]))) * F.lit(float(self.proj[i, j]))
                expr = term if expr is None else expr + term
            out.append(expr)
        return F.array(*out)


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, summed dimension by dimension as the labelling projection does."""
    d2 = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        d2 += (x[:, j, None] - centres[None, :, j]) ** 2
    return d2


def _batches(models: dict, names: list[str], batches):
    """Per batch: its frame and each model's points; rows with a null or NaN in a model's columns are not its points."""
    index = {c: i for i, c in enumerate(names)}
    for pdf in batches:
        if len(pdf):
            frame = pdf[names].to_numpy(np.float64)
            points = {key: m.points(frame, index) for key, m in models.items()}
            yield pdf, {key: (np.flatnonzero(~np.isnan(x).any(axis=1)), x) for key, x in points.items()}


def _farthest(models: dict, names: list[str], centres: dict):
    """Per partition and model: the row farthest from the centres so far (before the first: of the smallest id)."""
    def run(batches):
        best: dict = {}
        for pdf, points in _batches(models, names, batches):
            for key, (rows, x) in points.items():
                if not len(rows):
                    continue
                gap = _squared(x[rows], centres[key]).min(axis=1) if len(centres[key]) else np.zeros(len(rows))
                ids = pdf["_id"].to_numpy()[rows]
                for i in np.flatnonzero(gap == gap.max()):
                    one = (-gap[i], ids[i], x[rows[i]].tolist())
                    if key not in best or one < best[key]:
                        best[key] = one
        if best:
            keys = list(best)
            yield pd.DataFrame({"model": [str(k) for k in keys], "neg": [best[k][0] for k in keys],
                                "_id": [best[k][1] for k in keys], "x": [best[k][2] for k in keys]})
    return run


def _lloyd(models: dict, names: list[str], centres: dict):
    """Per partition: rows, coordinate sums and squared distances of every model's clusters."""
    def run(batches):
        total = {key: (np.zeros(len(c)), np.zeros(c.shape), np.zeros(len(c))) for key, c in centres.items()}
        for _, points in _batches(models, names, batches):
            for key, (rows, x) in points.items():
                d2 = _squared(x[rows], centres[key])
                label = d2.argmin(axis=1)
                n, sums, cost = total[key]
                n += np.bincount(label, minlength=len(n))
                cost += np.bincount(label, weights=d2[np.arange(len(rows)), label], minlength=len(n))
                for j, v in enumerate(x[rows].T):
                    sums[:, j] += np.bincount(label, weights=v, minlength=len(n))
        out = [(str(key), c, j, n[c], sums[c, j], cost[c]) for key, (n, sums, cost) in total.items()
               for c in np.flatnonzero(n) for j in range(sums.shape[1])]
        yield pd.DataFrame(out, columns=["model", "c", "j", "n", "s", "cost"])
    return run


def kmeans_sweep(df: DataFrame, id_col: str | None, models: Sequence[SweepModel], seed: int = 42,
                 max_iter: int = ROUNDS, tol: float = 0.0) -> dict:
    """Fit several k-means models on views of the same rows, all in the same passes.

    Centres start as the row of the smallest id and then, one by one, the row
    with the greatest distance to its nearest centre (of equally far ones the
    smallest id). ``max_iter`` Lloyd rounds follow, fewer if no centre moves by
    more than rounding, or if the summed squared moves fall to ``tol`` times
    the mean variance. A centre that loses all its rows stays where it is; with
    fewer distinct points than k, centres coincide and the lower number takes the points.

    Returns {key: {"centres": canonical k x d array, "cost": inertia}}.
    """
    base = sorted({c for m in models for c in m.cols})
    by_key = {m.key: m for m in models}
    values = [F.col(c).cast("double").alias(c) for c in base]
    ident = F.col(id_col) if id_col else F.lit(0)
    data = df.select(ident.alias("_id"), *values).persist(StorageLevel.MEMORY_AND_DISK)
    n_rows = data.count()
    if n_rows >= DEALT_ROWS:
        # A round is CPU work on few bytes; partitions formed by size leave most cores idle.
        given, parts = data, max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // PART_ROWS))
        data = given.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
        data.count()
        given.unpersist()
    kind = data.schema["_id"].dataType.simpleString()
    centres = {m.key: np.zeros((0, m.dim)) for m in models}
    try:
        for step in range(max(m.k for m in models)):
            open_ = {key: m for key, m in by_key.items() if m.k > step}
            far = data.mapInPandas(_farthest(open_, base, centres), f"model string, neg double, _id {kind}, x array<double>")
            picked = far.groupBy("model").agg(F.min(F.struct("neg", "_id", "x")).alias("b")).select("model", "b.x").collect()
            found = {r["model"]: r["x"] for r in picked}
            for key in open_:
                if str(key) in found:
                    centres[key] = np.vstack([centres[key], found[str(key)]])
        if any(len(centres[m.key]) < m.k for m in models):
            raise ValueError("no complete row to fit k-means on")
        moving, cost = dict(by_key), {}
        for step in range(max_iter + 1):
            # One more round than moves are made: it gives the cost at the last centres.
            own = {key: centres[key] for key in moving}
            sums = data.mapInPandas(_lloyd(moving, base, own), "model string, c int, j int, n double, s double, cost double")
            rows = sums.groupBy("model", "c", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("cost").alias("cost")).collect()
            new = {str(key): c.copy() for key, c in own.items()}
            total = dict.fromkeys(new, 0.0)
            for r in rows:
                new[r["model"]][r["c"], r["j"]] = r["s"] / r["n"]
                if r["j"] == 0:
                    total[r["model"]] += r["cost"]
            still = {}
            for key, m in moving.items():
                before, after = own[key], new[str(key)]
                cost[key] = total[str(key)]
                scale = max(float(np.square(before).mean()), 1e-300)
                shift = float(np.square(after - before).sum())
                if step < max_iter and shift > max(tol, 1e-24) * scale:
                    centres[key], still[key] = after, m
            moving = still
            if not moving:
                break
        return {m.key: {"centres": centres[m.key][canonical_order(centres[m.key])], "cost": float(cost[m.key])} for m in models}
    finally:
        data.unpersist()


def assign_clusters(df: DataFrame, point: Column, centres: np.ndarray, out: str = "cluster") -> DataFrame:
    """Nearest-centre label (ties to the lower id) as a narrow projection."""
    from regiopanel.operators.geometry import nearest_of_literals
    return df.withColumn(out, nearest_of_literals(point, list(enumerate(centres.tolist())))["cid"])
