"""Isolation forest (Liu, Ting and Zhou 2008) as Spark jobs.

Plan, for T trees of sample size psi = min(max_samples, n):
1. Sample: a row is a candidate of each tree with a chance ``p`` (about 4 psi
   candidates per tree). One hash of the row says how many trees it skips
   before the first that takes it (a geometric draw), so nearly all rows of a
   large table cost one hash and go; the few left draw for the later trees.
   Each tree's sample is exactly its psi candidates of smallest second hash (a
   uniform sample without replacement). The candidates per tree are counted
   and ``p`` is raised if a tree falls short, so the sample is always exact.
2. Grow: ``groupBy(variant, tree).applyInPandas`` builds each tree from its
   psi rows (bounded groups; seeded per tree, never per partition).
3. Score: the forest (T x at most 2^(depth+1) nodes per variant, independent
   of n) is broadcast; ``mapInPandas`` walks all trees for a whole Arrow
   batch at once with numpy.
4. Threshold: the offset is the exact ``contamination`` percentile of the
   training scores (refined histograms; no row is exchanged).

Variants score several feature subsets (e.g. leave-one-variable-out) with
one sampling pass, one grow job and one scoring pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiopanel.operators.quantiles import percentiles
from regiopanel.session import materialize

EULER_GAMMA = 0.5772156649015329


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _uniform(id_col: str, seed: int, tree: Column) -> Column:
    h = F.xxhash64(F.col(id_col), F.lit(seed), tree)
    return (F.abs(h % F.lit(1 << 53))).cast("double") / F.lit(float(1 << 53))


def _grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """One isolation tree in BFS arrays: feature (-1 = leaf), threshold, left, right, size."""
    feat, thr, left, right, size = [-1], [0.0], [-1], [-1], [len(x)]
    queue = [(0, np.arange(len(x)), 0)]
    head = 0
    while head < len(queue):
        node, idx, depth = queue[head]
        head += 1
        if len(idx) < 2 or depth >= max_depth:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        candidates = np.flatnonzero(hi > lo)
        if len(candidates) == 0:
            continue
        f = int(candidates[rng.integers(len(candidates))])
        t = float(rng.uniform(lo[f], hi[f]))
        if not t < hi[f]:
            t = float(lo[f])
        go_left = sub[:, f] <= t
        li, ri = idx[go_left], idx[~go_left]
        feat[node], thr[node] = f, t
        for child_idx in (li, ri):
            cid = len(feat)
            feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), size.append(len(child_idx))
            queue.append((cid, child_idx, depth + 1))
            if child_idx is li:
                left[node] = cid
            else:
                right[node] = cid
    return feat, thr, left, right, size


def _grower(features_by_variant: dict[int, list[int]], max_depth: int, seed: int):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        variant, tree = int(pdf["_variant"].iloc[0]), int(pdf["_tree"].iloc[0])
        pdf = pdf.sort_values("_u")
        x_all = np.stack(pdf["_x"].to_numpy()).astype(np.float64)
        x = x_all[:, features_by_variant[variant]]
        rng = np.random.default_rng([seed, tree])
        feat, thr, left, right, size = _grow_tree(x, rng, max_depth)
        n = len(feat)
        return pd.DataFrame({"variant": np.full(n, variant, dtype=np.int32),
                             "tree": np.full(n, tree, dtype=np.int32),
                             "node": np.arange(n, dtype=np.int32),
                             "feature": np.asarray(feat, dtype=np.int32),
                             "threshold": np.asarray(thr, dtype=np.float64),
                             "left": np.asarray(left, dtype=np.int32),
                             "right": np.asarray(right, dtype=np.int32),
                             "size": np.asarray(size, dtype=np.int64)})
    return fn


FOREST_SCHEMA = ("variant int, tree int, node int, feature int, threshold double, left int, right int, "
                 "size bigint")


def candidate_trees(id_col: str, seed: int, n_trees: int, p: float) -> Column:
    """Trees that take the row as a candidate, each with chance ``p`` independently of the others."""
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    if p >= 1.0:
        return trees
    # Skips before the first success; u = 0 has no logarithm and stands for more skips than there are trees.
    skips = F.floor(F.log(_uniform(id_col, seed, F.lit(-1))) / F.lit(math.log1p(-p)))
    later = F.filter(trees, lambda t: (t > skips) & (_uniform(id_col, seed, t) < F.lit(p)))
    return F.when(skips < n_trees, F.concat(F.array(skips.cast("int")), later)).otherwise(F.array().cast("array<int>"))


def sample_rows(data: DataFrame, id_col: str, n: int, n_trees: int, psi: int, seed: int) -> DataFrame:
    """Exactly ``psi`` of the ``n`` rows for each tree: the rows with ``_tree``, whatever the layout of ``data``."""
    p = 1.0 if n == 0 else min(1.0, 4.0 * psi / n)
    while True:
        # Written once (about 4 psi rows a tree): the count and the sample read this copy.
        cand = (data.select("*", F.explode(candidate_trees(id_col, seed, n_trees, p)).alias("_tree"))
                .withColumn("_u", _uniform(id_col, seed + 1, F.col("_tree"))))
        cand = materialize(cand)
        # T rows: candidates per tree. Exactness needs psi candidates in every tree.
        counts = {r["_tree"]: r["count"] for r in cand.groupBy("_tree").count().collect()}
        short = psi > 0 and (len(counts) < n_trees or min(counts.values()) < psi)
        if p >= 1.0 or not short:
            break
        p = min(1.0, p * 2.0)
    # Each tree keeps its psi smallest u; candidate groups are bounded (~4 psi rows).
    w = Window.partitionBy("_tree").orderBy("_u", id_col)
    return cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi).drop("_r")


def fit_forest(df: DataFrame, id_col: str, features: Sequence[str], variants: Sequence[Sequence[int]] | None = None,
               n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> dict:
    """Grow the forest(s). ``variants`` lists feature-index subsets (default: all features)."""
    variants = [list(v) for v in (variants or [list(range(len(features)))])]
    x = F.array(*[F.col(c).cast("double") for c in features])
    data = df.select(F.col(id_col), x.alias("_x"))
    n = data.count()
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    sample = sample_rows(data, id_col, n, n_trees, psi, seed)
    # Every variant grows from the same sample (like a refit with the same seed).
    grouped = sample.withColumn("_variant", F.explode(F.sequence(F.lit(0), F.lit(len(variants) - 1))))
    # Growing trees is CPU work on few bytes: spread the groups over the cluster's
    # cores instead of letting AQE coalesce them by size (groupBy reuses this partitioning).
    slots = df.sparkSession.sparkContext.defaultParallelism
    grouped = grouped.repartition(max(1, min(len(variants) * n_trees, 2 * slots)), "_variant", "_tree")
    by_variant = {i: v for i, v in enumerate(variants)}
    nodes = grouped.groupBy("_variant", "_tree").applyInPandas(_grower(by_variant, max_depth, seed),
                                                                FOREST_SCHEMA)
    # The forest is bounded by variants x T x 2^(max_depth+1) nodes, whatever n is.
    pdf = nodes.toPandas().sort_values(["variant", "tree", "node"])
    packed: dict[int, list[dict]] = {i: [] for i in range(len(variants))}
    for (v, _), t in pdf.groupby(["variant", "tree"], sort=True):
        packed[int(v)].append({f: t[f].to_numpy() for f in ("feature", "threshold", "left", "right", "size")})
    return {"variants": variants, "forest": packed, "psi": psi, "max_depth": max_depth,
            "features": list(features), "n_trees": n_trees}


def _path_lengths(x: np.ndarray, trees: list[dict], max_depth: int) -> np.ndarray:
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for t in trees:
        feat, thr, left, right, size = t["feature"], t["threshold"], t["left"], t["right"], t["size"]
        node = np.zeros(len(x), dtype=np.int64)
        depth = np.zeros(len(x))
        for _ in range(max_depth + 1):
            f = feat[node]
            inner = f >= 0
            if not inner.any():
                break
            go_left = x[rows, np.where(inner, f, 0)] <= thr[node]
            nxt = np.where(go_left, left[node], right[node])
            node = np.where(inner, nxt, node)
            depth = depth + inner
        total += depth + average_path_length(size[node])
    return total


def score_forest(df: DataFrame, id_col: str, model: dict, keep: Sequence[str] = ()) -> DataFrame:
    """Anomaly scores ``2^(-E[h]/c(psi))``: one row per id with ``scores``, an array over the variants."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(model)
    feats = model["features"]
    x = F.array(*[F.col(c).cast("double") for c in feats])
    data = df.select(id_col, *keep, x.alias("_x"))
    kinds = dict(data.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in (id_col, *keep)], "scores array<double>"])

    def run(batches):
        m = bc.value
        c_psi = float(average_path_length(np.array([m["psi"]]))[0]) or 1.0
        for pdf in batches:
            if pdf.empty:
                continue
            xa = np.stack(pdf["_x"].to_numpy()).astype(np.float64)
            per = [np.power(2.0, -_path_lengths(xa[:, cols], m["forest"][v], m["max_depth"])
                            / max(len(m["forest"][v]), 1) / c_psi) for v, cols in enumerate(m["variants"])]
            out = pdf.drop(columns="_x")
            out["scores"] = list(np.stack(per, axis=1))
            yield out
    return data.mapInPandas(run, schema)


def score_offsets(scored: DataFrame, n_variants: int, contamination: float = 0.05) -> list[float]:
    """Exact contamination percentile of ``-score`` for each variant (one number each)."""
    long = scored.select(F.posexplode("scores").alias("variant", "s")).select("variant", (-F.col("s")).alias("neg"))
    found = percentiles(long, ["variant"], "neg", [contamination], names=["offset"]).collect()
    by = {r["variant"]: float(r["offset"]) for r in found}
    return [by.get(v, 0.0) for v in range(n_variants)]


def decision_expr(variant: int, offset: float):
    """``-score - offset``; negative values are the flagged rows."""
    return -F.col("scores")[variant] - F.lit(offset)


def isolation_forest(df: DataFrame, id_col: str, features: Sequence[str], contamination: float = 0.05,
                     n_trees: int = 100, max_samples: int = 256, seed: int = 42, keep: Sequence[str] = ()) -> DataFrame:
    """Fit and score: (id, keep..., score, decision, is_anomalous).

    Rows are scored once into a reliable checkpoint; the threshold is a number
    applied as a literal, so no row is joined or shuffled for its decision.
    """
    model = fit_forest(df, id_col, features, n_trees=n_trees, max_samples=max_samples, seed=seed)
    scored = materialize(score_forest(df, id_col, model, keep))
    (offset,) = score_offsets(scored, 1, contamination)
    out = scored.select(id_col, *keep, F.col("scores")[0].alias("score"), decision_expr(0, offset).alias("decision"))
    return out.withColumn("is_anomalous", (F.col("decision") < 0).cast("int"))


def leave_one_out_importance(df: DataFrame, id_col: str, features: Sequence[str], contamination: float = 0.05,
                             n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """Mean |decision(all) - decision(all but v)| per variable v, from one forest job and one wide scoring pass."""
    d = len(features)
    variants = [list(range(d))] + [[j for j in range(d) if j != i] for i in range(d)]
    model = fit_forest(df, id_col, features, variants=variants, n_trees=n_trees, max_samples=max_samples,
                       seed=seed)
    scored = materialize(score_forest(df, id_col, model))
    offsets = score_offsets(scored, d + 1, contamination)
    base = decision_expr(0, offsets[0])
    imp = scored.agg(*[F.avg(F.abs(base - decision_expr(i + 1, offsets[i + 1]))).alias(f"i{i}") for i in range(d)])
    parts = ", ".join(f"'{c}', i{i}" for i, c in enumerate(features))
    return imp.select(F.expr(f"stack({d}, {parts}) AS (feature, importance)"))
