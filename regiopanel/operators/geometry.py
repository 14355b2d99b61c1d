"""Cluster geometry for a given labelling: centroids, inertia, nearest centroid,
decision grids and silhouettes.

Scale notes
* Centroids, inertia and the squared-Euclidean silhouette are single-pass
  aggregates (Welford-stable ``var_pop``; Spark's ``ClusteringEvaluator``).
* Nearest centroid takes the rows past ball trees over the centres, broadcast
  in parts of a bounded size, at every number of centres.
* The exact Euclidean silhouette needs pair distances within each cluster and
  to the nearest other cluster. A row's distance to a centroid bounds its mean
  distance to the cluster on both sides, so clusters that cannot be nearest
  are left out. Pairs are never emitted as rows: clusters are hashed into
  blocks of bounded rows and values, each packed into one row; a pair of
  blocks (tile) is one pandas group and emits only sums per row. Its distances
  come from matrix products in chunks that stay in the cache; in one and two
  dimensions large tiles take their sums from trees of boxes
  (:mod:`farfield`), whose work grows with the rows instead of the pairs.
  ``silhouette_squared`` is the linear-cost metric for very large n.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.operators.balltree import PART_VALUES, nearest_centre
from regiopanel.operators.farfield import MOST_NODES, box_sums
from regiopanel.operators.ranking import group_rank
from regiopanel.session import materialize

MAX_TILE_TASKS = 20_000  # beyond it a task takes several tiles, one after the other
BLOCK_ROWS, BOX_BLOCK_ROWS = 16_384, 131_072  # rows of a block at most; the second where tiles take trees of boxes ...
BLOCK_VALUES = 1 << 20  # ... and its values, 8 MB
BOX_PAIRS = 1 << 26  # pairs of a tile from which trees of boxes are cheaper
CHUNK_ROWS, CHUNK_VALUES = 256, 4_000_000  # pairs are taken by squares of so many rows; values of a step at most
CANCELS = 1e-6  # squared distances below this share of the rows' squares are taken from differences


def as_array(features: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features])


def centroids(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    return df.groupBy(label).agg(*[F.avg(c).alias(c) for c in features])


def inertia_by_label(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Sum of squared distances to the label mean: ``n * sum_d var_pop(x_d)`` per label."""
    total = sum((F.var_pop(c) for c in features[1:]), F.var_pop(features[0]))
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                 (F.count(F.lit(1)) * total).alias("inertia"))


def total_inertia(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Inertia of the one-cluster labelling (k = 1), which Spark's KMeans does not fit."""
    total = sum((F.var_pop(c) for c in features[1:]), F.var_pop(features[0]))
    return df.agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) * total).alias("inertia"))


def _sqdist(feats: Column, centre: Column) -> Column:
    return F.aggregate(F.zip_with(feats, centre, lambda a, b: (a - b) * (a - b)),
                       F.lit(0.0), lambda acc, v: acc + v)


def nearest_of_literals(feats: Column, centres: Sequence[tuple[int, Sequence[float]]]) -> Column:
    """``struct(d2, cid)`` of the nearest centre (id as int); ties go to the lower id."""
    arr = F.array(*[F.struct(F.lit(int(cid)).alias("cid"), F.array(*[F.lit(float(v)) for v in vec]).alias("c"))
                    for cid, vec in centres])
    dists = F.transform(arr, lambda ct: F.struct(_sqdist(feats, ct["c"]).alias("d"), ct["cid"].alias("cid")))
    return F.array_min(dists)


def nearest_centroid(points: DataFrame, feats: str, centres: DataFrame, cid: str, cfeats: str,
                     out: str = "nearest", dist_out: str | None = None, id_col: str | None = None,
                     max_values: int = PART_VALUES, block_size: int | None = None) -> DataFrame:
    """Label of the nearest centre (squared Euclidean), ties to the lower label; every row of ``points`` stays.

    One method at every number of centres (:mod:`regiopanel.operators.balltree`),
    shipped in parts of ``max_values`` values. ``id_col`` and ``block_size`` are
    accepted for older callers; rows need no id.
    """
    return nearest_centre(points, feats, centres, cid, cfeats, out, dist_out, part_values=max_values)


def grid_axis(lo: float, hi: float, step: float) -> tuple[float, int]:
    """``np.arange(lo, hi, step)`` as (start, count)."""
    return lo, int(math.ceil((hi - lo) / step))


def decision_grid(df: DataFrame, x: str, y: str, centres: DataFrame, cid: str,
                  step: float = 0.05, pad: float = 1.0) -> DataFrame:
    """Nearest-centre label on the grid ``[min-pad, max+pad)`` x same, step ``step``.

    The grid is one ``spark.range`` (no join), sized from the data's extent.
    """
    ext = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    x_start, nx = grid_axis(ext["x0"] - pad, ext["x1"] + pad, step)
    y_start, ny = grid_axis(ext["y0"] - pad, ext["y1"] + pad, step)
    spark = df.sparkSession
    g = spark.range(nx * ny).select(
        (F.lit(x_start) + (F.col("id") / F.lit(ny)).cast("long") * F.lit(step)).alias("gx"),
        (F.lit(y_start) + F.pmod(F.col("id"), F.lit(ny)) * F.lit(step)).alias("gy"))
    own = centres.select(cid, as_array([x, y]).alias("_c"))
    return nearest_centroid(g.withColumn("_p", F.array("gx", "gy")), "_p", own, cid, "_c").select("gx", "gy", "nearest")


# ---------------------------------------------------------------------------
# Exact Euclidean silhouette by blocked tiles


def _by_keys(pdf: pd.DataFrame, keys: list[str]) -> dict[tuple, np.ndarray]:
    """Row numbers by the values of ``keys``; null is a value."""
    found: dict[tuple, list[int]] = {}
    values = [[None if pd.isna(v) else v for v in pdf[c]] for c in keys]
    for i, key in enumerate(zip(*values) if keys else [()] * len(pdf)):
        found.setdefault(key, []).append(i)
    return {k: np.array(v) for k, v in found.items()}


def _cluster_bounds(shared, n_keys: int, feats: str, last: bool):
    """Per row: ``_u``, an upper bound of the mean distance to the nearest other cluster; ``_m``, blocks of its own.

    In the last step also ``_need``, the other clusters that may be nearest, with their numbers of blocks.

    With centroid m and mean squared deviation v of a cluster, the mean distance of x to it lies between |x - m|
    and sqrt(|x - m|^2 + v) (Jensen). Clusters beyond the least upper bound cannot be the nearest.
    """
    def run(batches):
        table = shared.value
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf[feats].to_numpy()).astype(np.float64)
            upper = pdf["_u"].to_numpy(np.float64).copy()
            need: list[list] = [[]] * len(pdf)
            own, blocks = pdf["_l"].to_numpy(), pdf["_m"].to_numpy().copy()
            for g, idx in _by_keys(pdf, list(pdf.columns[:n_keys])).items():
                if g not in table:
                    continue
                labels, middle, spread, cut = table[g]
                for i in range(0, len(idx), 256):
                    rows = idx[i:i + 256]
                    gap2 = ((x[rows, None, :] - middle[None, :, :]) ** 2).sum(axis=2)
                    mine = labels[None, :] == own[rows, None]
                    blocks[rows] = np.maximum(blocks[rows], (mine * cut[None, :]).max(axis=1))
                    most = np.where(mine, np.inf, np.sqrt(gap2 + spread[None, :]))
                    upper[rows] = np.fmin(upper[rows], most.min(axis=1))
                    if last:
                        near = ~mine & (np.sqrt(gap2) <= upper[rows, None] * (1 + 1e-9) + 1e-9)
                        for r, hit in zip(rows, near):
                            need[r] = [{"l": c, "m": int(m)} for c, m in zip(labels[hit].tolist(), cut[hit])]
            pdf["_u"], pdf["_m"] = upper, blocks
            if last:
                pdf["_need"] = need
            yield pdf
    return run


def _clusters(pts: DataFrame, keys: list[str], label: str, feats: str) -> DataFrame:
    """One row per (keys, label): ``n``, centroid ``m``, mean squared deviation ``v``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    vec = pts.select(*keys, label, array_to_vector(F.col(feats)).alias("_x"))
    s = vec.groupBy(*keys, label).agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("_x")).alias("s"))
    n = F.col("s.count")
    total = F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda acc, v: acc + v)
    return s.select(*keys, label, n.alias("n"), vector_to_array("s.mean").alias("m"), (total * (n - 1) / n).alias("v"))


def _block_rows(dim: int, block_size: int | None) -> int:
    most = block_size or (BOX_BLOCK_ROWS if dim in MOST_NODES else BLOCK_ROWS)
    return max(1, min(most, BLOCK_VALUES // max(1, dim)))


def _needed(pts: DataFrame, keys: list[str], label: str, feats: str, block_size: int | None) -> DataFrame:
    """``pts`` with ``_m`` and ``_need`` (see :func:`_cluster_bounds`). Clusters reach the rows in bounded parts."""
    spark = pts.sparkSession
    first = pts.select(F.size(feats).alias("d")).first()
    dim = max(1, (first["d"] if first else 1) or 1)
    most = max(1, PART_VALUES // dim)
    clusters = _clusters(pts, keys, label, feats)
    listed = clusters.limit(most + 1).toPandas()
    if len(listed) <= most:
        parts = [listed]
    else:
        clusters = materialize(clusters)
        n = math.ceil(clusters.count() / most)
        dealt = clusters.withColumn("_p", F.pmod(F.xxhash64(*keys, label), F.lit(n)))
        parts = [dealt.filter(F.col("_p") == p).drop("_p").toPandas() for p in range(n)]
    shared = []
    for own in parts:
        table: dict[tuple, tuple] = {}
        for g, rows in _by_keys(own, keys).items():
            t = own.iloc[rows]
            middle = np.stack(t["m"].to_numpy()).astype(np.float64)
            table[g] = (t[label].to_numpy(), middle, t["v"].to_numpy(np.float64),
                        -(-t["n"].to_numpy(np.int64) // _block_rows(middle.shape[1], block_size)))
        shared.append(spark.sparkContext.broadcast(table))
    kind = f"array<struct<l:{pts.schema[label].dataType.simpleString()},m:bigint>>"
    state = pts.withColumn("_l", F.col(label)).withColumn("_u", F.lit(math.inf)).withColumn("_m", F.lit(0).cast("bigint"))
    state = state.select(*keys, *[c for c in state.columns if c not in keys])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema)
    # One part: bound and choice in one step. More: the bound over all parts first, then the choice part by part.
    if len(shared) == 1:
        return state.mapInPandas(_cluster_bounds(shared[0], len(keys), feats, True), f"{fields}, _need {kind}").drop("_l", "_u")
    for part in shared:
        state = state.mapInPandas(_cluster_bounds(part, len(keys), feats, False), fields)
    state = materialize(state).withColumn("_all", F.array().cast(kind))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema)
    for part in shared:
        state = state.mapInPandas(_cluster_bounds(part, len(keys), feats, True), f"{fields}, _need {kind}")
        state = state.withColumn("_all", F.concat("_all", "_need")).drop("_need")
    return state.withColumnRenamed("_all", "_need").drop("_l", "_u")


def silhouette_tiles(blocks: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Pairs of blocks (keys, _la, _ba, _lb, _bb) whose distances are needed, with ``_a`` and ``_b``: which side needs them.

    A block is a part of one cluster: a row of ``blocks``, with the clusters that its rows need. Own clusters: every
    pair of blocks once; other clusters: those that some row of the block needs.
    """
    per = blocks.select(*keys, F.col(label).alias("_l"), "_blk", "_need", "_m")
    here = F.struct(F.col("_l").alias("l"), F.col("_blk").alias("b"))
    there = F.struct(F.col("_to").alias("l"), F.col("_j").alias("b"))
    mine = F.array(F.struct(F.col("_l").alias("l"), F.col("_m").alias("m")))
    want = per.select(*keys, "_l", "_blk", F.explode(F.concat("_need", mine)).alias("_w"))
    pairs = (want.select(*keys, "_l", "_blk", F.col("_w.l").alias("_to"), F.explode(F.sequence(F.lit(0), (F.col("_w.m") - 1).cast("int"))).alias("_j"))
             .filter((F.col("_to") != F.col("_l")) | (F.col("_j") >= F.col("_blk"))))
    same = F.col("_to") == F.col("_l")
    first = here <= there
    pairs = pairs.select(*keys, F.when(first, here).otherwise(there).alias("x"), F.when(first, there).otherwise(here).alias("y"),
                         (first | same).alias("a"), (~first | same).alias("b"))
    return pairs.groupBy(*keys, "x", "y").agg(F.max("a").alias("_a"), F.max("b").alias("_b")).select(
        *keys, F.col("x.l").alias("_la"), F.col("x.b").alias("_ba"), F.col("y.l").alias("_lb"), F.col("y.b").alias("_bb"), "_a", "_b")


def _direct(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of |x - y| for each x and for each y, from differences."""
    to_x, to_y = np.empty(len(x)), np.zeros(len(y))
    chunk = max(1, CHUNK_VALUES // max(1, y.size))
    for i in range(0, len(x), chunk):
        diff = x[i:i + chunk, None, :] - y[None, :, :]
        d = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
        to_x[i:i + chunk] = d.sum(axis=1)
        to_y += d.sum(axis=0)
    return to_x, to_y


def distance_sums(x: np.ndarray, y: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums of |x - y| over the other side, for each x and for each y; without ``y`` over the pairs of ``x``.

    Squares come from a matrix product, ``|x|^2 + |y|^2 - 2 x . y`` around the middle of the rows. Where they are
    small beside ``|x|^2 + |y|^2``, so that digits would cancel, they are taken again from the difference, as are
    rows whose squares are not finite. Many pairs of one or two dimensions go to :func:`box_sums`.
    """
    alone = y is None
    y = x if alone else y
    to_x, to_y = np.zeros(len(x)), np.zeros(len(y))
    with np.errstate(invalid="ignore", over="ignore"):
        firm = np.isfinite(np.einsum("ij,ij->i", y, y))
        middle = y[firm].mean(axis=0) if firm.any() else np.zeros(y.shape[1])
        u, v = x - middle, y - middle
        uu, vv = np.einsum("ij,ij->i", u, u), np.einsum("ij,ij->i", v, v)
        odd_x, odd_y = np.flatnonzero(~np.isfinite(uu)), np.flatnonzero(~np.isfinite(vv))
        # By their squares, so that the rows of a chunk share a bound.
        ox, oy = (np.argsort(n, kind="stable")[:len(n) - len(odd)] for n, odd in ((uu, odd_x), (vv, odd_y)))
        if len(odd_x) or len(odd_y):
            to_x[odd_x], to_y[odd_y] = _direct(x[odd_x], y)[0], _direct(x, y[odd_y])[1]
            to_x[ox], to_y[oy] = _direct(x[ox], y[odd_y])[0], _direct(x[odd_x], y[oy])[1]
    if x.shape[1] in MOST_NODES and len(ox) * len(oy) >= BOX_PAIRS:
        by_x, by_y = box_sums(x[ox], None if alone else y[oy])
        to_x[ox] += by_x
        to_y[oy] += 0.0 if alone else by_y
        return to_x, to_x if alone else to_y
    u, v, uu, vv = u[ox], v[oy], uu[ox], vv[oy]
    left = np.column_stack([u * -2.0, uu, np.ones(len(u))])
    right = np.ascontiguousarray(np.column_stack([v, np.ones(len(v)), vv]).T)
    by_x, by_y = np.zeros(len(u)), np.zeros(len(v))
    square, ones = np.empty((CHUNK_ROWS, CHUNK_ROWS)), np.ones(CHUNK_ROWS)
    for i in range(0, len(u), CHUNK_ROWS):
        rows = left[i:i + CHUNK_ROWS]
        for j in range(i if alone else 0, len(v), CHUNK_ROWS):
            n = min(CHUNK_ROWS, len(v) - j)
            d = square[:len(rows), :n] if n == CHUNK_ROWS else np.empty((len(rows), n))
            np.matmul(rows, right[:, j:j + n], out=d)
            bound = CANCELS * (uu[i:i + CHUNK_ROWS] + vv[j + n - 1])
            close = np.flatnonzero(d <= bound[:, None]) if d.min() <= bound[-1] else ()
            for s in range(0, len(close), CHUNK_VALUES // 64):
                at = close[s:s + CHUNK_VALUES // 64]
                r, c = np.divmod(at, n)
                gap = u[i + r] - v[j + c]
                d[r, c] = np.einsum("ij,ij->i", gap, gap)
            np.sqrt(d, out=d)
            by_x[i:i + len(rows)] += d @ ones[:n]
            if not alone:
                by_y[j:j + n] += ones[:len(rows)] @ d
            elif j > i:
                by_x[j:j + n] += ones[:len(rows)] @ d
    to_x[ox] += by_x
    to_y[oy] += by_x if alone else by_y
    return to_x, to_y


def _tile_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """One or both blocks of a tile: for the side that needs it, the sums of each row over the other block."""
    pdf = pdf.sort_values("_role")
    x = [np.asarray(v, np.float64).reshape(n, -1) for v, n in zip(pdf["_x"], pdf["_n"])]
    sums = distance_sums(*x)
    out = pdf[["_bid", "_own", "_olab"]].assign(_s=list(sums[:len(x)]), _c=pdf["_n"].to_numpy()[::-1])
    return out[pdf["_asks"].to_numpy(bool)]


def _block_means(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block, its first row with ``_new`` (where an id begins): mean distances of each id to its own and to the nearest other cluster."""
    head = pdf["_new"].notna().to_numpy()
    first = pdf[head].iloc[0]
    ids = np.cumsum(np.asarray(first["_new"], bool)) - 1
    times = np.bincount(ids)
    size, a, b, lone = np.zeros(len(times), np.int64), np.full(len(times), np.nan), np.full(len(times), np.nan), True
    for (own, _), of in pdf[~head].groupby(["_own", "_olab"], sort=False):
        total = np.bincount(ids, weights=np.sum(of["_s"].to_list(), axis=0))
        count = int(of["_c"].sum()) * times
        if own:
            size = count
            a = np.divide(total, count - 1, out=np.full(len(times), np.nan), where=count > 1)
        else:
            b, lone = np.fmin(b, total / count), False
    return pd.DataFrame({"_bid": [first["_bid"]], "_lone": [lone], "_size": [size], "_a": [a], "_b": [b]})


def silhouette_samples(df: DataFrame, id_col: str, label_col: str, feats: str,
                       group_cols: Sequence[str] = (), block_size: int | None = None) -> DataFrame:
    """Exact Euclidean silhouette per row (sklearn semantics; singleton cluster -> 0).

    ``feats`` is an array<double> column, ids are unique within a group.
    ``group_cols`` runs independent silhouettes side by side (e.g. one per
    variable) in the same job. Distances are taken to the own cluster and to
    those that may be nearest (:func:`silhouette_tiles`); clusters are cut into
    blocks of about ``block_size`` rows (by default ``BLOCK_ROWS``, in one and
    two dimensions ``BOX_BLOCK_ROWS``), so a large one is many tiles. A block
    travels as one row, so the rows move once per block that they meet, and a
    tile gives back one sum per row.
    """
    keys = list(group_cols)
    pts = df.select(*keys, id_col, label_col, F.col(feats).cast("array<double>").alias(feats))
    near = _needed(pts, keys, label_col, feats, block_size)
    placed = near.withColumn("_blk", F.pmod(F.xxhash64(F.col(id_col)), F.col("_m")).cast("int"))
    rows = F.sort_array(F.collect_list(F.struct(F.col(id_col).alias("i"), F.col(feats).alias("x"))))
    blocks = placed.groupBy(*keys, label_col, "_blk").agg(
        rows.alias("_rows"), F.array_distinct(F.flatten(F.collect_set("_need"))).alias("_need"), F.first("_m").alias("_m"))
    blocks = materialize(blocks.select(
        *keys, label_col, "_blk", "_need", "_m", F.size("_rows").alias("_n"), F.transform("_rows", lambda r: r["i"]).alias("_ids"),
        F.transform("_rows", lambda r, k: (k == 0) | ~r["i"].eqNullSafe(F.get("_rows", k - 1)["i"])).alias("_new"),
        F.flatten(F.transform("_rows", lambda r: r["x"])).alias("_x"), F.monotonically_increasing_id().alias("_bid")))
    named = blocks.select(*[F.col(c).alias(f"_k_{c}") for c in keys], F.col(label_col).alias("_l"), F.col("_blk").alias("_i"), "_bid")

    def numbered(tiles, lab: str, blk: str, out: str):
        on = (F.col(lab) == F.col("_l")) & (F.col(blk) == F.col("_i"))
        for c in keys:
            on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        return tiles.join(named, on).withColumnRenamed("_bid", out).drop("_l", "_i", *[f"_k_{c}" for c in keys])
    tiles = numbered(numbered(silhouette_tiles(blocks, keys, label_col), "_la", "_ba", "_x0"), "_lb", "_bb", "_x1")
    tiles = materialize(tiles.select("_x0", "_x1", "_la", "_lb", "_a", "_b", F.monotonically_increasing_id().alias("_t")))
    n_tiles = tiles.count()

    def side(role: int, block: str, other: str, asks: str, skip):
        t = tiles.filter(skip).select(F.col(block).alias("_bid"), "_t", (F.col("_la") == F.col("_lb")).alias("_own"),
                                      F.col(other).alias("_olab"), F.col(asks).alias("_asks"), F.lit(role).alias("_role"))
        # The list of tiles is small next to the rows; it is broadcast while its counted size is.
        return blocks.select("_bid", "_n", "_x").join(F.broadcast(t) if n_tiles <= MAX_TILE_TASKS else t, "_bid")
    both = side(0, "_x0", "_lb", "_a", F.lit(True)).unionByName(side(1, "_x1", "_la", "_b", F.col("_x0") != F.col("_x1")))
    # Tiles are CPU work on few bytes: spread them over the cores instead of letting
    # AQE coalesce them by size (the groupBy reuses this partitioning).
    both = both.repartition(max(1, min(n_tiles, MAX_TILE_TASKS)), "_t")
    kind = dict(pts.dtypes)[label_col]
    sums = both.groupBy("_t").applyInPandas(_tile_sums, f"_bid bigint, _own boolean, _olab {kind}, _s array<double>, _c bigint")
    all_sums = blocks.select("_bid", "_new").unionByName(sums, allowMissingColumns=True)
    means = all_sums.groupBy("_bid").applyInPandas(_block_means, "_bid bigint, _lone boolean, _size array<bigint>, _a array<double>, _b array<double>")
    ids = F.filter("_ids", lambda v, k: F.get("_new", k)).alias("_ids")
    res = blocks.select(*keys, label_col, "_bid", ids).join(means, "_bid")
    res = res.select(*keys, label_col, "_lone", F.explode(F.arrays_zip("_ids", "_size", "_a", "_b")).alias("_r"))
    res = res.select(*keys, F.col("_r._ids").alias(id_col), label_col, F.col("_r._size").alias("_n_own"),
                     F.when(F.col("_r._size") > 1, F.col("_r._a")).alias("a"), F.when(~F.col("_lone"), F.col("_r._b")).alias("b"))
    sil = F.when(F.col("_n_own") <= 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return res.withColumn("silhouette", sil).drop("_n_own")


def silhouette_squared_samples(df: DataFrame, label_col: str, feats: str, block_size: int = 64,
                               group_col: str | None = None) -> DataFrame:
    """Per-row silhouette with squared Euclidean distance, linear in n.

    Mean squared distance from x to cluster C is
    ``|x|^2 + S_C / n_C - 2 x . Y_C / n_C`` with ``Y_C`` the feature sum and
    ``S_C`` the sum of squared norms, so one aggregation (k rows) suffices.
    The own cluster excludes x itself (divide by ``n_C - 1``), as Spark's
    ``ClusteringEvaluator`` does; a singleton cluster scores 0. The statistics
    are joined in blocks of ``block_size`` clusters, however many there are.
    With ``group_col`` each of its (non-null) values is a clustering of its
    own, and their points may differ in length.
    """
    x = F.col(feats).cast("array<double>")
    dim = df.agg(F.max(F.size(x)).alias("d")).first()["d"] or 0
    zero = F.lit(0.0)
    group = F.col(group_col) if group_col else F.lit(0)
    norm = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
    sums = F.array(*[F.sum(F.coalesce(F.get(x, F.lit(i)), zero)) for i in range(dim)]).cast("array<double>")
    stats = materialize(df.groupBy(group.alias("g"), F.col(label_col).alias("l")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(norm).alias("sq"), sums.alias("y")))
    blocks = max(1, math.ceil(stats.count() / block_size))
    grouped = (stats.groupBy(F.pmod(F.xxhash64("g", "l"), F.lit(blocks)).cast("int").alias("_blk"))
               .agg(F.collect_list(F.struct("g", "l", "n", "sq", "y")).alias("_st")))
    rows = df.withColumn("_row", F.struct(*df.columns))
    if blocks > 1:
        rows = materialize(rows.withColumn("_id", F.monotonically_increasing_id()))
    spread = rows.withColumn("_blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(grouped, "_blk")

    def total(s):
        dot = F.aggregate(F.zip_with(x, s["y"], lambda p, q: F.coalesce(p, zero) * F.coalesce(q, zero)), zero, lambda acc, v: acc + v)
        return s["n"].cast("double") * norm + s["sq"] - F.lit(2.0) * dot

    own, others = (F.filter("_st", lambda s: (s["g"] == group) & (s["l"] == F.col(label_col))),
                   F.filter("_st", lambda s: (s["g"] == group) & (s["l"] != F.col(label_col))))
    part = spread.withColumn("_o", F.get(F.transform(own, lambda s: F.struct(
        s["n"].alias("n"), F.try_divide(total(s), (s["n"] - 1).cast("double")).alias("a"))), 0))
    part = part.withColumn("_b", F.array_min(F.transform(others, lambda s: total(s) / s["n"].cast("double"))))
    if blocks > 1:
        part = part.groupBy("_id").agg(F.first("_row").alias("_row"), F.max("_o").alias("_o"), F.min("_b").alias("_b"))
    a, b = F.col("_o.a"), F.col("_b")
    sil = F.when(F.col("_o.n") <= 1, F.lit(0.0)).otherwise(F.coalesce(
        F.when(a < b, F.lit(1.0) - a / b).when(a > b, b / a - F.lit(1.0)).otherwise(F.lit(0.0)), F.lit(0.0)))
    return part.select("_row.*", sil.alias("silhouette_sq"))


def silhouette_squared(df: DataFrame, label_col: str, feats: str) -> float:
    """Mean silhouette with squared Euclidean distance (Spark ML, linear in n)."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector
    data = df.select(array_to_vector(F.col(feats).cast("array<double>")).alias("features"),
                     F.col(label_col).cast("double").alias("prediction"))
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(data))


# ---------------------------------------------------------------------------
# Exact one-dimensional silhouette in O(n log n)


LABELS_PER_BLOCK = 512


def _label_starts(keys: list[str], width: int):
    """Per (keys, block): for each partition of the sorted rows the count and sum of every label before it, and in all."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = np.unique(pdf["_pid"].to_numpy())
        at = np.searchsorted(parts, pdf["_pid"].to_numpy())
        own = pdf["_li"].to_numpy() >= 0
        table = np.zeros((2, len(parts), width))
        np.add.at(table[0], (at[own], pdf["_li"].to_numpy()[own]), pdf["n"].to_numpy(np.float64)[own])
        np.add.at(table[1], (at[own], pdf["_li"].to_numpy()[own]), pdf["v"].to_numpy(np.float64)[own])
        upto = table.cumsum(axis=1)
        before, total = upto - table, upto[:, -1]
        first = pdf.iloc[[0] * len(parts)]
        out = first[keys].reset_index(drop=True)
        out["_blk"], out["_pid"] = pdf["_blk"].iloc[0], parts
        out["n0"], out["v0"] = list(before[0]), list(before[1])
        out["n1"], out["v1"] = [total[0]] * len(parts), [total[1]] * len(parts)
        return out
    return fn


def _label_block(keys: list[str], id_col: str, label_col: str, value_col: str):
    """Distances of a partition's rows to the labels of one block, from their prefix counts and sums."""
    cols = [*keys, "_row", id_col, label_col, "_n", "_a", "_b"]

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf["n0"].notna()
        starts, rows = pdf[head], pdf[~head]
        rows = rows.sort_values([value_col, "_row"], kind="stable")
        n, v = starts["n0"].iloc[0].astype(np.float64).copy(), starts["v0"].iloc[0].astype(np.float64).copy()
        n1, v1 = starts["n1"].iloc[0], starts["v1"].iloc[0]
        there = np.flatnonzero(n1 > 0)
        x, li = rows[value_col].to_numpy(np.float64), rows["_li"].to_numpy().astype(np.int64)
        size, a, b = (np.full(len(rows), np.nan) for _ in range(3))
        for s in range(0, len(rows), 2048):
            xi, own = x[s:s + 2048, None], li[s:s + 2048]
            mine = np.flatnonzero(own >= 0)
            hot = np.zeros((len(xi), len(n)))
            hot[mine, own[mine]] = 1.0
            count, total = n + np.cumsum(hot, axis=0), v + np.cumsum(hot * xi, axis=0)
            n, v = count[-1], total[-1]
            # sum |x - y| = 2 (x count(y <= x) - sum(y <= x)) + sum(y) - x count(y); rows tied with x add 0 either way.
            dist = 2.0 * (xi * count - total) + v1[None, :] - xi * n1[None, :]
            mean = np.full(dist.shape, np.inf)
            mean[:, there] = dist[:, there] / n1[None, there]
            mean[mine, own[mine]] = np.inf
            least = mean.min(axis=1) if mean.shape[1] else np.full(len(xi), np.inf)
            b[s:s + 2048] = np.where(np.isfinite(least), least, np.nan)
            size[s + mine] = n1[own[mine]]
            with np.errstate(divide="ignore", invalid="ignore"):
                a[s + mine] = np.where(n1[own[mine]] > 1, dist[mine, own[mine]] / (n1[own[mine]] - 1), np.nan)
        out = rows[[*keys, "_row", id_col, label_col]].assign(_n=size, _a=a, _b=b)
        return out.astype({"_row": np.int64})[cols]
    return fn


def silhouette_1d(df: DataFrame, id_col: str, label_col: str, value_col: str, group_cols: Sequence[str] = (),
                  num_partitions: int | None = None, block_size: int = LABELS_PER_BLOCK) -> DataFrame:
    """Exact Euclidean silhouette of one-dimensional values, without pair distances, for any number of labels.

    For x and cluster C, ``sum_j |x - x_j| = 2 (x cnt_C(<=x) - sum_C(<=x)) + sum_C - x n_C``,
    and rows tied with x may fall on either side of the prefix (they add 0).
    Labels are numbered and dealt to blocks of ``block_size``; rows are range-
    partitioned on (block, group, value, id), so hot groups and hot values are
    split. A block's counts and sums by partition give every partition its
    starting prefix (a join, nothing is collected), and each partition finishes
    its rows with cumulative sums. The blocks of a row are then reduced to the
    nearest cluster. Every row of ``df`` gives one row, whatever its id; null
    labels are a cluster; rows with a null value are left out.
    """
    keys = list(group_cols)
    p = int(num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = materialize(df.select(*keys, id_col, label_col, F.col(value_col).cast("double").alias(value_col))
                       .filter(F.col(value_col).isNotNull()).withColumn("_row", F.monotonically_increasing_id()))
    numbered = group_rank(base.select(label_col).distinct(), [], [label_col], rank_col="_r")
    names = materialize(numbered.select(F.col(label_col).alias("_name"), (F.col("_r") - 1).alias("_no")))
    k = names.count()
    blocks = max(1, math.ceil(k / block_size))
    named = base.join(F.broadcast(names) if k <= MAX_TILE_TASKS else names, F.col(label_col).eqNullSafe(F.col("_name"))).drop("_name")
    spread = named.withColumn("_blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    inside = F.floor(F.col("_no") / block_size) == F.col("_blk")
    spread = spread.withColumn("_li", F.when(inside, F.col("_no") % block_size).otherwise(F.lit(-1))).drop("_no")
    order = ["_blk", *keys, value_col, "_row"]
    placed = materialize(spread.repartitionByRange(p, *order).withColumn("_pid", F.spark_partition_id()))
    kinds = dict(placed.dtypes)
    typed = ", ".join(f"`{c}` {kinds[c]}" for c in keys)
    lead = typed + ", " if typed else ""
    stats = placed.groupBy(*keys, "_blk", "_pid", "_li").agg(F.count(F.lit(1)).alias("n"), F.sum(value_col).alias("v"))
    starts = stats.groupBy(*keys, "_blk").applyInPandas(_label_starts(keys, min(block_size, max(1, k))),
                                                        f"{lead}_blk int, _pid int, n0 array<double>, v0 array<double>, "
                                                        "n1 array<double>, v1 array<double>")
    # One row of starts goes with the rows of its partition and block.
    both = placed.unionByName(starts, allowMissingColumns=True)
    found = both.groupBy(*keys, "_blk", "_pid").applyInPandas(
        _label_block(keys, id_col, label_col, value_col),
        f"{lead}_row bigint, `{id_col}` {kinds[id_col]}, `{label_col}` {kinds[label_col]}, _n double, _a double, _b double")
    clean = [F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)).alias(c) for c in ("_n", "_a", "_b")]
    found = found.select(*keys, "_row", id_col, label_col, *clean)
    if blocks > 1:
        found = found.groupBy("_row").agg(*[F.first(c).alias(c) for c in (*keys, id_col, label_col)], F.max("_n").alias("_n"),
                                          F.max("_a").alias("_a"), F.min("_b").alias("_b"))
    a, b = F.col("_a"), F.col("_b")
    sil = F.when(F.col("_n") <= 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return found.select(*keys, id_col, label_col, a.alias("a"), b.alias("b"), sil.alias("silhouette"))
