"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, rerank by exact cosine.

Rotations of the centred unit vectors are learned on a bounded sample so that
signs lose as little as possible (iterative quantisation from several starts).
A vector's code is cut into substrings, each the key of one Hamming table;
vectors that agree in a substring are compared by the Hamming distance of their
whole codes, and those within a bound by cosine in double precision on their
original components. Table entries carry codes; original vectors are fetched only
for entries with a partner within the bound. Every vector is indexed and is a query.

The bound is measured as well: the mean distance of partners made at the threshold
and ``SPREAD`` deviations, and no less than the largest seen. Unrelated vectors differ
in about half their bits: the longer the code, the fewer of them pass.

The substring length is at most the logarithm of the number of vectors and some
bits, so that buckets of unrelated vectors stay small. The number of tables is
measured: partners at the threshold angle are made for vectors of the sample, in
random directions and towards other vectors, and tables are added until all but
``MISS`` of either kind meet in one (pairs above the threshold meet more often).
Centring widens the angle of a pair when vectors share a direction; bits then
agree less, and the length of least estimated cost is shorter.

Vectors of each length have rotations and tables of their own; few vectors of a
length are all compared.

Equal vectors form one class with a multiplicity, never pairs. Buckets are
compared block against block; a pair counts in the first table that it shares.
Blocks give counts and one link per vector to its component in the block, so
pairs of a dense group are counted but not emitted. Vectors of a class that holds over
1/``HOT`` of the rows get their results by broadcast (at most ``HOT`` classes), the
others by a shuffled join; rows without a usable vector take part in neither.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and are their own component; vectors of different
lengths never link; rows with equal vectors link with each other; an empty table gives
an empty result; components of any finite size count (vectors are scaled by their
largest component before their norm is taken); further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import first_by_hash, written
from regiopanel.llm.components import connected

COSINE = 0.95
MISS = 0.01
SAMPLE = 10_000
ROUNDS = 30
SPARE_BITS = 3
BLOCK = 256
PROBES = 1000
SPREAD = 5.0
HOT = 1000
#: Estimated cost of a table entry, of each key and component it carries, and of a comparison (by component).
ENTRY, KEY, COMPARE = 20.0, 0.05, 0.002


def plan_tables(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits per substring, number of tables) for ``n`` vectors."""
    bits = max(6, math.ceil(math.log2(max(n, 2))) + SPARE_BITS)
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def learn_rotation(x: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Rotation whose signs are the best codes found from one random start: alternate codes and Procrustes fits."""
    d = x.shape[1]
    r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]
    for _ in range(rounds if len(x) else 0):
        codes = np.where(x @ r >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(x.T @ codes)
        r = u @ v
    return r


def probes(unit: np.ndarray, cosine: float, toward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the sample and a partner of each at exactly ``cosine``, towards another vector or any direction."""
    rng = np.random.default_rng(2000 + toward)
    u = unit[rng.integers(0, len(unit), PROBES)]
    g = unit[rng.integers(0, len(unit), PROBES)] if toward else rng.standard_normal(u.shape)
    g = g - (g * u).sum(axis=1, keepdims=True) * u
    far = np.linalg.norm(g, axis=1) > 1e-6
    w = u.copy()
    w[far] = cosine * u[far] + math.sqrt(1 - cosine**2) * _unit(g[far])
    return u, w


def _needed(agree: list[np.ndarray], bits: int, miss: float) -> int:
    """Number of tables at which pairs whose bits agree with these chances miss at most ``miss`` on average."""
    met = [np.log1p(-np.minimum(a**bits, 1 - 1e-12)) for a in agree]
    lost = lambda t: max(np.exp(m * t).mean() for m in met)
    low, high = 0, 1
    while lost(high) > miss and high < 2**20:
        low, high = high, 2 * high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if lost(mid) > miss else (low, mid)
    return high


def fit(unit: np.ndarray, n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Mean, stacked rotations [dimension, at least bits * tables], bits and tables for ``n`` vectors like the sample."""
    d = unit.shape[1]
    mean = unit.mean(axis=0)
    rotations = [learn_rotation(unit - mean, 1000)]
    pairs = [probes(unit, cosine, toward) for toward in (False, True)]
    signs = lambda x, r: (x - mean) @ r >= 0
    # Agreement of a pair's bits is taken over at least 512 of them.
    many = np.hstack(rotations + [learn_rotation(unit - mean, 5000 + i, 0) for i in range(math.ceil(512 / d))])
    agree = [(signs(u, many) == signs(w, many)).mean(axis=1) for u, w in pairs]
    rng = np.random.default_rng(3000)
    one, two = unit[rng.integers(0, len(unit), PROBES)], unit[rng.integers(0, len(unit), PROBES)]
    chance = (signs(one, many) == signs(two, many)).mean(axis=1)
    plan = []
    for bits in range(plan_tables(n, cosine, miss)[0], 0, -1):
        tables = _needed(agree, bits, miss)
        plan.append((tables * (ENTRY + KEY * (tables + d) + COMPARE * d * n * (chance**bits).mean()), bits, tables))
    _, bits, tables = min(plan)
    while True:
        while len(rotations) * d < bits * tables:
            rotations.append(learn_rotation(unit - mean, 1000 + len(rotations)))
        rotation = np.hstack(rotations)
        met = [(substrings(u, mean, rotation, bits, tables) == substrings(w, mean, rotation, bits, tables)).any(axis=1).mean()
               for u, w in pairs]
        if min(met) >= 1 - miss:
            return mean, rotation, bits, tables
        # Learned bits agree less than chance bits: more tables, and shorter substrings once they are many.
        tables += math.ceil(tables / 8)
        if tables > 2 * _needed(agree, bits, miss) and bits > 1:
            bits -= 1
            tables = _needed(agree, bits, miss)


def code_bits(unit: np.ndarray, mean: np.ndarray, rotation: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """[vector, bit] codes: a bit for every column of the rotations, the first of which are the tables' substrings."""
    return (unit - mean) @ rotation >= 0


def keys_of(code: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """[vector, table] substring values of codes."""
    return code[:, :bits * tables].reshape(len(code), tables, bits).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def substrings(unit: np.ndarray, mean: np.ndarray, rotation: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """[vector, table] substring values."""
    return keys_of(code_bits(unit, mean, rotation, bits, tables), bits, tables)


def hamming_bound(unit: np.ndarray, model: tuple, cosine: float = COSINE) -> int:
    """Hamming distance of whole codes up to which pairs are reranked."""
    bound = 0.0
    for toward in (False, True):
        u, w = probes(unit, cosine, toward)
        apart = (code_bits(u, *model) != code_bits(w, *model)).sum(axis=1)
        bound = max(bound, apart.max(), apart.mean() + SPREAD * apart.std())
    return min(math.ceil(bound), model[1].shape[1])


def packed(code: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.packbits(code, axis=1)]


def unpacked(codes: list[bytes], size: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1), axis=1, count=size)


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very large or small components leave the range of doubles.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _model(vectors: DataFrame, d: int, n: int, cosine: float, miss: float):
    """(mean, rotation, bits, tables) and the Hamming bound for the ``n`` vectors of length ``d``; None if all are to be compared."""
    if n <= BLOCK:
        return None
    # The rotations are learned on the SAMPLE vectors that come first by hash: a bounded number of rows.
    sample = first_by_hash(vectors, SAMPLE, [F.col("v")], n).toArrow()
    unit = _unit(_matrix(sample.column("v"), d))
    model = fit(unit, n, cosine, miss)
    return model, hamming_bound(unit, model, cosine)


def _codes(shared):
    def run(batches):
        for batch in batches:
            size = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for d in np.unique(size):
                part = batch.filter(pa.array(size == d))
                if shared.value[int(d)] is None:
                    k, codes = np.zeros((part.num_rows, 1), np.int64), [b""] * part.num_rows
                else:
                    model = shared.value[int(d)][0]
                    code = code_bits(_unit(_matrix(part.column("v"), int(d))), *model)
                    k, codes = keys_of(code, *model[2:]), packed(code)
                yield pa.RecordBatch.from_pydict({
                    "cid": part.column("cid"), "d": pa.array(np.full(len(k), d, np.int32)), "code": pa.array(codes, pa.binary()),
                    "keys": pa.array(list(k), pa.list_(pa.int64()))})
    return run


def _components(n: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable within a block, per row."""
    label = ids.copy()
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        if (label == before).all():
            return label


def _pairs(pdf: pd.DataFrame, models: dict) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block that share a bucket, and no earlier one, and whose codes are within the Hamming bound."""
    table, side = pdf["t"].to_numpy(), pdf["side"].to_numpy()
    bucket = pdf.groupby(["t", "key"], sort=False).ngroup().to_numpy()
    a, b = np.nonzero(np.triu(bucket[:, None] == bucket[None, :], 1))
    # Between two blocks of a bucket only pairs across.
    good = (side[a] != side[b]) | (side[a] == 0)
    a, b = a[good], b[good]
    fitted = models[int(pdf["d"].iloc[0])]
    if fitted is None or not len(a):
        return a, b
    (_, rotation, bits, tables), bound = fitted
    code = unpacked(pdf["code"].to_list(), rotation.shape[1])
    words = np.packbits(np.pad(code, ((0, 0), (0, -code.shape[1] % 64))), axis=1).view(np.uint64)
    near = np.bitwise_count(words[a] ^ words[b]).sum(axis=1) <= bound
    a, b = a[near], b[near]
    keys = keys_of(code, bits, tables)
    first = np.argmax(keys[a] == keys[b], axis=1) == table[a] if len(a) else np.zeros(0, bool)
    return a[first], b[first]


def _near(shared):
    """The entries of a block that have a partner to rerank."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = _pairs(pdf, shared.value)
        return pdf.iloc[np.unique(np.concatenate([a, b]))]
    return run


def _rerank(cosine: float, shared):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, mult = pdf["cid"].to_numpy(), pdf["m"].to_numpy()
        a, b = _pairs(pdf, shared.value)
        x = _unit(np.stack(pdf["v"].to_list()).astype(np.float64))
        linked = (x @ x.T)[a, b] >= cosine
        a, b = a[linked], b[linked]
        count = np.bincount(a, mult[b], len(ids)) + np.bincount(b, mult[a], len(ids))
        hub = _components(len(ids), a, b, ids)
        hit = count > 0
        return pd.DataFrame({"cid": ids[hit], "links": count[hit].astype(np.int64), "hub": hub[hit]})
    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    some = F.exists(v, lambda c: c != 0)
    usable = F.coalesce((F.size(v) > 0) & ~bad & some, F.lit(False))
    rows = written(vectors.select("vec_id", F.when(usable, v).alias("v")).withColumn("row_no", F.monotonically_increasing_id()), "vectors")
    classes = written(rows.filter("v IS NOT NULL").groupBy("v").agg(
        F.min("row_no").alias("cid"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("m")), "vector-classes")
    lengths = {r["d"]: r["count"] for r in classes.groupBy(F.size("v").alias("d")).count().collect()}
    if not lengths:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    model = spark.sparkContext.broadcast({
        d: _model(classes.filter(F.size("v") == d).select("v"), d, n, cosine, miss) for d, n in sorted(lengths.items())})
    coded = written(classes.select("cid", "v").mapInArrow(_codes(model), "cid bigint, d int, code binary, keys array<bigint>"), "codes")
    entries = coded.select("cid", "d", "code", F.posexplode("keys").alias("t", "key"))
    full = written(entries.groupBy("d", "t", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "full-buckets")
    members = written(entries.join(full, ["d", "t", "key"]), "bucket-members")
    units = F.lit(max(1, math.ceil(members.count() / BLOCK))).cast("bigint")
    n = F.ceil(F.col("c") / BLOCK).cast("int")
    big = F.col("c") > BLOCK
    place = F.pmod(F.xxhash64("cid"), n).cast("int")
    # Small buckets share work units; a large one is cut into blocks, each pair of blocks a unit of its own.
    spread = members.withColumn("own", F.when(big, place).otherwise(0)).withColumn("n", F.when(big, n).otherwise(1))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "cid", "d", "code", "t", "key", F.when(big, F.col("key")).otherwise(-1 - F.pmod(F.xxhash64("t", "key"), units)).alias("unit"),
        F.when(big, F.col("t")).otherwise(-1).alias("big_t"),
        F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"))
    block = ["d", "big_t", "unit", "lo", "hi"]
    near = written(spread.groupBy(*block).applyInPandas(_near(model), spread.schema), "near-entries")
    found = written(near.join(classes.select("cid", "m", "v"), "cid").groupBy(*block)
                    .applyInPandas(_rerank(cosine, model), "cid bigint, links bigint, hub bigint"), "block-links")
    labels = connected(found.select(F.col("cid").alias("a"), F.col("hub").alias("b")))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = written(classes.join(counts, "cid", "left").join(labels.withColumnRenamed("id", "cid"), "cid", "left").select(
        "v", "m", "first_id", F.coalesce("component", "cid").alias("component"),
        (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "named")
    least = written(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "least")
    of_vector = written(named.join(least, "component").select(F.col("v").alias("w"), "m", "n_links", "component_id"), "of-vector")
    total = rows.count()
    hot = F.col("m") * HOT > total
    same = F.col("v") == F.col("w")
    # Few classes can be hot: their rows stay where they are.
    have = rows.filter("v IS NOT NULL").join(F.broadcast(of_vector.filter(hot)), same, "left")
    few = have.filter("w IS NULL").select("vec_id", "v").join(of_vector.filter(~hot), same)
    found_rows = have.filter("w IS NOT NULL").select("vec_id", "n_links", "component_id").unionByName(
        few.select("vec_id", "n_links", "component_id"))
    alone = rows.filter("v IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = found_rows.unionByName(alone)
    return out.select("vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id",
                      F.coalesce(F.col("vec_id").eqNullSafe(F.col("component_id")), F.lit(False)).alias("kept"))
