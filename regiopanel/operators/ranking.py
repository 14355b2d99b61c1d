"""Exact ranks and percentiles within groups that survive a hot group.

``Window.partitionBy(g)`` and the ``percentile`` aggregate both finish a group
inside one task, so a group holding a third of all rows lands on one executor.
Here the rows are range-partitioned on ``(group, order)`` instead: a hot group
is split over many partitions, and the rank is carried through each sorted
partition. Only the first and the last group of a partition can reach beyond
it, so two numbers per partition (from a small aggregate) make the local ranks
and sizes global; no row is joined or shuffled again.

The range-partitioned rows are written once with a reliable ``checkpoint()``
(to the cluster's ``spark.checkpoint.dir``): both the edge pass and the
ranking pass read that copy, so there is exactly one shuffle of the data, the
positions are fixed, and a lost executor does not force a re-shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.session import materialize


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _edges(s: DataFrame, group_cols: Sequence[str]) -> dict[int, tuple[int, int, int, int]]:
    """Per partition: rows of its first group before it, that group's size, rows of the last group here, its size.

    The driver sees one row per partition, never one per group.
    """
    runs = s.groupBy("_pid", *group_cols).agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    one = F.struct(F.struct(*group_cols).alias("g"), F.col("_n").alias("n")) if group_cols else \
        F.struct(F.lit(0).alias("g"), F.col("_n").alias("n"))
    per = runs.groupBy("_pid").agg(F.min_by(one, "_m0").alias("a"), F.max_by(one, "_m0").alias("z"),
                                   F.count(F.lit(1)).alias("groups")).orderBy("_pid").collect()
    # Groups that reach over partitions are numbered in order; each adds up what its partitions hold.
    sizes: list[int] = []
    before, first, final = {}, {}, {}
    key = None
    for r in per:
        p = r["_pid"]
        if not sizes or r["a"]["g"] != key:
            sizes.append(0)
        before[p], first[p] = sizes[-1], len(sizes) - 1
        sizes[-1] += r["a"]["n"]
        if r["groups"] > 1:
            sizes.append(r["z"]["n"])
        final[p], key = len(sizes) - 1, r["z"]["g"]
    return {r["_pid"]: (before[r["_pid"]], sizes[first[r["_pid"]]], r["z"]["n"], sizes[final[r["_pid"]]]) for r in per}


def _changes(batch: pa.RecordBatch, group_cols: Sequence[str]) -> np.ndarray:
    """Whether each row but the first begins another group than the row before it (nulls are equal)."""
    new = np.zeros(max(batch.num_rows - 1, 0), bool)
    for c in group_cols:
        codes = batch.column(c).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new |= codes[1:] != codes[:-1]
    return new


def _ranker(edges: dict[int, tuple[int, int, int, int]], group_cols: list[str], rows: dict[int, int], keep: list[str],
            rank_col: str, size_col: str | None):
    def emit(batch: pa.RecordBatch, rank: np.ndarray, size: np.ndarray | None) -> pa.RecordBatch:
        cols = {c: batch.column(c) for c in keep}
        cols[rank_col] = pa.array(rank, pa.int64())
        if size_col:
            cols[size_col] = pa.array(size, pa.int64())
        return pa.RecordBatch.from_pydict(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []  # rows whose inner group is not over yet
        last, count, seen, first_group = None, 0, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            pid = batch.column("_pid")[0].as_py()
            before, first_size, last_rows, last_size = edges[pid]
            tail = rows[pid] - last_rows  # row at which the partition's last group begins
            key = [batch.column(c)[0].as_py() for c in group_cols]
            if last is None:
                count = before
            starts = np.concatenate([[last is not None and key != last], _changes(batch, group_cols)])
            at = np.flatnonzero(starts)
            pos = np.arange(batch.num_rows)
            begin = np.zeros(batch.num_rows, np.int64)
            begin[at] = at
            begin = np.maximum.accumulate(begin)
            inside = np.cumsum(starts) > 0
            rank = np.where(inside, pos - begin + 1, pos + 1 + count)
            if size_col is None:
                yield emit(batch, rank, None)
            else:
                size = np.full(batch.num_rows, -1, np.int64)
                cuts = [0, *at.tolist(), batch.num_rows] if not (len(at) and at[0] == 0) else [*at.tolist(), batch.num_rows]
                if len(at) and held:  # the group open so far ends in this batch
                    full = count if at[0] == 0 else count + int(at[0])
                    for b, r, z in held:
                        z[z < 0] = full
                        yield emit(b, r, z)
                    held = []
                for i, (x, y) in enumerate(zip(cuts, cuts[1:])):
                    if x == y:
                        continue
                    own_first = first_group and not inside[x]
                    if seen + x >= tail:
                        size[x:y] = last_size
                    elif own_first:
                        size[x:y] = first_size
                    elif y < batch.num_rows:
                        size[x:y] = rank[y - 1]
                if (size < 0).any():
                    held.append((batch, rank, size))
                else:
                    for b, r, z in held:
                        yield emit(b, r, z)
                    held = []
                    yield emit(batch, rank, size)
            first_group = first_group and not len(at)
            count = int(rank[-1])
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in group_cols]
            seen += batch.num_rows
        for b, r, z in held:
            z[z < 0] = count
            yield emit(b, r, z)
    return run


def group_rank(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
               rank_col: str = "rank", size_col: str | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` without one-task groups.

    ``order_cols`` should make a total order within a group (add the id);
    ties get distinct, arbitrary ranks like ``row_number``. ``size_col``
    optionally adds the group size.
    """
    group_cols = list(group_cols)
    orders = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    p = _partitions(df, num_partitions)
    keys = [F.col(c) for c in group_cols] + orders
    # One range shuffle. Within a partition rows are sorted, so the row index
    # from monotonically_increasing_id follows (group, order).
    s = (df.repartitionByRange(p, *keys).sortWithinPartitions(*keys)
         .withColumn("_mid", F.monotonically_increasing_id())
         .withColumn("_pid", F.spark_partition_id()))
    s = materialize(s)
    edges = _edges(s, group_cols)
    rows = {r["_pid"]: r["n"] for r in s.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()} if size_col else dict.fromkeys(edges, 0)
    keep = df.columns
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    schema = ", ".join([*kinds, f"`{rank_col}` bigint", *([f"`{size_col}` bigint"] if size_col else [])])
    return s.drop("_mid").mapInArrow(_ranker(edges, group_cols, rows, keep, rank_col, size_col), schema)


def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      probs: Sequence[float], names: Sequence[str] | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation (like ``percentile``/numpy), by group.

    Null values are ignored. One output row per group with one column per
    probability. Cost: one range shuffle plus small count tables; no group is
    ever held by a single task.
    """
    group_cols = list(group_cols)
    names = list(names or [f"p{int(round(q * 100))}" for q in probs])
    vals = df.select(*group_cols, F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    ranked = group_rank(vals, group_cols, ["_v"], rank_col="_r", size_col="_n", num_partitions=num_partitions)
    # Positions (1-based) around h = (n - 1) * q for every probability.
    picks = []
    for q, name in zip(probs, names):
        h = (F.col("_n") - 1).cast("double") * F.lit(float(q))
        picks.append((name, F.floor(h) + 1, F.ceil(h) + 1, h - F.floor(h)))
    wanted = None
    for _, lo, hi, _ in picks:
        c = (F.col("_r") == lo) | (F.col("_r") == hi)
        wanted = c if wanted is None else (wanted | c)
    hits = ranked.filter(wanted)
    aggs = [F.first("_n").alias("_n")]
    for name, lo, hi, _ in picks:
        aggs.append(F.max(F.when(F.col("_r") == lo, F.col("_v"))).alias(f"_{name}_lo"))
        aggs.append(F.max(F.when(F.col("_r") == hi, F.col("_v"))).alias(f"_{name}_hi"))
    per_group = hits.groupBy(*group_cols).agg(*aggs)
    out = [F.col(c) for c in group_cols]
    for name, _, _, _ in picks:
        q = probs[names.index(name)]
        h = (F.col("_n") - 1).cast("double") * F.lit(float(q))
        frac = h - F.floor(h)
        lo_v, hi_v = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo_v + frac * (hi_v - lo_v)).alias(name))
    return per_group.select(*out)
