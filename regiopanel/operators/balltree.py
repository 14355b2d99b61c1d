"""Nearest centre of every row by ball trees over the centres, shipped in bounded parts.

Centres are ranked by their id and taken in parts of a stated number of values.
Each part becomes a ball tree that is broadcast; rows pass by it where they
are (no key, no join, no shuffle of rows) and carry the best centre so far,
which prunes the next part: by the triangle inequality no centre of a ball can
be nearer than the ball's centre less its radius. So there is one method and
one result at every number of centres, and a row is a row whatever its id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from regiopanel.operators.ranking import group_rank
from regiopanel.session import materialize

#: k x d values of a part: 16 MB of doubles.
PART_VALUES = 2_000_000
LEAF = 32


class BallTree:
    """Balls of balls over rows of ``centres``; ``nearest`` takes what is known already and improves it."""

    def __init__(self, centres: np.ndarray, leaf: int = LEAF):
        self.points = np.ascontiguousarray(centres, np.float64)
        self.order = np.arange(len(centres))
        self.middle: list[np.ndarray] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.child: list[tuple[int, int] | None] = []
        self.computed = 0   # distances to centres taken so far
        if len(centres):
            self._build(0, len(centres), leaf)

    def _build(self, start: int, stop: int, leaf: int) -> int:
        own = self.points[self.order[start:stop]]
        middle = own.mean(axis=0)
        me = len(self.middle)
        self.middle.append(middle)
        self.radius.append(float(np.sqrt(((own - middle) ** 2).sum(axis=1)).max()))
        self.span.append((start, stop))
        self.child.append(None)
        spread = own.max(axis=0) - own.min(axis=0)
        if stop - start > leaf and spread.max() > 0:
            cut = (stop - start) // 2
            self.order[start:stop] = self.order[start:stop][np.argpartition(own[:, int(np.argmax(spread))], cut)]
            self.child[me] = (self._build(start, start + cut, leaf), self._build(start + cut, stop, leaf))
        return me

    def nearest(self, x: np.ndarray, best: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Improve squared distances ``best`` (inf: none yet) in place; returns positions of better centres, or -1.

        Of equally near centres the one first in ``points`` wins, and one known before wins over all: ``at`` is
        the answer so far, -1 where it comes from elsewhere.
        """
        stack = [(0, np.arange(len(x)))] if len(self.points) else []
        while stack:
            node, rows = stack.pop()
            gap = np.sqrt(((x[rows] - self.middle[node]) ** 2).sum(axis=1)) - self.radius[node]
            # A margin for rounding: a ball that may hold an equally near centre is looked at.
            rows = rows[gap <= np.sqrt(best[rows]) * (1 + 1e-9) + 1e-12 * (1 + self.radius[node])]
            if not len(rows):
                continue
            if self.child[node] is None:
                self._leaf(node, x, rows, best, at)
                continue
            a, b = self.child[node]
            near = ((x[rows] - self.middle[a]) ** 2).sum(axis=1) <= ((x[rows] - self.middle[b]) ** 2).sum(axis=1)
            # Each row visits the nearer ball first; pushed last is visited first.
            for first, second, side in ((b, a, rows[near]), (a, b, rows[~near])):
                if len(side):
                    stack += [(first, side), (second, side)]
        return at

    def _leaf(self, node: int, x: np.ndarray, rows: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        start, stop = self.span[node]
        ids = np.sort(self.order[start:stop])
        for s in range(0, len(ids), 256):
            some = ids[s:s + 256]
            # Summed dimension by dimension, so a distance has the same bits wherever it is taken.
            d2 = np.zeros((len(rows), len(some)))
            for k in range(x.shape[1]):
                d2 += (x[rows, k, None] - self.points[None, some, k]) ** 2
            self.computed += d2.size
            j = np.argmin(d2, axis=1)
            value, winner = d2[np.arange(len(rows)), j], some[j]
            better = (value < best[rows]) | ((value == best[rows]) & (at[rows] >= 0) & (winner < at[rows]))
            best[rows[better]], at[rows[better]] = value[better], winner[better]


def _vectors(col: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are complete vectors of length d (no null, no NaN), and their values."""
    lengths = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(lengths == d)
    flat = pc.list_flatten(col.take(pa.array(right, pa.int64())))
    x = pc.fill_null(flat, math.nan).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    whole = ~np.isnan(x).any(axis=1)
    return right[whole], x[whole]


def _pass(shared, feats: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, labels = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, x = _vectors(batch.column(feats), tree.points.shape[1])
            best = batch.column("_d2").fill_null(math.inf).to_numpy(zero_copy_only=False).copy()
            mine = best[rows]
            at = tree.nearest(x, mine, np.full(len(rows), -1, np.int64))
            best[rows] = mine
            take = np.full(batch.num_rows, -1, np.int64)
            take[rows] = at
            won = pa.array(take >= 0)
            label = pc.if_else(won, labels.take(pa.array(np.maximum(take, 0))), batch.column(out))
            d2 = pa.array(best, pa.float64(), mask=np.isinf(best))
            cols = {n: batch.column(n) for n in batch.schema.names}
            yield pa.RecordBatch.from_pydict(cols | {"_d2": d2, out: label})
    return run


def nearest_centre(points: DataFrame, feats: str, centres: DataFrame, cid: str, cfeats: str, out: str = "nearest",
                   dist_out: str | None = None, part_values: int = PART_VALUES) -> DataFrame:
    """``points`` with ``out``, the id of the nearest centre (Euclidean; of equally near ones the lower id).

    ``feats`` and ``cfeats`` are arrays of doubles. Rows whose vector is null,
    has another length or holds a null or NaN get a null, as do all rows when
    there are no centres; centres without an id or with an incomplete vector
    are ignored. ``dist_out`` adds the distance.
    """
    whole = F.col(cfeats).isNotNull() & ~F.exists(cfeats, lambda v: v.isNull() | F.isnan(v))
    usable = centres.filter(F.col(cid).isNotNull() & whole).select(F.col(cid).alias("cid"), F.col(cfeats).cast("array<double>").alias("c"))
    # Parts follow the order of the ids: a tie between parts goes to the one before, that is to the lower id.
    ranked = materialize(group_rank(usable, [], ["cid", "c"], rank_col="r"))
    size = ranked.agg(F.count(F.lit(1)).alias("k"), F.max(F.size("c")).alias("d"), F.min(F.size("c")).alias("least")).first()
    kind = centres.schema[cid].dataType
    state = points.withColumn(out, F.lit(None).cast(kind)).withColumn("_d2", F.lit(None).cast("double"))
    if size["k"]:
        if size["d"] != size["least"]:
            raise ValueError("centres of different lengths")
        each = max(1, part_values // max(1, size["d"]))
        sc = points.sparkSession.sparkContext
        for start in range(0, size["k"], each):
            part = ranked.filter((F.col("r") > start) & (F.col("r") <= start + each)).orderBy("r").select("cid", "c").toArrow()
            values = np.array(part.column("c").to_pylist(), np.float64).reshape(part.num_rows, -1)
            shared = sc.broadcast((BallTree(values), part.column("cid").combine_chunks()))
            schema = StructType([*points.schema.fields, StructField(out, kind), StructField("_d2", DoubleType())])
            state = state.mapInArrow(_pass(shared, feats, out), schema)
            if start + each < size["k"]:
                state = materialize(state)   # one part of the centres on a worker at a time
                shared.unpersist()
    if dist_out:
        state = state.withColumn(dist_out, F.sqrt("_d2"))
    return state.drop("_d2")
