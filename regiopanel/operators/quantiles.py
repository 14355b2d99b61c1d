"""Exact quantiles by refined histograms: bins are shuffled, rows are not.

Every double has a 64-bit integer key in the same order (its IEEE 754 bits). A
pass counts rows per group and leading bits of the key; the bin that holds a
wanted rank is split by further bits in the next pass, until the rank is the
least or greatest of its bin, all values of the bin are equal, or the bin has
few enough rows (``GATHER``) to be sorted. A pass is a partial aggregate in front
of a small exchange, whatever the size of a group; three always suffice and two
mostly do. Nothing but bins with a wanted rank is looked at again.

What the driver holds is bounded: a few numbers per group and probability, for
at most ``MAX_GROUPS`` groups. Beyond that many groups the sorted form
(:func:`regiopanel.operators.ranking.exact_percentiles`) gives the same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiopanel.operators.ranking import exact_percentiles

MAX_GROUPS = 20_000
#: Leading key bits after each pass; all 64 tell any two doubles apart.
BITS = (16, 36, 64)
#: A bin of so few rows is not refined but sorted.
GATHER = 1024


def with_key(df: DataFrame, value: str = "_v", out: str = "_k") -> DataFrame:
    """Adds a bigint in the order of the doubles: their IEEE 754 bits, negated for negative values.

    -0.0 counts as 0.0; infinities come last on their side and NaN (one value) after them, as Spark sorts them.
    """
    x, guess, e, m = (F.col(c) for c in ("_x", "_guess", "_e", "_m"))
    power = F.pow(F.lit(2.0), guess)
    fraction = F.lit(float(1 << 52))
    df = df.withColumn("_x", F.abs(F.col(value).cast("double"))).withColumn(
        "_guess", F.floor(F.least(F.log2(x), F.lit(1024.0))).cast("int"))
    # The logarithm may be off by one next to a power of two.
    df = df.withColumn("_e", F.greatest(guess + F.when(power > x, -1).when(power * 2 <= x, 1).otherwise(0), F.lit(-1022)))
    df = df.withColumn("_m", x / F.pow(F.lit(2.0), e))
    bits = (F.when(x == 0, F.lit(0).cast("bigint"))
            .when(F.isnan(x), F.lit(0x7FF8 << 48)).when(x == F.lit(math.inf), F.lit(0x7FF0 << 48))
            .when(m < 1, (m * fraction).cast("bigint"))
            .otherwise(F.shiftleft((e + 1023).cast("bigint"), 52) + ((m - 1) * fraction).cast("bigint")))
    df = df.withColumn("_bits", bits)
    return df.withColumn(out, F.when(F.col(value) < 0, -F.col("_bits")).otherwise(F.col("_bits"))).drop("_x", "_guess", "_e", "_m", "_bits")


def _in_bins(rows: DataFrame, group_cols: Sequence[str], used: int, wanted: DataFrame) -> DataFrame:
    """Rows whose first ``used`` key bits are a wanted bin of their group, which comes along as ``_prefix``."""
    carried = [c for c in wanted.columns if c not in group_cols and c != "_prefix"]
    w = wanted.select(*[F.col(c).alias(f"_w_{c}") for c in group_cols], F.col("_prefix").alias("_w"), *carried)
    on = (F.shiftright("_k", 64 - used) if "_k" in rows.columns else F.col("_prefix")) == F.col("_w")
    for c in group_cols:
        on = on & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    return rows.join(w, on).withColumn("_prefix", F.col("_w")).drop("_w", *[f"_w_{c}" for c in group_cols])


def histogram(rows: DataFrame, group_cols: Sequence[str], used: int, upto: int, wanted: DataFrame | None = None) -> DataFrame:
    """Rows per group and first ``upto`` bits of ``_k``: group, _prefix, _bin, _c, _lo, _hi.

    ``wanted`` (group, _prefix), a broadcast table, restricts the pass to bins of ``used`` bits to refine.
    """
    if wanted is None:
        rows = rows.withColumn("_prefix", F.lit(0).cast("bigint"))
    else:
        rows = _in_bins(rows, group_cols, used, wanted.select(*group_cols, "_prefix"))
    return rows.groupBy(*group_cols, "_prefix", F.shiftright("_k", 64 - upto).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))


def gathered(rows: DataFrame, group_cols: Sequence[str], used: int, wanted: DataFrame) -> DataFrame:
    """Values at the wanted ranks of bins of at most ``GATHER`` rows each: group, _ranks, _values."""
    own = _in_bins(rows, group_cols, used, wanted)
    per = own.groupBy(*group_cols, "_prefix").agg(F.sort_array(F.collect_list("_v")).alias("_all"),
                                                  F.first("_base").alias("_base"), F.first("_ranks").alias("_ranks"))
    return per.select(*group_cols, "_ranks", F.transform("_ranks", lambda r: F.get("_all", (r - F.col("_base")).cast("int"))).alias("_values"))


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    """Ranks (from 0) next to the quantile and its place between them."""
    h = (n - 1) * float(q)
    return math.floor(h), math.ceil(h), h - math.floor(h)


def _local(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A table of at most MAX_GROUPS times a few rows, hinted for broadcast (its size is checked by the caller)."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema).coalesce(1))


def _bins(df: DataFrame, keys: list[tuple], open_: dict, by_group: str) -> DataFrame:
    table = [(*g, prefix, *open_[g, prefix][:2]) for g, prefix in keys]
    return _local(df, table, ", ".join(filter(None, [by_group, "_prefix bigint, _base bigint, _ranks array<bigint>"])))


def percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str, probs: Sequence[float],
                names: Sequence[str] | None = None, max_groups: int = MAX_GROUPS) -> DataFrame:
    """Exact percentiles with linear interpolation by group, one row per group with a value and one column each.

    Nulls are ignored, NaN is the greatest value, an empty table gives an empty
    result. ``df`` is read once a pass: hand in a table or something as cheap.
    """
    group_cols = list(group_cols)
    names = list(names or [f"p{int(round(q * 100))}" for q in probs])
    rows = with_key(df.select(*group_cols, (F.col(value_col).cast("double") + F.lit(0.0)).alias("_v")).filter(F.col("_v").isNotNull()))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    by_group = ", ".join([f"`{c}` {kinds[c]}" for c in group_cols])
    sizes: dict[tuple, int] = {}
    values: dict[tuple, float] = {}                              # (group, rank) -> value
    open_: dict[tuple, tuple[int, list[int], int]] = {}          # (group, bin) -> rows before it, wanted ranks, rows
    bound = max_groups * 2 * len(probs)
    for used, upto in zip((0, *BITS), BITS):
        small = [k for k, (_, _, c) in open_.items() if c <= GATHER]
        if small:
            for r in gathered(rows, group_cols, used, _bins(df, small, open_, by_group)).collect():
                g = tuple(r[c] for c in group_cols)
                values.update({(g, rank): v for rank, v in zip(r["_ranks"], r["_values"])})
        large = [k for k, (_, _, c) in open_.items() if c > GATHER]
        if used and not large:
            break
        if used:
            wanted = _bins(df, large, open_, by_group)
            hist = _in_bins(histogram(rows, group_cols, used, upto, wanted), group_cols, used, wanted).withColumn("_n", F.lit(0))
        else:
            hist = histogram(rows, group_cols, 0, upto).withColumn("_n", F.sum("_c").over(Window.partitionBy(*group_cols, "_prefix")))
            h = [(F.col("_n") - 1).cast("double") * F.lit(float(q)) for q in probs]
            ranks = F.array_distinct(F.array(*[f(x).cast("bigint") for x in h for f in (F.floor, F.ceil)]))
            hist = hist.withColumn("_base", F.lit(0).cast("bigint")).withColumn("_ranks", ranks)
        run = Window.partitionBy(*group_cols, "_prefix").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("_end", F.col("_base") + F.sum("_c").over(run)).withColumn("_begin", F.col("_end") - F.col("_c"))
        hit = F.filter("_ranks", lambda r: (r >= F.col("_begin")) & (r < F.col("_end")))
        hits = hist.withColumn("_hit", hit).filter(F.size("_hit") > 0)
        found = hits.select(*group_cols, "_bin", "_begin", "_end", "_lo", "_hi", "_n", "_hit").repartition(1).limit(bound + 1).collect()
        if used == 0:
            sizes = {tuple(r[c] for c in group_cols): r["_n"] for r in found}
            if len(sizes) > max_groups or len(found) > bound:
                return exact_percentiles(df, group_cols, value_col, probs, names)
        open_ = {}
        for r in found:
            g, left = tuple(r[c] for c in group_cols), []
            for rank in r["_hit"]:
                if r["_lo"] == r["_hi"] or rank == r["_begin"]:
                    values[g, rank] = r["_lo"]
                elif rank == r["_end"] - 1:
                    values[g, rank] = r["_hi"]
                else:
                    left.append(rank)
            if left:
                open_[g, r["_bin"]] = (r["_begin"], left, r["_end"] - r["_begin"])
        if not open_:
            break
    out = []
    for g, n in sizes.items():
        row = []
        for q in probs:
            lo, hi, part = _ranks(n, q)
            a, b = values[g, lo], values[g, hi]
            row.append(a if a == b else a + part * (b - a))
        out.append((*g, *row))
    schema = ", ".join(filter(None, [by_group, ", ".join(f"`{c}` double" for c in names)]))
    return _local(df, out, schema)
