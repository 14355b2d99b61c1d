"""Table statistics: z-scores, grouped descriptions, box-plot numbers, frequencies.

Wide aggregates are computed in one pass and reshaped afterwards (aggregate
first, then ``stack``), so the shuffle carries one row per group, not one per
group and variable. Medians and quartiles are exact and come from histograms
refined around the wanted ranks (:mod:`regiopanel.operators.quantiles`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiopanel.operators.quantiles import percentiles


def _stack(df: DataFrame, keys: Sequence[str], cols_by_label: Sequence[tuple[str, Sequence[str]]],
           label: str, values: Sequence[str]) -> DataFrame:
    """Wide -> long: one row per label, value columns taken from the listed columns."""
    parts = ", ".join(
        "'" + lbl + "', " + ", ".join(f"`{c}`" for c in cols) for lbl, cols in cols_by_label)
    names = ", ".join([label, *values])
    return df.select(*keys, F.expr(f"stack({len(cols_by_label)}, {parts}) AS ({names})"))


def column_moments(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column from ONE aggregation (a 2 x d result)."""
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(features)]).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(features)}


def zscore(df: DataFrame, features: Sequence[str], moments: dict | None = None) -> DataFrame:
    """``(x - mean) / std_pop`` per column; a zero-variance column becomes 0.

    The fitted moments (2 numbers per column) are the only thing that reaches
    the driver; they are applied as literals in a narrow projection.
    """
    moments = moments or column_moments(df, features)
    out = []
    for c in df.columns:
        if c in features:
            m, s = moments[c]
            if s is None or s == 0.0:
                out.append(F.lit(0.0).alias(c))
            else:
                out.append(((F.col(c) - F.lit(m)) / F.lit(s)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def to_long(df: DataFrame, keys: Sequence[str], features: Sequence[str],
            variable: str = "variable", value: str = "value") -> DataFrame:
    return _stack(df, keys, [(c, [c]) for c in features], variable, [value])


def group_describe(df: DataFrame, group: str, features: Sequence[str]) -> DataFrame:
    """Mean, exact median and sample std (ddof=1, null for one row) per group and variable."""
    wide = df.groupBy(group).agg(*[F.avg(c).alias(f"{c}__mean") for c in features],
                                 *[F.stddev_samp(c).alias(f"{c}__std") for c in features])
    moments = _stack(wide, [group], [(c, [f"{c}__mean", f"{c}__std"]) for c in features],
                     "variable", ["mean", "std"])
    medians = percentiles(to_long(df, [group], features), [group, "variable"], "value", [0.5], names=["median"])
    return moments.join(medians, [group, "variable"], "inner").select(
        group, "variable", "mean", "median", "std")


def boxplot_stats(df: DataFrame, group: str, features: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Numbers of a box plot per group and variable.

    Quartiles with linear interpolation; whiskers are the most extreme values
    inside ``[q1 - 1.5 iqr, q3 + 1.5 iqr]``; outliers are counted.
    """
    long = to_long(df, [group], features)
    q = percentiles(long, [group, "variable"], "value", [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - F.lit(whisker) * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + F.lit(whisker) * F.col("iqr"))
    # One row per group and variable, broadcast while its checked size allows: rows meet their fences in place.
    joined = long.join(q.select(group, "variable", "lo_fence", "hi_fence"), [group, "variable"], "inner")
    v = F.col("value")
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    whiskers = joined.groupBy(group, "variable").agg(
        F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(v).alias("n"),
    )
    return q.join(whiskers, [group, "variable"], "inner").select(
        group, "variable", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "n_outliers", "n")


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def feature_variances(df: DataFrame, features: Sequence[str], ddof: int = 0) -> DataFrame:
    """One row per feature with its variance (population by default), from one pass."""
    fn = F.var_pop if ddof == 0 else F.var_samp
    wide = df.agg(*[fn(c).alias(c) for c in features])
    return to_long(wide, [], features, "feature", "variance")


def top_k(df: DataFrame, order_col: str, k: int, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Top k rows by a value, descending (plans as TakeOrderedAndProject)."""
    return df.orderBy(F.col(order_col).desc(), *[F.col(c) for c in tie_cols]).limit(k)


def running_share(df: DataFrame, value_col: str, order_cols: Sequence, share_col: str = "share",
                  cum_col: str = "cum_share") -> DataFrame:
    """Share of the total and running total in the given order.

    For small, bounded tables (one row per component or feature): the window
    has no partition key, so it runs in one task by design.
    """
    total = Window.partitionBy()
    running = Window.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn(share_col, F.col(value_col) / F.sum(value_col).over(total))
              .withColumn(cum_col, F.sum(share_col).over(running)))
