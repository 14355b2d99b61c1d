"""Keyed rollups: filtered, conditional, ratio and pivot aggregates.

Every builder is one ``filter -> groupBy -> agg``: Spark plans a partial
(map-side) hash aggregate, one exchange on the group keys and a final
aggregate, so a hot key is combined on the map side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.functions.expr import col, count_when, flag_sum, sum_when


def keyed_rollup(df: DataFrame, keys: Sequence[str | Column], measures: Mapping[str, Column],
                 where: Column | None = None) -> DataFrame:
    """``SELECT keys, measures FROM df [WHERE where] GROUP BY keys``."""
    if where is not None:
        df = df.filter(where)
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def yearly_sum(df: DataFrame, code: Column, year: Column, amount: str | Column,
               where: Column | None = None, out: str = "total", code_name: str = "code",
               year_name: str = "year") -> DataFrame:
    """The reference's commonest shape: filtered SUM(amount) by (code, year)."""
    if where is not None:
        df = df.filter(where)
    return (df.select(code.alias(code_name), year.alias(year_name), col(amount).alias("_amount"))
            .groupBy(code_name, year_name).agg(F.sum("_amount").alias(out)))


def conditional_counts(category: str | Column, buckets: Mapping[str, Iterable[object]],
                       other: str | None = None, prefix: str = "", suffix: str = "") -> dict[str, Column]:
    """``COUNT(CASE WHEN cat IN bucket THEN 1 END)`` per bucket, optional NOT-IN "other"."""
    c = col(category)
    out = {f"{prefix}{name}{suffix}": count_when(c.isin(list(vals))) for name, vals in buckets.items()}
    if other is not None:
        every = [v for vals in buckets.values() for v in vals]
        out[f"{prefix}{other}{suffix}"] = count_when(~c.isin(every))
    return out


def conditional_sums(category: str | Column, buckets: Mapping[str, Iterable[object] | Column],
                     value: str | Column, other: str | None = None, prefix: str = "",
                     suffix: str = "", otherwise: object = 0) -> dict[str, Column]:
    """``SUM(CASE WHEN cat IN bucket THEN value ELSE 0 END)`` per bucket (a bucket may be a predicate)."""
    c = col(category) if category is not None else None
    out = {}
    every: list[object] = []
    for name, vals in buckets.items():
        if isinstance(vals, Column):
            cond = vals
        else:
            vals = list(vals)
            every.extend(vals)
            cond = c.isin(vals)
        out[f"{prefix}{name}{suffix}"] = sum_when(cond, value, otherwise)
    if other is not None:
        out[f"{prefix}{other}{suffix}"] = sum_when(~c.isin(every), value, otherwise)
    return out


def conditional_flags(conds: Mapping[str, Column]) -> dict[str, Column]:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` per named condition."""
    return {name: flag_sum(cond) for name, cond in conds.items()}


def max_pivot(df: DataFrame, keys: Sequence[str], name_col: str, value_col: str,
              names: Mapping[str, object], default: object | None = 0,
              where_in: bool = True) -> DataFrame:
    """Long -> wide by ``MAX(CASE WHEN name = X THEN value END)`` with COALESCE default.

    The value list is explicit, so there is no extra distinct-values job and the
    ``IN`` filter reaches the scan.
    """
    if where_in:
        df = df.filter(F.col(name_col).isin(list(names.values())))
    aggs = []
    for out_name, v in names.items():
        m = F.max(F.when(F.col(name_col) == F.lit(v), F.col(value_col)))
        if default is not None:
            m = F.coalesce(m, F.lit(default).cast("double"))
        aggs.append(m.alias(out_name))
    return df.groupBy(*keys).agg(*aggs)
