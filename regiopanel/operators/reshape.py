"""Row generators and reshaping: year replication, carry-forward, unpivot, set ops.

All generators are narrow ``explode`` steps on already-aggregated rows: no
cross join, no extra shuffle. Aggregation happens first wherever the result is
equal (a sum distributes over identical copies), so the shuffle moves one row
per key instead of one per key and year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replicate_years(df: DataFrame, first_year: int, last_year: int, year_name: str = "year") -> DataFrame:
    """Attach every year of ``[first_year, last_year]`` to each row (``FROM t, generate_series``)."""
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    return df.select(F.explode(years).alias(year_name), *df.columns)


def replicate_date_series(df: DataFrame, first_year: int, last_year: int,
                          year_name: str = "year") -> DataFrame:
    """Same, from a yearly date series: ``EXTRACT(YEAR FROM generate_series(date, date, '1 year'))``."""
    dates = F.sequence(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
                       F.make_date(F.lit(last_year), F.lit(1), F.lit(1)),
                       F.expr("INTERVAL 1 YEAR"))
    return (df.select(F.explode(dates).alias("_d"), *df.columns)
            .select(F.year("_d").alias(year_name), *df.columns))


def replicate_values(df: DataFrame, values: Sequence[int], name: str = "year") -> DataFrame:
    """``UNNEST(ARRAY[...])`` / ``LATERAL (VALUES ...)`` over a fixed list."""
    return df.select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name), *df.columns)


def carry_forward(df: DataFrame, year_col: str, last_observed: int, last_year: int) -> DataFrame:
    """Copy rows of the last observed year to every later year up to ``last_year``.

    One scan: a row of ``last_observed`` explodes into ``last_observed..last_year``;
    others pass through. A key with no row in ``last_observed`` gets no copy,
    exactly like the reference's UNION ALL of literal years.
    """
    y = F.col(year_col)
    years = F.when(y == F.lit(last_observed), F.sequence(F.lit(last_observed), F.lit(last_year))) \
        .otherwise(F.array(y))
    others = [c for c in df.columns if c != year_col]
    return df.select(*others, F.explode(years).alias(year_col)).select(*df.columns)


def unpivot_columns(df: DataFrame, keys: Sequence[str], value_by_label: Sequence[tuple[object, str]],
                    label_name: str = "year", value_name: str = "value") -> DataFrame:
    """Wide -> long with ``stack``; a label may reuse a column (the reference's missing-year fill).

    Nulls are kept, like PostgreSQL's parallel UNNEST.
    """
    parts = ", ".join(f"{_sql_lit(lbl)}, `{c}`" for lbl, c in value_by_label)
    expr = f"stack({len(value_by_label)}, {parts}) AS (`{label_name}`, `{value_name}`)"
    return df.select(*keys, F.expr(expr))


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """SQL ``UNION`` (distinct) by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def _sql_lit(v: object) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)
