"""Column-expression helpers (all JVM-side, codegen-friendly).

These are the scalar building blocks of the rollup queries: guarded ratios,
conditional counts and sums, category recoding and key derivation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(num: str | Column, den: str | Column, scale: float | None = None) -> Column:
    """``num / NULLIF(den, 0)`` as double; null when the denominator is 0 or null.

    ``try_divide`` keeps ANSI mode on for everything else.
    """
    n = col(num).cast("double")
    if scale is not None:
        n = n * F.lit(float(scale))
    return F.try_divide(n, col(den).cast("double"))


def count_when(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)``: rows where cond is true (null -> not counted)."""
    return F.count(F.when(cond, F.lit(1)))


def sum_when(cond: Column, value: str | Column, otherwise: object = 0) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE otherwise END)``."""
    expr = F.when(cond, col(value))
    if otherwise is not None:
        expr = expr.otherwise(F.lit(otherwise))
    return F.sum(expr)


def flag_sum(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def recode(c: str | Column, groups: Mapping[str, Iterable[object]], default: object = None) -> Column:
    """Map many category values to one group name (searched CASE over IN lists)."""
    expr = None
    for name, members in groups.items():
        cond = col(c).isin(list(members))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def not_in_any(c: str | Column, groups: Mapping[str, Iterable[object]]) -> Column:
    """The "other" bucket: value in none of the listed groups (null stays unknown)."""
    members = [m for ms in groups.values() for m in ms]
    return ~col(c).isin(members)


def padded_code(c: str | Column, width: int = 5) -> Column:
    """Text code of at least ``width`` characters, left-padded with zeros; longer keys stay whole."""
    s = col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def padded_code_prefix_range(prefix: str, width: int = 5) -> tuple[int, int] | None:
    """Integer key range whose zero-padded code starts with ``prefix``.

    ``padded_code(k) LIKE prefix || '%'`` holds exactly for ``lo <= k <= hi``
    with non-negative keys (keys of more than ``width`` digits never start with
    '0'; negative keys contain '-'). Returned so the filter can also reach the
    Parquet scan as a range on the raw key, which row-group statistics can
    prune. Returns None when the prefix does not start with '0' (then long keys
    could also match).
    """
    if not prefix or not prefix.isdigit() or len(prefix) > width or prefix[0] != "0":
        return None
    rest = width - len(prefix)
    lo = int(prefix) * (10 ** rest)
    hi = lo + 10 ** rest - 1
    return lo, hi


def code_prefix_filter(key: str, prefix: str, width: int = 5) -> Column:
    """``padded_code(key) LIKE 'prefix%'`` plus the equivalent raw-key range for pushdown."""
    cond = padded_code(key, width).startswith(prefix)
    rng = padded_code_prefix_range(prefix, width)
    if rng is not None:
        cond = col(key).between(rng[0], rng[1]) & cond
    return cond


def year_of(ts: str | Column) -> Column:
    return F.year(col(ts))


def year_range_filter(ts: str | Column, first_year: int, last_year: int, ntz: bool = True) -> Column:
    """``year(ts) BETWEEN a AND b`` written on the raw column so Parquet can prune."""
    # String literals cast on the JVM side: no driver time-zone conversion.
    lo = F.lit(f"{first_year:04d}-01-01 00:00:00")
    hi = F.lit(f"{last_year + 1:04d}-01-01 00:00:00")
    kind = "timestamp_ntz" if ntz else "timestamp"
    return (col(ts) >= lo.cast(kind)) & (col(ts) < hi.cast(kind))


def rounded(c: str | Column, digits: int = 6) -> Column:
    return F.round(col(c).cast("double"), digits)
