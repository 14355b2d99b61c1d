"""Registry of named query builders and their independent DuckDB oracle SQL.

A builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
test tables. The oracle is a separately written SQL statement over the same
tables; it is omitted for fitted models and other non-SQL operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}
STAGE: dict[str, str] = {}


def register(name: str, sql: str | None = None, stage: str = "extract") -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        STAGE[name] = stage
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    from regiopanel.plans import extract, modelling, panel_q, stats_q  # noqa: F401
