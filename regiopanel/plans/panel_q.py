"""Integration-stage queries: wide panel, source and column profiles, CSV, export."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiopanel.functions.expr import padded_code, year_range_filter
from regiopanel.operators.panel import column_profile, merge_panel, rename_columns, source_profile
from regiopanel.operators.rollup import yearly_sum
from regiopanel.plans.fixtures import FIRST_YEAR, LAST_YEAR, tables
from regiopanel.plans import extract  # noqa: F401  (the exported queries)
from regiopanel.plans.registry import ORACLE, QUERIES, STAGE, register
from regiopanel.plans.sqlfrag import code_sql
from regiopanel.session import materialize, remove_scratch, scratch_path
from regiopanel.sources.csv_io import read_csv, schema_of, write_csv
from regiopanel.sources.export import run_export

CODE_SQL = code_sql("l_suppkey")
YEAR_SQL = "CAST(year(l_shipdate) AS INTEGER)"
PERIOD_SQL = "year(l_shipdate) BETWEEN 1996 AND 2000"

PANEL_SOURCES_SQL = f"""
a AS (SELECT {CODE_SQL} AS code, {YEAR_SQL} AS year, SUM(l_quantity) AS qty_all
      FROM lineitem WHERE {PERIOD_SQL} GROUP BY 1, 2),
b AS (SELECT {CODE_SQL} AS code, {YEAR_SQL} AS year, SUM(l_quantity) AS qty_r
      FROM lineitem WHERE l_returnflag = 'R' AND {PERIOD_SQL} GROUP BY 1, 2),
c AS (SELECT {code_sql("o_custkey")} AS code, CAST(year(o_orderdate) AS INTEGER) AS year,
             COUNT(*) AS n_orders
      FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1, 2),
d AS (SELECT {CODE_SQL} AS code, {YEAR_SQL} AS year, COUNT(*) AS n_sparse
      FROM lineitem WHERE l_quantity = 50 AND l_discount >= 0.09 AND {PERIOD_SQL} GROUP BY 1, 2)
"""


# Per-source rename map to the panel vocabulary (the reference keeps
# one such map per source because each names its code and year columns differently).
RENAME = {
    "orders": {"region_code": "code", "anio": "year", "conteo": "n_orders"},
    "sparse": {"cod_mpio": "code", "year_of_incident": "year"},
}


def panel_sources(spark, sf_dir):
    """Four (code, year) sources of different density, each unique on its keys."""
    t = tables(spark, sf_dir)
    li = t["lineitem"].filter(year_range_filter("l_shipdate", FIRST_YEAR, LAST_YEAR))
    code, year = padded_code("l_suppkey"), F.year("l_shipdate")
    od = t["orders"].filter(year_range_filter("o_orderdate", FIRST_YEAR, LAST_YEAR))
    return {
        "qty_all": yearly_sum(li, code, year, "l_quantity", out="qty_all"),
        "qty_r": yearly_sum(li, code, year, "l_quantity", where=F.col("l_returnflag") == "R", out="qty_r"),
        "orders": rename_columns(
            od.groupBy(padded_code("o_custkey").alias("region_code"), F.year("o_orderdate").alias("anio"))
              .agg(F.count(F.lit(1)).alias("conteo")), RENAME["orders"]),
        "sparse": rename_columns(
            li.filter((F.col("l_quantity") == 50) & (F.col("l_discount") >= 0.09))
              .groupBy(code.alias("cod_mpio"), year.alias("year_of_incident"))
              .agg(F.count(F.lit(1)).alias("n_sparse")), RENAME["sparse"]),
    }


@register("panel_full_outer", stage="panel", sql=f"""
WITH {PANEL_SOURCES_SQL}
SELECT code, year, qty_all, qty_r, CAST(n_orders AS DOUBLE) AS n_orders, CAST(n_sparse AS DOUBLE) AS n_sparse
FROM a FULL OUTER JOIN b USING (code, year)
       FULL OUTER JOIN c USING (code, year)
       FULL OUTER JOIN d USING (code, year)
""")
def q_panel_full_outer(spark, sf_dir):
    return merge_panel(panel_sources(spark, sf_dir), keys=("code", "year"))


@register("source_profile", stage="panel", sql=f"""
WITH {PANEL_SOURCES_SQL}
SELECT 'qty_all' AS source, COUNT(*) AS n_rows, COUNT(DISTINCT code) AS n_codes, COUNT(DISTINCT year) AS n_years,
       COUNT(*) FILTER (WHERE code IS NULL OR year IS NULL) AS n_null_keys FROM a
UNION ALL SELECT 'qty_r', COUNT(*), COUNT(DISTINCT code), COUNT(DISTINCT year),
       COUNT(*) FILTER (WHERE code IS NULL OR year IS NULL) FROM b
UNION ALL SELECT 'orders', COUNT(*), COUNT(DISTINCT code), COUNT(DISTINCT year),
       COUNT(*) FILTER (WHERE code IS NULL OR year IS NULL) FROM c
UNION ALL SELECT 'sparse', COUNT(*), COUNT(DISTINCT code), COUNT(DISTINCT year),
       COUNT(*) FILTER (WHERE code IS NULL OR year IS NULL) FROM d
""")
def q_source_profile(spark, sf_dir):
    return source_profile(panel_sources(spark, sf_dir))


# The `events` schema as Spark names its types.
_EVENTS_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
                 ("event_type", "string"), ("value", "double"), ("props", "string")]


@register("column_profile", stage="panel", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {i + 1} AS position, '{t}' AS data_type, COUNT({c}) AS non_null, "
    f"COUNT(*) AS n_rows FROM events" for i, (c, t) in enumerate(_EVENTS_TYPES)))
def q_column_profile(spark, sf_dir):
    return column_profile(tables(spark, sf_dir)["events"])


@register("csv_roundtrip", stage="panel", sql=f"""
SELECT {CODE_SQL} AS code, {YEAR_SQL} AS year, SUM(l_quantity) AS total_qty
FROM lineitem WHERE {PERIOD_SQL}
GROUP BY 1, 2
""")
def q_csv_roundtrip(spark, sf_dir):
    li = tables(spark, sf_dir)["lineitem"].filter(year_range_filter("l_shipdate", FIRST_YEAR, LAST_YEAR))
    rollup = yearly_sum(li, padded_code("l_suppkey"), F.year("l_shipdate"), "l_quantity", out="total_qty")
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(rollup, path)
    # Declared schema on read: codes keep their leading zeros, years stay int.
    back = materialize(read_csv(spark, path, schema_of(rollup)))
    remove_scratch(spark, path)
    return back


EXPORT_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS name, TRUE AS ok, COUNT(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM ({ORACLE[n]}) AS q_{n}"
    for n in QUERIES if STAGE[n] == "extract")


@register("export_status", stage="panel", sql=EXPORT_SQL)
def q_export_status(spark, sf_dir):
    builders = {n: (lambda fn=fn: fn(spark, sf_dir)) for n, fn in QUERIES.items() if STAGE[n] == "extract"}
    # Every result is exported ordered by its leading key columns, like the reference's ORDER BY.
    keys = {n: [c for c in ("code", "code_prefix", "custkey", "nationkey", "user_id", "year")]
            for n in builders}
    root = scratch_path(spark, "export")
    status = run_export(spark, builders, root, sort_keys=keys, sort_keys_present_only=True).drop("path", "seconds", "skipped")
    remove_scratch(spark, root)
    return status
