"""Extract-stage queries: the reference's SQL rollup shapes on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiopanel.functions.expr import (code_prefix_filter, count_when, flag_sum, guarded_ratio,
                                       padded_code, recode, rounded, year_range_filter)
from regiopanel.operators.reshape import (carry_forward, replicate_date_series, replicate_values,
                                          replicate_years, union_distinct, unpivot_columns)
from regiopanel.operators.rollup import (conditional_counts, conditional_flags, conditional_sums,
                                         keyed_rollup, max_pivot, yearly_sum)
from regiopanel.plans.fixtures import (CODE_PREFIX, FIRST_YEAR, LAST_YEAR, lineitem_keyed,
                                       tables)
from regiopanel.plans.registry import register
from regiopanel.plans.sqlfrag import code_sql

CODE_SQL = code_sql("l_suppkey")
YEAR_SQL = "CAST(year(l_shipdate) AS INTEGER)"
PERIOD_SQL = "year(l_shipdate) BETWEEN 1996 AND 2000"

# Returnflag x linestatus pairs of the test data.
FLAG_STATUS = [("a", "f"), ("a", "o"), ("n", "f"), ("n", "o"), ("r", "f"), ("r", "o")]
# Order-priority buckets (the reference's crime-group buckets).
PRIORITY_BUCKETS = {"n_urgent": ["1-URGENT"], "n_high": ["2-HIGH"], "n_medium_low": ["3-MEDIUM", "5-LOW"]}
# Part-type recode (many categories to one group; the rest is dropped).
PART_GROUPS = {"a": ["SMALL", "MEDIUM"], "b": ["LARGE"], "c": ["PROMO"]}
# Return flags pivoted by the joins.
FLAGS = ["r", "a", "n"]


@register("yearly_sum", sql=f"""
SELECT {CODE_SQL} AS code, {YEAR_SQL} AS year, SUM(l_quantity) AS total_qty
FROM lineitem
WHERE {CODE_SQL} LIKE '0000%' AND {PERIOD_SQL}
GROUP BY 1, 2
""")
def q_yearly_sum(spark, sf_dir):
    li = tables(spark, sf_dir)["lineitem"]
    where = code_prefix_filter("l_suppkey", CODE_PREFIX) & year_range_filter("l_shipdate", FIRST_YEAR, LAST_YEAR)
    return yearly_sum(li, padded_code("l_suppkey"), F.year("l_shipdate"), "l_quantity", where,
                      out="total_qty")


@register("yearly_count", sql=f"""
SELECT {CODE_SQL} AS code, {YEAR_SQL} AS year, COUNT(*) AS n_rows, COUNT(l_orderkey) AS n_with_order
FROM lineitem WHERE {PERIOD_SQL}
GROUP BY 1, 2
""")
def q_yearly_count(spark, sf_dir):
    li = lineitem_keyed(spark, sf_dir)
    return keyed_rollup(li, ["code", "year"], {"n_rows": F.count(F.lit(1)),
                                               "n_with_order": F.count("l_orderkey")})


@register("multi_measure", sql=f"""
SELECT {CODE_SQL} AS code, {YEAR_SQL} AS year, SUM(l_quantity) AS total_qty,
       ROUND(AVG(l_extendedprice), 6) AS avg_price, ROUND(AVG(l_discount), 6) AS avg_discount,
       ROUND(AVG(l_tax), 6) AS avg_tax
FROM lineitem WHERE {PERIOD_SQL}
GROUP BY 1, 2
""")
def q_multi_measure(spark, sf_dir):
    li = lineitem_keyed(spark, sf_dir)
    out = keyed_rollup(li, ["code", "year"], {
        "total_qty": F.sum("l_quantity"), "avg_price": F.avg("l_extendedprice"),
        "avg_discount": F.avg("l_discount"), "avg_tax": F.avg("l_tax")})
    return out.select("code", "year", "total_qty", *[rounded(c).alias(c) for c in
                                                     ("avg_price", "avg_discount", "avg_tax")])


@register("cond_count_pivot", sql="""
SELECT o_custkey AS custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       COUNT(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS n_urgent,
       COUNT(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 END) AS n_high,
       COUNT(CASE WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 1 END) AS n_medium_low,
       COUNT(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') THEN 1 END) AS n_other
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000
GROUP BY 1, 2
""")
def q_cond_count_pivot(spark, sf_dir):
    od = tables(spark, sf_dir)["orders"].filter(year_range_filter("o_orderdate", FIRST_YEAR, LAST_YEAR))
    measures = conditional_counts("o_orderpriority", PRIORITY_BUCKETS, other="n_other")
    return keyed_rollup(od, [F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year")],
                        measures)


@register("cond_sum_pivot", sql=f"""
SELECT {CODE_SQL} AS code, {YEAR_SQL} AS year,
""" + ",\n".join(
    f"       SUM(CASE WHEN l_returnflag = '{f.upper()}' AND l_linestatus = '{s.upper()}' "
    f"THEN l_quantity ELSE 0 END) AS qty_{f}_{s}" for f, s in FLAG_STATUS) + f""",
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned,
       CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_open
FROM lineitem WHERE {PERIOD_SQL}
GROUP BY 1, 2
""")
def q_cond_sum_pivot(spark, sf_dir):
    li = lineitem_keyed(spark, sf_dir)
    buckets = {f"qty_{f}_{s}": (F.col("l_returnflag") == f.upper()) & (F.col("l_linestatus") == s.upper())
               for f, s in FLAG_STATUS}
    # Value sums and 1/0 flag sums (the reference's two conditional-sum pivot forms) in one pass.
    flags = conditional_flags({"n_returned": F.col("l_returnflag") == "R", "n_open": F.col("l_linestatus") == "O"})
    return keyed_rollup(li, ["code", "year"], {**conditional_sums(None, buckets, "l_quantity"), **flags})


@register("recode_then_pivot", sql=f"""
WITH p AS (
  SELECT p_partkey,
         CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'a' WHEN p_type = 'LARGE' THEN 'b'
              WHEN p_type = 'PROMO' THEN 'c' END AS grp
  FROM part)
SELECT {YEAR_SQL} AS year,
       SUM(CASE WHEN grp = 'a' THEN l_quantity ELSE 0 END) AS qty_a,
       SUM(CASE WHEN grp = 'b' THEN l_quantity ELSE 0 END) AS qty_b,
       SUM(CASE WHEN grp = 'c' THEN l_quantity ELSE 0 END) AS qty_c
FROM lineitem JOIN p ON l_partkey = p_partkey
WHERE grp IS NOT NULL AND {PERIOD_SQL}
GROUP BY 1
""")
def q_recode_then_pivot(spark, sf_dir):
    part = tables(spark, sf_dir)["part"]
    # Recode on the dimension side and drop unmapped types before the join.
    groups = (part.select("p_partkey", recode("p_type", PART_GROUPS).alias("grp"))
              .filter(F.col("grp").isNotNull()))
    li = tables(spark, sf_dir)["lineitem"].filter(year_range_filter("l_shipdate", FIRST_YEAR, LAST_YEAR))
    joined = li.join(groups, li.l_partkey == groups.p_partkey, "inner")
    buckets = {f"qty_{g}": F.col("grp") == g for g in PART_GROUPS}
    return keyed_rollup(joined, [F.year("l_shipdate").alias("year")],
                        conditional_sums(None, buckets, "l_quantity"))


@register("guarded_ratio", sql="""
SELECT c_nationkey AS nationkey,
       ROUND(100.0 * COUNT(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END)
             / NULLIF(COUNT(CASE WHEN c_mktsegment <> 'FURNITURE' THEN 1 END), 0), 6) AS building_rate
FROM customer GROUP BY 1
""")
def q_guarded_ratio(spark, sf_dir):
    cu = tables(spark, sf_dir)["customer"]
    rate = guarded_ratio(count_when(F.col("c_mktsegment") == "BUILDING"),
                         count_when(F.col("c_mktsegment") != "FURNITURE"), scale=100.0)
    return keyed_rollup(cu, [F.col("c_nationkey").alias("nationkey")], {"building_rate": F.round(rate, 6)})


@register("share_ratio", sql=f"""
SELECT {CODE_SQL} AS code,
       ROUND(CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE)
             / NULLIF(COUNT(CASE WHEN l_returnflag IN ('R', 'A') THEN 1 END), 0), 6) AS share_r
FROM lineitem GROUP BY 1
""")
def q_share_ratio(spark, sf_dir):
    li = lineitem_keyed(spark, sf_dir, period=False)
    share = guarded_ratio(flag_sum(F.col("l_returnflag") == "R"),
                          count_when(F.col("l_returnflag").isin("R", "A")))
    return keyed_rollup(li, ["code"], {"share_r": F.round(share, 6)})


@register("avg_of_ratio", sql=f"""
SELECT {CODE_SQL} AS code, ROUND(AVG(l_tax / NULLIF(l_discount, 0)), 6) AS avg_tax_per_discount
FROM lineitem GROUP BY 1
""")
def q_avg_of_ratio(spark, sf_dir):
    li = lineitem_keyed(spark, sf_dir, period=False)
    return keyed_rollup(li, ["code"], {
        "avg_tax_per_discount": F.round(F.avg(guarded_ratio("l_tax", "l_discount")), 6)})


@register("max_pivot_coalesce", sql="""
SELECT user_id,
       COALESCE(MAX(CASE WHEN event_type = 'click' THEN value END), 0) AS max_click,
       COALESCE(MAX(CASE WHEN event_type = 'purchase' THEN value END), 0) AS max_purchase,
       COALESCE(MAX(CASE WHEN event_type = 'view' THEN value END), 0) AS max_view
FROM events WHERE event_type IN ('click', 'purchase', 'view')
GROUP BY 1
""")
def q_max_pivot_coalesce(spark, sf_dir):
    ev = tables(spark, sf_dir)["events"]
    return max_pivot(ev, ["user_id"], "event_type", "value",
                     {"max_click": "click", "max_purchase": "purchase", "max_view": "view"}, default=0)


@register("group_by_prefix", sql=f"""
WITH g AS (
  SELECT left({CODE_SQL}, 4) AS code_prefix, COUNT(*) AS n_rows, SUM(l_quantity) AS total_qty,
         ROUND(SUM(l_extendedprice), 6) AS total_price
  FROM lineitem GROUP BY 1)
SELECT code_prefix, CAST(y.year AS INTEGER) AS year, n_rows, total_qty, total_price
FROM g, LATERAL (VALUES (1996), (1997), (1998), (1999), (2000)) y(year)
""")
def q_group_by_prefix(spark, sf_dir):
    li = tables(spark, sf_dir)["lineitem"]
    out = keyed_rollup(li, [F.left(padded_code("l_suppkey"), F.lit(4)).alias("code_prefix")], {
        "n_rows": F.count(F.lit(1)), "total_qty": F.sum("l_quantity"),
        "total_price": F.sum("l_extendedprice")})
    out = out.withColumn("total_price", rounded("total_price"))
    # The static total is repeated for each study year (the reference's LATERAL VALUES list).
    years = replicate_values(out, list(range(FIRST_YEAR, LAST_YEAR + 1)), "year")
    return years.select("code_prefix", "year", "n_rows", "total_qty", "total_price")


def _asia_suppliers(spark, sf_dir, name=None):
    """Keys of the suppliers of one region, with the nation's name as column ``name`` if one is given."""
    t = tables(spark, sf_dir)
    asia = t["region"].filter(F.col("r_name") == "ASIA").select("r_regionkey")
    nations = t["nation"].join(asia, t["nation"].n_regionkey == asia.r_regionkey, "left_semi")
    if name:
        return t["supplier"].join(nations, F.col("s_nationkey") == nations.n_nationkey) \
            .select("s_suppkey", F.col("n_name").alias(name))
    return t["supplier"].join(nations, F.col("s_nationkey") == nations.n_nationkey, "left_semi") \
        .select("s_suppkey")


@register("dim_join_rollup", sql=f"""
SELECT {code_sql("s.s_suppkey")} AS code, n.n_name AS nation, {YEAR_SQL} AS year,
       SUM(l_quantity) AS total_qty
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = 'ASIA' AND {PERIOD_SQL}
GROUP BY 1, 2, 3
""")
def q_dim_join_rollup(spark, sf_dir):
    li = tables(spark, sf_dir)["lineitem"].filter(year_range_filter("l_shipdate", FIRST_YEAR, LAST_YEAR))
    # Pre-aggregate the fact on (join key, year): the join then sees one row per
    # supplier and year, and the dimension chain brings the nation's name along.
    pre = li.groupBy("l_suppkey", F.year("l_shipdate").alias("year")) \
        .agg(F.sum("l_quantity").alias("total_qty"))
    sup = _asia_suppliers(spark, sf_dir, name="nation")
    out = pre.join(sup, pre.l_suppkey == sup.s_suppkey, "inner")
    return out.select(padded_code("l_suppkey").alias("code"), "nation", "year", "total_qty")


@register("dim_join_cond_sum", sql=f"""
SELECT s.s_nationkey AS nationkey, {YEAR_SQL} AS year,
       SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS qty_r,
       SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS qty_a,
       SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS qty_n
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE {PERIOD_SQL}
GROUP BY 1, 2
""")
def q_dim_join_cond_sum(spark, sf_dir):
    t = tables(spark, sf_dir)
    li = t["lineitem"].filter(year_range_filter("l_shipdate", FIRST_YEAR, LAST_YEAR))
    sums = conditional_sums("l_returnflag", {f"qty_{f}": [f.upper()] for f in FLAGS}, "l_quantity")
    # Partial rollup by supplier first (sum distributes), then join, then roll up to nation.
    pre = li.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        *[m.alias(n) for n, m in sums.items()])
    sup = t["supplier"].select("s_suppkey", "s_nationkey")
    joined = pre.join(sup, pre.l_suppkey == sup.s_suppkey, "inner")
    return joined.groupBy(F.col("s_nationkey").alias("nationkey"), "year").agg(
        *[F.sum(n).alias(n) for n in sums])


@register("semi_join_rollup", sql=f"""
WITH by_flag AS (
  SELECT {CODE_SQL} AS code, l_returnflag AS flag, SUM(l_quantity) AS total
  FROM lineitem
  WHERE l_suppkey IN (SELECT s_suppkey FROM supplier s
                      JOIN nation n ON s.s_nationkey = n.n_nationkey
                      JOIN region r ON n.n_regionkey = r.r_regionkey
                      WHERE r.r_name = 'ASIA')
  GROUP BY 1, 2)
SELECT code,
       SUM(CASE WHEN flag = 'R' THEN total ELSE 0 END) AS qty_r,
       SUM(CASE WHEN flag = 'A' THEN total ELSE 0 END) AS qty_a,
       SUM(CASE WHEN flag = 'N' THEN total ELSE 0 END) AS qty_n
FROM by_flag GROUP BY 1
""")
def q_semi_join_rollup(spark, sf_dir):
    li = tables(spark, sf_dir)["lineitem"]
    sup = _asia_suppliers(spark, sf_dir)
    kept = li.join(sup, li.l_suppkey == sup.s_suppkey, "left_semi")
    # The reference's two-level aggregate (by code and flag, then pivot) merged
    # into one: a sum of per-flag sums is the per-flag sum.
    sums = conditional_sums("l_returnflag", {f"qty_{f}": [f.upper()] for f in FLAGS}, "l_quantity")
    return keyed_rollup(kept, [padded_code("l_suppkey").alias("code")], sums)


@register("preagg_join", sql="""
WITH c AS (SELECT c_nationkey AS nationkey, COUNT(*) AS n_customers FROM customer GROUP BY 1),
     s AS (SELECT s_nationkey AS nationkey, COUNT(*) AS n_suppliers FROM supplier GROUP BY 1)
SELECT nationkey, n_customers, n_suppliers FROM c JOIN s USING (nationkey)
""")
def q_preagg_join(spark, sf_dir):
    t = tables(spark, sf_dir)
    c = t["customer"].groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n_customers"))
    s = t["supplier"].groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    return c.join(s, "nationkey", "inner")


@register("replicate_years", sql="""
SELECT c_nationkey AS nationkey, CAST(y AS INTEGER) AS year, COUNT(*) AS n_customers
FROM customer CROSS JOIN range(1996, 2001) t(y)
GROUP BY 1, 2
""")
def q_replicate_years(spark, sf_dir):
    cu = tables(spark, sf_dir)["customer"]
    # Aggregate first, then replicate: equal to the reference's replicate-then-count.
    per_nation = cu.groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n_customers"))
    return replicate_years(per_nation, FIRST_YEAR, LAST_YEAR).select("nationkey", "year", "n_customers")


@register("date_series_replicate", sql="""
SELECT c_nationkey AS nationkey, CAST(year(d) AS INTEGER) AS year,
       ROUND(SUM(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal ELSE 0 END), 6) AS building_acctbal,
       ROUND(SUM(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal ELSE 0 END), 6) AS other_acctbal
FROM customer, generate_series(DATE '1996-01-01', DATE '2000-01-01', INTERVAL 1 YEAR) g(d)
GROUP BY 1, 2
""")
def q_date_series_replicate(spark, sf_dir):
    cu = tables(spark, sf_dir)["customer"]
    seg = F.col("c_mktsegment")
    per_nation = keyed_rollup(cu, [F.col("c_nationkey").alias("nationkey")], conditional_sums(
        None, {"building_acctbal": seg == "BUILDING", "other_acctbal": seg != "BUILDING"}, "c_acctbal"))
    out = replicate_date_series(per_nation, FIRST_YEAR, LAST_YEAR)
    return out.select("nationkey", "year", rounded("building_acctbal").alias("building_acctbal"),
                      rounded("other_acctbal").alias("other_acctbal"))


@register("carry_forward_union", sql=f"""
WITH s AS (
  SELECT {CODE_SQL} AS code, {YEAR_SQL} AS year, SUM(l_quantity) AS total_qty
  FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1998 GROUP BY 1, 2)
SELECT code, year, total_qty FROM s
UNION ALL SELECT code, 1999 AS year, total_qty FROM s WHERE year = 1998
UNION ALL SELECT code, 2000 AS year, total_qty FROM s WHERE year = 1998
""")
def q_carry_forward_union(spark, sf_dir):
    li = tables(spark, sf_dir)["lineitem"].filter(year_range_filter("l_shipdate", FIRST_YEAR, 1998))
    s = yearly_sum(li, padded_code("l_suppkey"), F.year("l_shipdate"), "l_quantity", out="total_qty")
    return carry_forward(s, "year", 1998, LAST_YEAR)


@register("unpivot_years", sql=f"""
WITH w AS (
  SELECT {CODE_SQL} AS code,
         SUM(CASE WHEN year(l_shipdate) = 1996 THEN l_quantity END) AS y1996,
         SUM(CASE WHEN year(l_shipdate) = 1997 THEN l_quantity END) AS y1997,
         SUM(CASE WHEN year(l_shipdate) = 1998 THEN l_quantity END) AS y1998,
         SUM(CASE WHEN year(l_shipdate) = 1999 THEN l_quantity END) AS y1999
  FROM lineitem GROUP BY 1)
SELECT code, 1996 AS year, y1996 AS qty FROM w
UNION ALL SELECT code, 1997, y1997 FROM w
UNION ALL SELECT code, 1998, y1998 FROM w
UNION ALL SELECT code, 1999, y1999 FROM w
UNION ALL SELECT code, 2000, y1999 FROM w
""")
def q_unpivot_years(spark, sf_dir):
    li = lineitem_keyed(spark, sf_dir, period=False)
    years = [1996, 1997, 1998, 1999]
    wide = keyed_rollup(li, ["code"], {f"y{y}": F.sum(F.when(F.col("year") == y, F.col("l_quantity")))
                                       for y in years})
    # 2000 is missing in the wide source: the reference reuses the last column.
    labels = [(y, f"y{y}") for y in years] + [(2000, "y1999")]
    return unpivot_columns(wide, ["code"], labels, "year", "qty")


@register("union_distinct", sql="""
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier
""")
def q_union_distinct(spark, sf_dir):
    t = tables(spark, sf_dir)
    return union_distinct([t["customer"].select(F.col("c_nationkey").alias("nationkey")),
                           t["supplier"].select(F.col("s_nationkey").alias("nationkey"))])
