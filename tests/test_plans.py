"""Plan-shape checks: the properties the scale design relies on."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from regiopanel.functions.expr import padded_code
from regiopanel.operators.panel import merge_panel
from regiopanel.operators.ranking import group_rank


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final (adaptive) plan
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _count(text: str, node: str) -> int:
    return len(re.findall(rf"^\(\d+\) {node}\b", text, re.M))


def test_filters_and_columns_reach_the_scan(spark):
    text = _plan(entry.queries()["yearly_sum"](spark, SF_SMALL))
    pushed = re.findall(r"PushedFilters: \[(.*)\]", text)[0]
    assert "GreaterThanOrEqual(l_suppkey,0)" in pushed and "LessThanOrEqual(l_suppkey,9)" in pushed
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed
    schema = re.findall(r"ReadSchema: (struct<.*>)", text)[0]
    assert schema == "struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>"
    assert _count(text, "Exchange") == 1


def test_panel_merge_adds_no_exchange(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    code, year = padded_code("l_suppkey"), F.year("l_shipdate")
    sources = {f"s{i}": li.filter(F.col("l_linenumber") == i).groupBy(code.alias("code"), year.alias("year"))
               .agg(F.sum("l_quantity").alias(f"m{i}")) for i in range(1, 5)}
    text = _plan(merge_panel(sources))
    # one exchange per source aggregate; the N-way merge itself reuses their partitioning
    assert _count(text, "Exchange") == 4
    assert _count(text, "SortMergeJoin") == 0 and _count(text, "BroadcastHashJoin") == 0


def test_group_rank_shuffles_the_data_once(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "label")
    ranked = group_rank(emb, ["label"], ["vec_id"], rank_col="r")
    text = _plan(ranked)
    # the range shuffle happened once, inside the checkpoint; what remains reads the written copy
    assert "rangepartitioning" not in text
    assert "Scan ExistingRDD" in text
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = _plan(group_rank(emb, ["label"], ["vec_id"], rank_col="r", size_col="n"))
        assert "Exchange" not in text and "Join" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_cartesian_products_anywhere(spark):
    for name in ("recode_then_pivot", "dim_join_rollup", "replicate_years", "decision_grid", "nearest_centroid",
                 "carry_forward_union", "inertia_k1", "zscore"):
        text = _plan(entry.queries()[name](spark, SF_SMALL))
        assert _count(text, "CartesianProduct") == 0, name
        assert _count(text, "BroadcastNestedLoopJoin") == 0, name
