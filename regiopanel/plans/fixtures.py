"""Mapping of the reference's (municipality, year) shapes onto the test tables.

Fixed values of the mapping (FIXTURES.md section 3):
  code        = l_suppkey as text, zero-padded to at least 5 characters (longer keys whole)
  year        = year(l_shipdate), data spans 1995-2001
  study period = 1996..2000 (five years, like 2019..2023)
  code prefix  = '0000' (stands in for the department prefix '19')
  user panel (UP) = events by user_id: count of each event type + mean value
  EMB  = embeddings (vec_id, 64 floats, label), as one array or as 64 columns
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiopanel.functions.expr import padded_code, year_range_filter
from regiopanel.sources.tables import TableSet

FIRST_YEAR = 1996
LAST_YEAR = 2000
CODE_PREFIX = "0000"
CODE_WIDTH = 5

# The five event types, in alphabetical order, as they appear in `events`.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
UP_FEATURES = [f"n_{t}" for t in EVENT_TYPES] + ["mean_value"]
# Fixed value: dimensions of `embeddings`.
EMB_DIM = 64
EMB_FEATURES = [f"x{i}" for i in range(EMB_DIM)]

_tables: dict[str, tuple[SparkSession, TableSet]] = {}


def tables(spark: SparkSession, sf_dir: str) -> TableSet:
    """Lazily-read tables of one scale directory, reused within the same session only."""
    hit = _tables.get(sf_dir)
    if hit is None or hit[0] is not spark:
        hit = (spark, TableSet(spark, sf_dir))
        _tables[sf_dir] = hit
    return hit[1]


def lineitem_keyed(spark: SparkSession, sf_dir: str, period: bool = True) -> DataFrame:
    """lineitem with the derived text code and int year; period filter on the raw timestamp."""
    li = tables(spark, sf_dir)["lineitem"]
    if period:
        li = li.filter(year_range_filter("l_shipdate", FIRST_YEAR, LAST_YEAR))
    return li.withColumn("code", padded_code("l_suppkey", CODE_WIDTH)) \
             .withColumn("year", F.year("l_shipdate"))


def user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UP: one row per user, six features, from one aggregation over `events`."""
    ev = tables(spark, sf_dir)["events"]
    aggs = [F.count(F.when(F.col("event_type") == F.lit(t), F.lit(1))).cast("double").alias(f"n_{t}")
            for t in EVENT_TYPES]
    aggs.append(F.avg("value").alias("mean_value"))
    return ev.groupBy("user_id").agg(*aggs)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EMB with the float vector widened to double (all distance math in double)."""
    emb = tables(spark, sf_dir)["embeddings"]
    return emb.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("features"))


def emb_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EMB: every embedding dimension as a double column."""
    emb = tables(spark, sf_dir)["embeddings"]
    return emb.select("vec_id", "label",
                      *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(EMB_DIM)])
