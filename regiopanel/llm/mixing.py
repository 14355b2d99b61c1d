"""Mixing sources to target weights by hash-threshold histograms (DataFrame operations only).

Every document has a fixed hash. A source's target is met by whole copies of
the source plus the documents whose hash lies under a threshold. Tokens are
summed by source and hash bucket; the bucket in which the budget ends is
refined by its next hash bits, until the threshold is exact. Documents are
then filtered by comparing hashes: nothing is sorted, and budgets are nested (a
larger target takes a superset).

Sources are ordered by code point, null last. Weights repeat over them. Shares
are of all sizes; a target stops at ``cap`` times its source's size and the
excess is reshared by weight until none is above.

Defined results: an empty table gives an empty result; documents of size 0
are taken as often as their hash says but count 0 words; rows with the same
doc_id have the same hash and are taken together; null ids hash as ``''``;
columns beyond doc_id, text and source are carried by ``mix`` only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiopanel.llm.common import WORD_REGEX, text_of, written

WEIGHTS = (1, 2, 3)
CAP = 3
HASH_BITS = 60
LEVEL_BITS = 12


def word_count(c: str = "text") -> Column:
    return F.regexp_count(text_of(c), F.lit(WORD_REGEX)).cast("bigint")


def doc_hash(c: str = "doc_id") -> Column:
    """60 bits of the MD5 of the id: the same in every run and engine."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(c).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: source, source_size, target, copies, budget (what is left after whole copies).

    Water-filling in closed form: with sources by cap/weight, the first level
    at which the next source is not above its cap is the common one.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    per = (per.withColumn("rank", F.row_number().over(W.orderBy(order)) - 1).withColumn("weight", w)
           .withColumn("most", F.col("source_size") * cap))
    by_ratio = W.orderBy(F.col("most") / F.col("weight"), "rank")
    rest = by_ratio.rowsBetween(0, W.unboundedFollowing)
    full = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
              - F.coalesce(F.sum("most").over(full), F.lit(0))).cast("double") / F.sum("weight").over(rest))
    per = per.withColumn("level", level)
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(
        (F.col("most") / F.col("weight")).alias("ratio"), F.col("rank").alias("r"), F.col("level").alias("v"))))
    common = first.over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    per = per.withColumn("common", common)
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("common.v"), F.lit(0.0)) * F.col("weight"))
    per = per.withColumn("target", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    per = per.withColumn("copies", copies.cast("bigint"))
    return per.select("source", "source_size", "target", "copies",
                      (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"))


def hash_thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``cut``: hashes below it belong to the budget, those from it on do not.

    The document at which the budget ends goes in if that is nearer to it.
    """
    t = targets.select("*", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("below"),
                       F.lit(True).alias("open"))
    for used in range(0, HASH_BITS, LEVEL_BITS):
        left = HASH_BITS - used - LEVEL_BITS
        edge = t.filter("open").select(F.col("source").alias("s"), "prefix", "below", "budget")
        hist = (sized.join(edge, F.col("source").eqNullSafe(F.col("s")))
                .filter(F.shiftright("hash", HASH_BITS - used) == F.col("prefix"))
                .groupBy("s", F.shiftright("hash", left).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.first("below").alias("below"), F.first("budget").alias("budget")))
        run = F.col("below") + F.sum("words").over(W.partitionBy("s").orderBy("bucket"))
        ends = (hist.withColumn("upto", run).filter(F.col("upto") > F.col("budget"))
                .groupBy("s").agg(F.min(F.struct("bucket", "upto", "words")).alias("e"))
                .select("s", "e.bucket", (F.col("e.upto") - F.col("e.words")).alias("under"), F.col("e.words")))
        last = left == 0
        cols = [F.col(c) for c in targets.columns]
        t = t.join(ends, F.col("source").eqNullSafe(F.col("s")), "left")
        if not last:
            t = t.select(*cols, F.coalesce("bucket", "prefix").alias("prefix"),
                         F.coalesce("under", "below").alias("below"),
                         (F.col("open") & F.col("s").isNotNull()).alias("open"))
            t = written(t, "thresholds")
    nearer = (F.col("under") + F.col("words") - F.col("budget")) < (F.col("budget") - F.col("under"))
    cut = F.when(F.col("bucket").isNull(), F.lit(1 << HASH_BITS)).otherwise(
        F.col("bucket") + F.when(nearer, 1).otherwise(0))
    return written(t.select(*cols, cut.cast("bigint").alias("cut")), "cuts")


def _plan(docs: DataFrame, weights: Sequence[int], cap: int) -> tuple[DataFrame, DataFrame]:
    """Sizes and hashes of the documents, and one row per source with its threshold; texts are read, not kept."""
    sized = written(docs.select("doc_id", "source", word_count().alias("size"), doc_hash().alias("hash")), "sized")
    slim = sized.select("source", "size", "hash")
    targets = written(source_targets(slim, weights, cap), "targets")
    return sized, hash_thresholds(slim, targets).withColumnRenamed("source", "s")


def _times(cap: int) -> Column:
    more = F.when((F.col("budget") > 0) & (F.col("hash") < F.col("cut")), F.lit(1)).otherwise(F.lit(0))
    return F.least(F.col("copies") + more, F.lit(cap).cast("bigint"))


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, times (copies in the mix)."""
    sized, cuts = _plan(docs, weights, cap)
    out = sized.join(cuts, F.col("source").eqNullSafe(F.col("s"))).withColumn("times", _times(cap))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it."""
    _, cuts = _plan(docs, weights, cap)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").alias("src"),
                       doc_hash().alias("hash"))
    return (rows.join(cuts, F.col("src").eqNullSafe(F.col("s"))).withColumn("times", _times(cap)).filter("times > 0")
            .select("row", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))).alias("copy"))
            .select("row.*"))


def oracle(weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> str:
    """DuckDB SQL for the documents query: the same law by sorted running sums."""
    w = "[" + ", ".join(str(int(x)) for x in weights) + "]"
    return f"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, {w}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}) + 1] AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) AS rank, source_size * {cap} AS most FROM p),
l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER (
               ORDER BY CAST(most AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
             / CAST(sum(weight) OVER (ORDER BY CAST(most AS DOUBLE) / weight, rank
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM r),
f AS (SELECT level FROM l WHERE level * weight <= most ORDER BY CAST(most AS DOUBLE) / weight, rank LIMIT 1),
t AS (SELECT source, source_size,
             CASE WHEN source_size = 0 THEN 0.0 ELSE least(CAST(most AS DOUBLE), coalesce((SELECT level FROM f), 0.0) * weight) END AS target
      FROM l),
c AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t),
b AS (SELECT *, target - copies * source_size AS budget FROM c),
s AS (SELECT d.*, b.source_size, b.target, b.copies, b.budget,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(d.size) OVER (PARTITION BY d.source, hash) AS own
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (copies + CASE WHEN budget > 0 AND (upto <= budget
            OR (upto - own <= budget AND upto - budget < budget - (upto - own))) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM s"""
