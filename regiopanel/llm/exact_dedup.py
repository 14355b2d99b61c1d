"""Exact deduplication against a persistent digest index (DataFrame operations only).

The index is a Parquet table bucketed and sorted by digest in a shared folder.
A batch is hashed once, its groups are formed by a partial aggregate (a hot
text collapses before the shuffle), and a sort-merge anti-join with the
bucketed index finds the digests not seen before; those are appended.

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]`` (null counts as empty). Within a batch the row with the
most code points stays, then the smallest doc_id (null ids last), then an
arbitrary but fixed one of repeated rows. A digest that an earlier batch has
brought in keeps that batch's row: all its later rows are dropped.

Defined results: an empty table gives an empty result and leaves the index as
it is; null and white-space-only texts form one group; further columns of the
input are ignored by ``ingest`` and carried by ``drop_duplicates``; ids must be
integers (any other type is refused by name).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from regiopanel.llm.common import WHITESPACE, text_of, written
from regiopanel.session import scratch_path

#: A digest with more than one row in HOT_SHARE of a batch is joined by broadcast;
#: there are at most HOT_SHARE such digests whatever the data.
HOT_SHARE = 1000


def digest_of(c: str = "text") -> Column:
    """SHA-256 (lowercase hex) of the text without white space, in UTF-8."""
    return F.sha2(F.translate(text_of(c), WHITESPACE, ""), 256)


class DigestIndex:
    """A digest table bucketed and sorted by digest, at a path that all executors share.

    The number of buckets belongs to the index: it is written beside it
    (``<path>.buckets``) and read on opening, whatever the session's settings.
    Opening a path that holds an index registers its files again, so the index
    outlives the session; asking for another number of buckets is refused.
    ``close`` takes the table out of the catalog and leaves the files.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, table: str | None = None):
        self.spark = spark
        self.path = path
        self.buckets = self._bucket_count(buckets)
        self.table = table or f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, group_size BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def _bucket_count(self, asked: int | None) -> int:
        beside = self.path.rstrip("/") + ".buckets"
        if _exists(self.spark, beside):
            stored = self.spark.read.schema("buckets int").json(beside).first()["buckets"]
            if asked and asked != stored:
                raise ValueError(f"the index at {self.path} has {stored} buckets, not {asked}")
            return stored
        if _exists(self.spark, self.path) and not asked:
            raise ValueError(f"the index at {self.path} does not say how many buckets it has: name their number")
        buckets = asked or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.json(beside)
        return buckets

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)   # another handle may have appended
        return self.spark.table(self.table)

    def before(self, batch: str | None) -> DataFrame:
        """What other batches have brought in."""
        return self.read().filter(F.col("batch") != batch) if batch else self.read()

    def unseen(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """Groups whose digest no other batch holds (sort-merge anti-join, index side not shuffled)."""
        seen = self.before(batch).select("digest").hint("merge")
        return groups.repartition(self.buckets, "digest").join(seen, "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add the digests of a batch; those that an earlier try of the same batch has added stay as they are."""
        tried = self.read().filter(F.col("batch") == batch)
        if not tried.isEmpty():
            groups = written(groups.join(tried.select("digest").hint("merge"), "digest", "left_anti"), "missing-digests")
        # Dealt by the buckets' own hash: one task and one file for each bucket of the batch.
        (groups.select("digest", F.col("keep_id").cast("bigint"), "group_size", F.lit(batch).alias("batch"))
         .repartition(self.buckets, "digest").write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .saveAsTable(self.table))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _stage(docs: DataFrame) -> DataFrame:
    """Hash every text; rows get a number that tells repeated rows apart. Texts stay where they are."""
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError(f"doc_id must be an integer column, not {docs.schema['doc_id'].dataType.simpleString()}")
    return written(docs.select(
        F.col("doc_id").alias("doc_id"), F.unhex(digest_of()).alias("digest"),
        F.length(text_of()).alias("points"), F.monotonically_increasing_id().alias("row_no")), "digests")


def _groups(staged: DataFrame) -> DataFrame:
    # Longest, then smallest id; combined per task before the shuffle, so a hot text is a row per task.
    best = F.struct(F.col("points"), F.col("doc_id").isNotNull().alias("has"), (-F.col("doc_id")).alias("neg"),
                    (-F.col("row_no")).alias("neg_row"))
    return (staged.groupBy("digest").agg(F.max(best).alias("best"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", (-F.col("best.neg")).alias("keep_id"), (-F.col("best.neg_row")).alias("keep_row"),
                    "group_size", F.col("best.points").alias("keep_points")))


def _join_groups(staged: DataFrame, groups: DataFrame) -> DataFrame:
    """Give each row its group. Hot digests (at most HOT_SHARE) by broadcast, the rest by sort-merge join."""
    total = staged.count()
    hot = groups.filter(F.col("group_size") * HOT_SHARE > F.lit(total))
    cold = groups.filter(F.col("group_size") * HOT_SHARE <= F.lit(total))
    tagged = staged.join(F.broadcast(hot.select("digest", F.struct("keep_id", "keep_row", "group_size").alias("hot"))),
                         "digest", "left")
    by_hot = tagged.filter("hot IS NOT NULL").select(
        *[c for c in staged.columns], "hot.keep_id", "hot.keep_row", "hot.group_size")
    by_digest = tagged.filter("hot IS NULL").drop("hot").join(cold.hint("merge"), "digest")
    return by_hot.unionByName(by_digest)


def _new_groups(staged: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    fresh = written(index.unseen(_groups(staged), batch), "new-digests")
    index.append(fresh, batch)
    return fresh


def ingest(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``kept`` rows are the new ones; their digests are appended to ``index``.
    For a digest of an earlier batch, keep_id and group_size are the index's.
    ``batch`` names the batch: ingested again under the same name (after a lost
    job, say), its own digests count as new and are not added twice. Without a
    name every call is a batch of its own.
    """
    batch = batch or uuid.uuid4().hex
    staged = _stage(docs)
    before = index.before(batch).select("digest", "keep_id", F.lit(None).cast("bigint").alias("keep_row"), "group_size")
    old = written(before.join(staged.select("digest").distinct(), "digest", "left_semi"), "old-digests")
    fresh = _new_groups(staged, index, batch)
    joined = _join_groups(staged, fresh.select(*old.columns).unionByName(old))
    return joined.select(
        "doc_id", "keep_id", F.col("group_size").cast("bigint").alias("group_size"),
        (F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(False))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; ``batch`` as for ``ingest``."""
    own = index is None
    index = index or new_index(docs.sparkSession)
    keep = _new_groups(_stage(docs), index, batch or uuid.uuid4().hex).select("digest", "keep_points", "keep_id")
    if own:
        index.close()
    # Texts are read and hashed again and move once, spread by (digest, length, id) however hot a text is.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.unhex(digest_of()).alias("digest"),
                       F.length(text_of()).alias("points"), F.col("doc_id").alias("id"))
    stay = rows.join(keep.hint("merge"), (F.col("id").eqNullSafe(F.col("keep_id"))) & (F.col("points") == F.col("keep_points"))
                     & (rows["digest"] == keep["digest"]), "left_semi")
    # Repeated rows agree in all three: one of them stays.
    first = F.row_number().over(W.partitionBy("id", "points", "digest").orderBy("id", "points", "digest"))
    return stay.withColumn("first", first).filter("first = 1").select("row.*")


def new_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, scratch_path(spark, "digest-index"))
