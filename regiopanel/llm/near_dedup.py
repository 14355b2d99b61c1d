"""Near-duplicate documents: banded MinHash candidates checked by odd sketches, links by full sets.

1. Every document's distinct word shingles (as 64-bit hashes) give a set
   digest, MinHash samples, band keys and an odd sketch: each sample flips one
   bit of a bitmap, so that the XOR of two sketches counts the samples in which
   they differ.
2. Equal sets form one class (a hot class is combined before the shuffle); one
   row per class goes on.
3. Classes that share a band key meet the smallest class of that bucket, never
   each other: one pair per class and pivot. Pairs whose sketches differ in
   more bits than a link at the threshold could, but for a chance below 1e-6,
   are dropped; the rest are confirmed on full sets. Confirmed links are
   contracted to components.
4. Where a pivot's classes are still in several components, those outside the
   group's largest component are compared with all of the group, block by
   block, on the full sets; a block gives at most one link per class and
   foreign component. So no link is lost that would change a component, and
   pairs of a large group are never emitted.

Bands are as many as make the chance that a pair at the threshold shares none
at most ``MISS`` (1e-7).

Defined results: documents without words (or null text) have an empty set and
link with nothing; with fewer words than a shingle has, the whole sequence is
one shingle; repeated rows are copies of each other; null ids sort last; an empty
table gives an empty result; very long texts are read whole, one at a time in a worker;
columns beyond doc_id and text are carried by ``drop_near_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiopanel.llm.common import (byte_values, mixed, prefix_sums, space_words, span_hash, text_chunks, word_spans,
                                   written)
from regiopanel.llm.components import connected

MISS = 1e-7
SKETCH_BITS = 256
#: Shingles of a block of documents (a document may have more).
BLOCK = 400_000


@dataclass(frozen=True)
class Params:
    """Shingles of ``words`` words; linked when 100 * intersection >= ``percent`` * union."""

    words: int = 5
    percent: int = 80
    rows: int = 4

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISS) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_bits(self) -> int:
        """Differing sketch bits beyond which a pair is no link (5.5 deviations of the samples, 3 of the sketch)."""
        t, k, n = self.percent / 100, self.samples, SKETCH_BITS
        differ = 2 * (k * (1 - t) + 5.5 * math.sqrt(k * t * (1 - t)))
        return math.ceil(n / 2 * (1 - math.exp(-2 * differ / n)) + 3 * math.sqrt(n / 4 * (1 - math.exp(-4 * differ / n))))


def estimate(xor_bits: int, p: Params) -> float:
    """Similarity estimated from the number of set bits in the XOR of two odd sketches."""
    share = min(xor_bits * 2 / SKETCH_BITS, 0.999999)
    return max(0.0, 1 + SKETCH_BITS * math.log(1 - share) / 2 / (2 * p.samples))


_VALUES, _WORDS = byte_values(), space_words()
_ORDER = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    starts, ends, first = word_spans(data, off, _WORDS)
    empty = np.zeros(0, np.uint64)
    if not len(starts):
        return [empty] * (len(off) - 1)
    word = span_hash(prefix_sums(_VALUES[data]), starts, ends)
    with np.errstate(over="ignore"):
        total = np.zeros(max(len(word) - k + 1, 0), np.uint64)
        for t in range(k):
            total += mixed(word[t:t + len(total)] * _ORDER[t])
        shingle = mixed(total)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(shingle[a:b - k + 1]))
            elif b > a:
                short = sum((mixed(word[a + t:a + t + 1] * _ORDER[t]) for t in range(b - a)), np.zeros(1, np.uint64))
                out.append(mixed(short + np.uint64(b - a)))
            else:
                out.append(empty)
    return out


def _digest(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        two = np.array([mixed(s).sum(), mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()], np.uint64)
    one, other = two.view(np.int64).tolist()
    return one, other


def _multipliers(p: Params) -> np.ndarray:
    return np.random.default_rng(11).integers(0, 2**32, p.samples, dtype=np.uint32) | np.uint32(1)


def min_hashes(s: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """MinHash samples of a non-empty set: for each multiplier the smallest 32-bit hash."""
    low, high = (s & np.uint64(0xFFFFFFFF)).astype(np.uint32), (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(mult), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(s), 2048):
        np.minimum(best, (mult[:, None] * low[None, i:i + 2048] + high[None, i:i + 2048]).min(axis=1), out=best)
    return best


def band_keys(samples: np.ndarray, p: Params) -> np.ndarray:
    """[row, band] 64-bit keys."""
    v = samples.reshape(len(samples), p.bands, p.rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        acc = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64), v.shape[:2]).copy()
        for r in range(p.rows):
            acc = mixed(acc * _ORDER[40] + v[:, :, r])
    return acc


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """[row, bytes] parity bitmaps of the numbered samples."""
    n, k = samples.shape
    with np.errstate(over="ignore"):
        at = mixed(samples.astype(np.uint64) + np.arange(1, k + 1, dtype=np.uint64) * _ORDER[41])
    cell = (at & np.uint64(SKETCH_BITS - 1)).astype(np.int64) + np.arange(n)[:, None] * SKETCH_BITS
    odd = (np.bincount(cell.ravel(), minlength=n * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, SKETCH_BITS), axis=1)


def _signatures(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult = _multipliers(p)
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column("text")):
                sets = shingle_sets(data, off, p.words)
                samples = np.zeros((j - i, p.samples), np.uint32)
                for r, s in enumerate(sets):
                    if len(s):
                        samples[r] = min_hashes(s, mult)
                digests = [_digest(s) for s in sets]
                words = odd_sketches(samples).view(">i8").astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(i, j - i),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "d1": pa.array([d[0] for d in digests], pa.int64()),
                    "d2": pa.array([d[1] for d in digests], pa.int64()),
                    "bands": pa.array(list(band_keys(samples, p).view(np.int64)), pa.list_(pa.int64())),
                    "sketch": pa.array(list(words), pa.list_(pa.int64()))})
    return run


def _sets(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column("text")):
                sets = shingle_sets(data, off, p.words)
                digests = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(i, j - i),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "d1": pa.array([d[0] for d in digests], pa.int64()),
                    "d2": pa.array([d[1] for d in digests], pa.int64()),
                    "members": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})
    return run


def _digests(p: Params, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two = [], [], []
            for _, _, data, off in text_chunks(batch.column("text")):
                for s in shingle_sets(data, off, p.words):
                    d = _digest(s)
                    n.append(len(s))
                    one.append(d[0])
                    two.append(d[1])
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in carry}, "n": pa.array(n, pa.int64()),
                                              "d1": pa.array(one, pa.int64()), "d2": pa.array(two, pa.int64())})
    return run


def _similar(size: Column, n1: str, n2: str, p: Params) -> Column:
    return size * 100 >= (F.col(n1) + F.col(n2) - size) * p.percent


def _sketch_near(a: str, b: str, p: Params) -> Column:
    differ = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, SKETCH_BITS // 64)),
                 F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))
    return differ <= p.most_bits


def _size_near(n1: str, n2: str, p: Params) -> Column:
    return F.least(n1, n2) * 100 >= F.greatest(n1, n2) * p.percent


def _fetch_sets(docs: DataFrame, wanted: DataFrame, p: Params) -> DataFrame:
    """(cid, members) of the wanted classes, from the text of their first documents."""
    ids = wanted.select(F.col("doc_id").alias("want")).distinct()
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("want")), "left_semi")
    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = texts.mapInArrow(_sets(p), f"doc_id {kind}, n bigint, d1 bigint, d2 bigint, members array<bigint>")
    same = ["n", "d1", "d2"]
    # Ids may repeat: the digest tells which of their texts is meant.
    return sets.select(*same, "members").join(wanted.select("cid", *same), same).select("cid", "members")


def _block_links(p: Params):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out_a: list[int] = []
        out_b: list[int] = []
        own, rest = pdf[pdf["own"]], pdf[~pdf["own"]]
        if len(own) and len(rest):
            sets = [np.asarray(x) for x in rest["members"]]
            size = np.array([len(s) for s in sets])
            value, where = np.unique(np.concatenate(sets), return_inverse=True)
            owner = np.repeat(np.arange(len(sets)), size)
            order = np.argsort(where, kind="stable")
            posting, at = owner[order], np.concatenate([[0], np.cumsum(np.bincount(where, minlength=len(value)))])
            cid, comp = rest["cid"].to_numpy(), rest["comp"].to_numpy()
            sketch = np.stack([np.asarray(x, np.int64) for x in rest["sketch"]])
            for x, c, k, s in zip(own["cid"], own["comp"], own["sketch"], own["members"], strict=True):
                # Unsigned: the count of a signed word is that of its absolute value.
                differ = np.bitwise_count((sketch ^ np.asarray(k, np.int64)[None, :]).view(np.uint64)).sum(axis=1)
                near = (differ <= p.most_bits) & (comp != c)
                if not near.any():
                    continue
                s = np.asarray(s)
                i = np.searchsorted(value, s)
                i[i == len(value)] = 0
                i = i[value[i] == s]
                hits = posting[np.concatenate([np.arange(at[v], at[v + 1]) for v in i])] if len(i) else []
                both = np.bincount(hits, minlength=len(sets)) if len(i) else np.zeros(len(sets), np.int64)
                good = np.flatnonzero(near & (100 * both >= p.percent * (size + len(s) - both)))
                for other in np.unique(comp[good]):
                    out_a.append(x)
                    out_b.append(cid[good][comp[good] == other].min())
        return pd.DataFrame({"a": pd.Series(out_a, dtype="int64"), "b": pd.Series(out_b, dtype="int64")})
    return run


def _unsettled_links(star: DataFrame, labels: DataFrame, reps: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Links between components that meet in a pivot's group and that the pivot itself did not show."""
    group = star.select("pivot", "cid").unionByName(
        star.select("pivot", F.col("pivot").alias("cid")).distinct())
    group = written(group.join(reps.select("cid", "n"), "cid").join(labels.withColumnRenamed("id", "cid"), "cid", "left")
                    .select("pivot", "cid", "n", F.coalesce("component", "cid").alias("comp")), "groups")
    parts = group.groupBy("pivot", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    open_ = written(parts.groupBy("pivot").agg(
        F.max(F.struct("n", (-F.col("comp")).alias("neg"))).alias("top"), F.sum("c").alias("docs"), F.sum("n").alias("all"),
        F.count(F.lit(1)).alias("comps")).filter("comps > 1 AND docs > 2")
        .select("pivot", (-F.col("top.neg")).alias("main"), "all", (F.col("all") - F.col("top.n")).alias("others")), "open")
    rows = group.join(open_, "pivot")
    blocks_own = F.ceil(F.col("others") / BLOCK).cast("int")
    blocks_all = F.ceil(F.col("all") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("cid"), F.when(F.col("comp") == F.col("main"), blocks_all).otherwise(blocks_own))
    place = F.pmod(F.xxhash64("cid", F.lit(1)), blocks_all)
    span = lambda n: F.sequence(F.lit(0), n - 1)
    own = rows.filter("comp <> main").select(
        "pivot", "cid", "comp", F.lit(True).alias("own"), mine.cast("int").alias("ob"), F.explode(span(blocks_all)).alias("mb"))
    rest = rows.select("pivot", "cid", "comp", F.lit(False).alias("own"), F.explode(span(blocks_own)).alias("ob"),
                       place.cast("int").alias("mb")).select("pivot", "cid", "comp", "own", "ob", "mb")
    full = (own.unionByName(rest).join(reps.select("cid", "sketch"), "cid").join(sets, "cid"))
    return full.groupBy("pivot", "ob", "mb").applyInPandas(_block_links(p), "a bigint, b bigint")


def classes(docs: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows (doc_id, row_no, n, d1, d2); groups by (n, d1, d2) with component_id and keep_row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, d1 bigint, d2 bigint, bands array<bigint>, sketch array<bigint>"
    sig = written(docs.select("doc_id", "text").mapInArrow(_signatures(p), schema)
                  .withColumn("row_no", F.monotonically_increasing_id()), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no")).alias("first")
    same = ["n", "d1", "d2"]
    sets_of = written(sig.filter("n > 0").groupBy(*same).agg(first)
                      .select(*same, F.col("first.row_no").alias("cid"), F.col("first.doc_id").alias("doc_id")), "classes")
    reps = written(sig.select(F.col("row_no").alias("cid"), "doc_id", *same, "bands", "sketch")
                   .join(sets_of.select("cid"), "cid", "left_semi"), "representatives")
    keys = reps.select("cid", F.explode("bands").alias("key"))
    buckets = written(keys.groupBy("key").agg(F.min("cid").alias("pivot"), F.count(F.lit(1)).alias("c"))
                      .filter("c > 1").drop("c"), "buckets")
    star = written(keys.join(buckets, "key").filter("cid <> pivot").select("cid", "pivot").distinct(), "stars")
    met = star.select("cid").union(star.select(F.col("pivot").alias("cid"))).distinct()
    sets = written(_fetch_sets(docs, reps.select("cid", "doc_id", *same).join(met, "cid", "left_semi"), p), "sets")
    left = reps.select("cid", F.col("n").alias("n1"), F.col("sketch").alias("s1"))
    right = reps.select(F.col("cid").alias("pivot"), F.col("n").alias("n2"), F.col("sketch").alias("s2"))
    near = written(star.join(left, "cid").join(right, "pivot")
                   .filter(_size_near("n1", "n2", p) & _sketch_near("s1", "s2", p)).select("cid", "pivot", "n1", "n2"), "near")
    both = F.size(F.array_intersect("members", "others")).cast("bigint")
    links = written(
        near.join(sets, "cid").join(sets.select(F.col("cid").alias("pivot"), F.col("members").alias("others")), "pivot")
        .filter(_similar(both, "n1", "n2", p)).select(F.col("cid").alias("a"), F.col("pivot").alias("b")), "links")
    labels = connected(links)
    more = written(_unsettled_links(star, labels, reps, sets, p), "more-links")
    if not more.isEmpty():
        labels = connected(links.unionByName(more))
    named = sets_of.join(labels.withColumnRenamed("id", "cid"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    named = written(named, "named")
    least = (named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id",
                                                           F.col("cid").alias("row"))).alias("m"))
             .select("component", F.col("m.doc_id").alias("component_id"), F.col("m.row").alias("keep_row")))
    groups = written(named.join(written(least, "least"), "component")
                     .select(*same, "component_id", "keep_row"), "named-classes")
    return sig.select("doc_id", "row_no", *same), groups


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept, one row per document."""
    rows, groups = classes(docs, p)
    named = rows.join(groups, ["n", "d1", "d2"], "left")
    comp = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                        F.coalesce(F.col("doc_id").eqNullSafe(comp), F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows that stay, one of each group of linked documents, with all columns of ``docs``."""
    rows, groups = classes(docs, p)
    same = ["n", "d1", "d2"]
    keep = written(rows.join(groups, same).filter("row_no = keep_row").select("doc_id", *same), "kept")
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    text, ident = inner[names.index("text")], inner[names.index("doc_id")]
    moved = docs.select(*[F.col(f"`{a}`").alias("text" if b == text else b) for a, b in zip(names, inner, strict=True)])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in moved.schema)
    told = moved.mapInArrow(_digests(p, moved.columns), f"{kinds}, n bigint, d1 bigint, d2 bigint")
    back = [F.col("text" if b == text else b).alias(a) for a, b in zip(names, inner, strict=True)]
    first = F.row_number().over(W.partitionBy(ident, *same).orderBy(ident, *same))
    # Texts move once, by id and digest; repeated rows meet there and one of them stays.
    met = told.join(
        keep.select(F.col("doc_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in same]).hint("merge"),
        F.col(ident).eqNullSafe(F.col("_id")) & (F.col("n") == F.col("_n")) & (F.col("d1") == F.col("_d1"))
        & (F.col("d2") == F.col("_d2")), "left").withColumn("_first", first)
    return met.filter("n = 0 OR (_n IS NOT NULL AND _first = 1)").select(*back)
