"""K-d tree sharding: weighted-median splits along the widest metadata dimension until leaves hold the target bytes.

Every document is a point of three ``DIMENSIONS`` (size, runs of white space,
text checksum), all functions of the text alone, so equal texts are one point.
A node that is to hold m shards is cut where its bytes divide as floor(m/2) to
the rest, along the dimension in which it is widest. Points on the cut are
ordered by text hash. A group of equal texts stays together, on the nearer side
of the cut, unless it alone outweighs ``HOT_SHARE`` of a shard: such a hot text is
cut by the hash of the id and spreads over shards.

Weighted medians of all nodes of a level are found at once from histograms of
15 key bits, refined inside the boundary bin until it holds at most
``TOLERANCE`` of a shard or one text. The driver holds the tree only (one cut per inner
node); the data are never sorted. Slots come from counts per (shard, hash
bucket) and a short ranking inside each bucket.

Defined results: an empty table gives an empty result; null texts weigh 8
bytes and hash as the empty text; repeated rows get slots of their own; null
ids hash as ``''``; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiopanel.llm.common import text_of, written

SHARDS = 24
OVERHEAD = 8
#: A boundary bin that holds at most this share of a shard's target is cut at its edge.
TOLERANCE = 0.002
#: Equal texts that together weigh at most this share of a shard's target are never parted.
HOT_SHARE = 0.05
BIN_BITS = 15
DIM_BITS, TEXT_BITS, ID_BITS = 24, 36, 60
SLOT_BUCKETS = 1024


@dataclass
class Node:
    """A region that is to hold shards ``first`` to ``first + shards - 1``; inner nodes have a cut and two children."""

    first: int
    shards: int
    dim: str = ""
    key: int = 0
    sub: int = 0
    low: "Node | None" = None
    high: "Node | None" = None


def size_of(c: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.octet_length(text_of(c)) + OVERHEAD).cast("bigint")


def _hash60(c: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(c), 64 - ID_BITS)


def points(docs: DataFrame) -> DataFrame:
    """Metadata of every document, with one 60-bit key per dimension: its value, then the text hash."""
    text = text_of()
    text_hash = F.shiftrightunsigned(F.xxhash64(text), 64 - TEXT_BITS)
    base = docs.select(
        "doc_id", size_of().alias("size"), F.crc32(text).alias("text_crc32"), text_hash.alias("th"),
        F.regexp_count(text, F.lit(r"\s+")).cast("bigint").alias("gaps"),
        _hash60(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("sub"))
    scale = (1 << DIM_BITS) - 1

    def log_scaled(c: str) -> Column:  # 0 .. 2^40 on a logarithmic scale
        return F.least(F.floor(F.log2(F.col(c) + 1) / 40 * scale), F.lit(scale)).cast("bigint")

    dims = {"size_dim": log_scaled("size"), "gap_dim": log_scaled("gaps"),
            "hash_dim": F.shiftright(F.col("text_crc32"), 32 - DIM_BITS)}
    keys = [(F.shiftleft(v, TEXT_BITS).bitwiseOR(F.col("th"))).alias(k) for k, v in dims.items()]
    return base.select("doc_id", "size", "text_crc32", "sub", *keys)


DIMENSIONS = ("size_dim", "gap_dim", "hash_dim")


def _place(node: Node, leaf) -> Column:
    """Expression that carries a row down the tree; ``leaf`` gives what a node without a cut yields."""
    if node.low is None:
        return leaf(node)
    under = (F.col(node.dim) < node.key) | ((F.col(node.dim) == node.key) & (F.col("sub") < node.sub))
    return F.when(under, _place(node.low, leaf)).otherwise(_place(node.high, leaf))


def _leaves(node: Node) -> list[Node]:
    return [node] if node.low is None else _leaves(node.low) + _leaves(node.high)


def _cut_level(pts: DataFrame, root: Node, nodes: list[Node], target: float) -> None:
    """Find the cuts of all ``nodes`` (leaves of the tree so far, by their first shard)."""
    here = _place(root, lambda n: F.lit(n.first if n in nodes else -1))
    scope = pts.withColumn("node", here).filter("node >= 0")
    spans = scope.groupBy("node").agg(
        F.sum("size").alias("bytes"), *[F.min(d).alias(f"lo_{d}") for d in DIMENSIONS],
        *[F.max(d).alias(f"hi_{d}") for d in DIMENSIONS])
    known = {r["node"]: r for r in spans.collect()}  # one row per node of the level
    state: dict[int, dict] = {}
    for n in nodes:
        r = known.get(n.first)
        if r is None:
            n.dim, state[n.first] = DIMENSIONS[0], {"done": True, "key": 0, "sub": 0}
            continue
        n.dim = max(DIMENSIONS, key=lambda d: (r[f"hi_{d}"] >> TEXT_BITS) - (r[f"lo_{d}"] >> TEXT_BITS))
        state[n.first] = {"done": False, "want": r["bytes"] * (n.shards // 2) / n.shards, "below": 0, "prefix": 0}
    key_bits = DIM_BITS + TEXT_BITS
    for used in range(0, key_bits + ID_BITS, BIN_BITS):
        open_ = [n for n in nodes if not state[n.first]["done"]]
        if not open_:
            break
        in_sub = used >= key_bits
        left = (key_bits + ID_BITS if in_sub else key_bits) - used - BIN_BITS
        cond, chain = F.lit(False), F.lit(0)
        for n in open_:
            s, at = state[n.first], F.col("node") == n.first
            digits = F.col("sub") if in_sub else F.col(n.dim)
            same = F.shiftright(digits, left + BIN_BITS) == s["prefix"]
            if in_sub:
                same = same & (F.col(n.dim) == s["key"])
            cond = cond | (at & same)
            chain = F.when(at, F.shiftright(digits, left)).otherwise(chain)
        # At most 2^BIN_BITS bins for each node of the level reach the window; one row per node reaches the driver.
        hist = (scope.filter(cond).groupBy("node", chain.cast("bigint").alias("bin")).agg(F.sum("size").alias("bytes"))
                .withColumn("upto", F.sum("bytes").over(W.partitionBy("node").orderBy("bin"))))
        need, before = F.lit(0.0), F.lit(0)
        for n in open_:
            need = F.when(F.col("node") == n.first, F.lit(float(state[n.first]["want"]))).otherwise(need)
            before = F.when(F.col("node") == n.first, F.lit(int(state[n.first]["below"]))).otherwise(before)
        ends = (hist.filter(F.col("upto") + before > need).groupBy("node")
                .agg(F.min(F.struct("bin", "upto", "bytes")).alias("e")).select("node", "e.*").collect())
        found = {r["node"]: r for r in ends}
        for n in open_:
            s, r = state[n.first], found[n.first]
            under = s["below"] + r["upto"] - r["bytes"]
            over = under + r["bytes"]
            one_text = not in_sub and left == 0
            if r["bytes"] <= (HOT_SHARE if one_text else TOLERANCE) * target or (in_sub and left == 0):
                edge = (r["bin"] + (1 if over - s["want"] < s["want"] - under else 0)) << left
                if in_sub:
                    s.update(done=True, sub=edge)
                else:
                    s.update(done=True, key=edge, sub=0)
            else:
                s.update(below=under, prefix=r["bin"])
                if used + BIN_BITS == key_bits:
                    s.update(key=r["bin"], prefix=0)
    for n in nodes:
        s = state[n.first]
        n.key, n.sub = s["key"], s["sub"]
        half = n.shards // 2
        n.low, n.high = Node(n.first, half), Node(n.first + half, n.shards - half)


def build_tree(pts: DataFrame, shards: int = SHARDS) -> Node:
    """Split until every leaf holds one shard, i.e. about total bytes / shards."""
    root = Node(0, shards)
    total = pts.agg(F.sum("size")).first()[0] or 0
    while True:
        level = [n for n in _leaves(root) if n.shards > 1]
        if not level:
            return root
        _cut_level(pts, root, level, total / shards)


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0 in each shard), grown_shard (null)."""
    pts = written(points(docs), "points")
    tree = build_tree(pts, shards)
    placed = pts.select("doc_id", "size", "text_crc32", "sub", _place(tree, lambda n: F.lit(n.first)).alias("shard"),
                        F.shiftright("sub", ID_BITS - 10).cast("int").alias("bucket"))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("c"))
    # At most shards * SLOT_BUCKETS rows whatever the data.
    starts = counts.select("shard", "bucket", (F.sum("c").over(W.partitionBy("shard").orderBy("bucket")) - F.col("c")).alias("start"))
    rank = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("sub", F.col("doc_id").asc_nulls_last())) - 1
    return (placed.withColumn("rank", rank).join(F.broadcast(starts), ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.col("rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
