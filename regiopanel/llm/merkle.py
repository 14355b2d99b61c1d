"""Merkle manifest of a dataset: levels kept as concatenated hex strings, roots that recurse.

Every row is a leaf; the leaves of one tree (a source) stand in a stated order
and every 16 neighbours have one parent. Leaves are ranked by a range shuffle
and gathered in aligned blocks of 16**levels: a block keeps each of its levels
as one hex string, 64 characters a node. Parents are hashes of fixed-width
substrings of that string, and the siblings of a node are the two substrings
that flank it in its run. The tops of a tree's blocks are the leaves of the
next round, and the roots of all trees are the leaves of one last tree, built
by the same function. Way back down, a block hands its path to its nodes, so a
leaf's proof is complete without a lookup per level.

No tree is held by one task: a source with a third of all rows is many blocks.
A block is at most 16**levels leaves (256 KB of hex) and a round has that many
times fewer rows than the one before.

Defined results: an empty table gives an empty manifest (``root`` is then None);
nulls are encoded as ``-``, so null and empty text differ; null sources form a
tree of their own, first; null ids come first in their tree; rows with the same
id are ordered by their digests, repeated rows are leaves of their own; texts
of any length are hashed whole; columns beyond ``FIELDS`` are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import written
from regiopanel.operators.ranking import group_rank

#: Columns of a row that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
LEVELS = 3
HEX = 64
RUN = ARITY * HEX
PATH_TYPE = "array<struct<at:int,siblings:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value (integers in decimal)."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """Digest of a row; a keyword replaces that column by another value."""
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def fold(start: Column, path: Column) -> Column:
    """Root that a leaf and its path lead to."""
    def step(h: Column, p: Column) -> Column:
        return digest(F.substring(p["siblings"], F.lit(1), p["at"] * HEX), h,
                      F.substring(p["siblings"], p["at"] * HEX + 1, F.lit(RUN)))
    return F.aggregate(path, start, step)


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: p["siblings"]), ""), 256)


def _runs(n: Column) -> Column:
    """0 .. (number of runs of n nodes) - 1."""
    return F.sequence(F.lit(0), F.floor((n - 1) / ARITY).cast("int"))


def _parents(level: Column) -> Column:
    """The next level of a block: a hash for each substring of 16 nodes."""
    n = (F.length(level) / HEX).cast("int")
    return F.array_join(F.transform(_runs(n), lambda r: F.sha2(F.substring(level, r * RUN + 1, F.lit(RUN)), 256)), "")


def _flanks(level: Column, at: Column) -> Column:
    """Place in its run, and the substrings left and right of it there, of node ``at`` of a level."""
    place = at % ARITY
    start = (at - place) * HEX
    left = F.substring(level, start + 1, place * HEX)
    right = F.substring(level, at * HEX + HEX + 1, (F.lit(ARITY - 1) - place) * HEX)
    return F.struct(place.cast("int").alias("at"), F.concat(left, right).alias("siblings"))


def _only(condition: Column, step: Column) -> Column:
    return F.when(condition, F.array(step)).otherwise(F.array().cast(PATH_TYPE)).cast(PATH_TYPE)


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Aligned blocks of ``nodes`` (tree, at, size, digest, row): tree, block, size, rows, level strings, top."""
    width = ARITY ** levels
    out = (nodes.groupBy("tree", F.floor(F.col("at") / width).alias("block"))
           .agg(F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("at", "digest", "row"))).alias("rows")))
    out = out.withColumn("s0", F.array_join(F.transform("rows", lambda x: x["digest"]), ""))
    for i in range(levels):
        # A level has a parent level while its whole tree has more than one node there.
        out = out.withColumn(f"s{i + 1}", F.when(F.col("size") > ARITY ** i, _parents(F.col(f"s{i}"))))
    top = F.coalesce(*[F.col(f"s{i}") for i in range(levels, -1, -1)])
    return out.select("tree", "block", "size", F.transform("rows", lambda x: x["row"]).alias("rows"),
                      *[f"s{i}" for i in range(levels)], top.alias("top"))


def _opened(blocks: DataFrame, levels: int) -> DataFrame:
    """Nodes of blocks that know their own ``path``: tree, at, digest, row, path and what ``blocks`` carries beside."""
    carried = [c for c in blocks.columns if c not in {"block", "size", "rows", "top", "path", *(f"s{i}" for i in range(levels))}]
    n = F.size("rows")

    def run(r: Column) -> Column:
        steps, place = [], r
        for i in range(1, levels):
            steps.append(_only(F.col("size") > ARITY ** i, _flanks(F.col(f"s{i}"), place)))
            place = F.floor(place / ARITY).cast("int")
        return F.struct(F.substring("s0", r * RUN + 1, F.lit(RUN)).alias("text"),
                        F.slice("rows", r * ARITY + 1, F.lit(ARITY)).alias("rows"),
                        F.concat(*steps, F.col("path")).alias("above"), (r * ARITY).alias("first"))
    width = ARITY ** levels
    runs = blocks.select(*carried, "size", (F.col("block") * width).alias("start"),
                         F.explode(F.transform(_runs(n), run)).alias("run"))
    each = runs.select(*carried, "size", "start", F.col("run.text").alias("text"), F.col("run.above").alias("above"),
                       F.col("run.first").alias("first"), F.posexplode("run.rows").alias("i", "row"))
    return each.select(*carried, (F.col("start") + F.col("first") + F.col("i")).alias("at"),
                       F.substring("text", F.col("i") * HEX + 1, F.lit(HEX)).alias("digest"), "row",
                       F.concat(_only(F.col("size") > 1, _flanks(F.col("text"), F.col("i"))), F.col("above")).alias("path"))


@dataclass
class Forest:
    """Blocks of all rounds of one set of trees; ``tops`` has one row a tree (tree, root)."""
    rounds: list[DataFrame]
    tops: DataFrame
    levels: int

    def nodes(self, above: DataFrame) -> DataFrame:
        """Every leaf with its ``path``; ``above`` gives each tree's path beyond its own root, and more to carry."""
        width = ARITY ** self.levels
        beside = [F.col(c) for c in above.columns if c != "tree"]
        named = above.withColumnRenamed("tree", "t")
        lower: DataFrame | None = None
        for blocks in reversed(self.rounds):
            done = blocks.filter(F.col("size") <= width).join(named, F.col("tree").eqNullSafe(F.col("t")))
            known = done.select(*blocks.columns, *beside)
            if lower is not None:
                # A tree of many blocks: each gets the path of the node it is in the round above.
                node = lower.select(F.col("tree").alias("t"), F.col("at").alias("b"), *beside)
                more = blocks.filter(F.col("size") > width).join(
                    node, F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("b")))
                known = known.unionByName(more.select(*blocks.columns, *beside))
            lower = _opened(known, self.levels)
        return lower


def forest(nodes: DataFrame, order: Sequence[str], levels: int = LEVELS) -> Forest:
    """Build the trees of ``nodes`` (tree, digest, row) whose leaves stand in the order of ``order``."""
    ranked = group_rank(nodes, ["tree"], list(order), rank_col="at", size_col="size")
    ranked = ranked.select("tree", (F.col("at") - 1).alias("at"), "size", "digest", "row")
    width = ARITY ** levels
    rounds: list[DataFrame] = []
    while True:
        blocks = written(_blocks(ranked, levels), "merkle-blocks")
        rounds.append(blocks)
        most = blocks.agg(F.max("size")).first()[0]
        if most is None or most <= width:
            break
        ranked = blocks.filter(F.col("size") > width).select(
            "tree", F.col("block").alias("at"), F.ceil(F.col("size") / width).alias("size"), F.col("top").alias("digest"),
            F.struct(F.lit(None).cast("int").alias("none")).alias("row"))
    tops = None
    for blocks in rounds:
        top = blocks.filter(F.col("size") <= width).select("tree", F.col("top").alias("root"))
        tops = top if tops is None else tops.unionByName(top)
    return Forest(rounds, tops, levels)


def manifest(leaves: DataFrame, tree: str = "source", order: Sequence[str] = ("doc_id",), levels: int = LEVELS) -> DataFrame:
    """``leaves`` (with a column ``leaf``) and, for each, ``subroot`` of its tree, ``root`` of all and its ``path``.

    ``leaves`` is read more than once: pass a written table of ids and digests, not texts.
    """
    names = leaves.columns
    nodes = leaves.select(F.col(tree).alias("tree"), F.col("leaf").alias("digest"),
                          F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    rest = [F.col(f"row.`{c}`") for c in order]
    low = forest(nodes, [*rest, F.col("digest")], levels)
    tops = low.tops.select(F.lit(0).alias("tree"), F.col("root").alias("digest"), F.struct(F.col("tree").alias("key")).alias("row"))
    high = forest(tops, [F.col("row.key")], levels)
    last = high.tops.first()
    root = F.lit(last["root"] if last else None).cast("string")
    ends = high.nodes(high.tops.select("tree", F.array().cast(PATH_TYPE).alias("path")))
    above = ends.select(F.col("row.key").alias("tree"), "path", F.col("digest").alias("subroot"))
    return low.nodes(above).select("row.*", "subroot", root.alias("root"), "path")


def oracle() -> str:
    """DuckDB SQL for the query over ``documents``: levels by recursion, one row a node."""
    fields = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in FIELDS)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""
WITH RECURSIVE
t AS (SELECT list(v ORDER BY i) AS tab FROM (
  SELECT i, list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: {step}, CAST(i AS BIGINT)) AS v FROM range(256) r(i))),
d AS (SELECT row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, sha256({fields})) AS rid, doc_id, source,
             sha256({fields}) AS leaf,
             sha256({fields.replace("CAST(text AS VARCHAR)", f"translate(text, '{upper}', '{lower}')")}) AS lower_leaf,
             xor(coalesce(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                 lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295), 4294967295) AS crc
      FROM documents, t),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rid) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
up(source, lvl, pos, h, n) AS (
  SELECT source, 0, pos, leaf, n FROM l UNION ALL
  SELECT source, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM up WHERE n > 1 GROUP BY source, lvl, pos // 16),
sub AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM up WHERE n = 1),
over(lvl, pos, h, n) AS (
  SELECT 0, pos, subroot, n FROM sub UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM over WHERE n > 1 GROUP BY lvl, pos // 16),
runs AS (
  SELECT 0 AS stage, source, lvl, pos // 16 AS run, string_agg(h, '' ORDER BY pos) AS txt FROM up WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT 1, NULL, lvl, pos // 16, string_agg(h, '' ORDER BY pos) FROM over WHERE n > 1 GROUP BY ALL),
steps AS (
  SELECT l.rid, r.stage, r.lvl, (l.pos // CAST(pow(16, r.lvl) AS BIGINT)) % 16 AS place, r.txt FROM l JOIN runs r
  ON r.stage = 0 AND l.source IS NOT DISTINCT FROM r.source AND l.pos // CAST(pow(16, r.lvl + 1) AS BIGINT) = r.run
  UNION ALL
  SELECT l.rid, r.stage, r.lvl, (s.pos // CAST(pow(16, r.lvl) AS BIGINT)) % 16, r.txt
  FROM l JOIN sub s ON l.source IS NOT DISTINCT FROM s.source JOIN runs r
  ON r.stage = 1 AND s.pos // CAST(pow(16, r.lvl + 1) AS BIGINT) = r.run),
path AS (SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY stage, lvl) AS k,
                substr(txt, 1, CAST(64 * place AS INTEGER)) AS a, substr(txt, CAST(64 * place + 65 AS INTEGER)) AS b FROM steps),
proofs AS (SELECT rid, sha256(string_agg(a || b, '' ORDER BY k)) AS p FROM path GROUP BY rid),
f(rid, k, h) AS (
  SELECT rid, CAST(0 AS BIGINT), CASE WHEN crc % 5 = 0 THEN lower_leaf ELSE leaf END FROM l UNION ALL
  SELECT f.rid, f.k + 1, sha256(p.a || f.h || p.b) FROM f JOIN path p ON p.rid = f.rid AND p.k = f.k + 1),
folded AS (SELECT rid, arg_max(h, k) AS h FROM f GROUP BY rid)
SELECT l.doc_id, l.leaf, s.subroot, o.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, x.h AS folded_root, x.h = o.h AS verified
FROM l JOIN sub s ON l.source IS NOT DISTINCT FROM s.source JOIN folded x USING (rid)
JOIN (SELECT h FROM over WHERE n = 1) o ON TRUE LEFT JOIN proofs p USING (rid)"""
