"""Language identification by prediction by partial matching over bytes.

Per language a byte context tree of order ``ORDER`` holds the counts of every
byte after every context of up to ORDER bytes. A byte's cost is the code
length PPM (method C, no exclusion, frozen counts) gives it: in the longest
known context ``count / (n + q)``, with an escape of ``q / (n + q)`` (q
distinct successors) to the next shorter one, and 8 bits below order 0. The
language with the shortest code for the whole text wins.

The trees of all languages share one trie of byte n-grams that is closed
under suffixes. The cost of a byte depends only on the deepest trie node that
ends at it and the deepest context before it, so a document's exact code
length is a sum of one table value per byte (see ``Model.lengths``).

Learning takes whole texts of a bounded sample of the labelled rows: documents
in hash order up to ``lang_bytes`` per language (``total_bytes`` over all), see
``sample_rows``. The driver gets the n-grams seen ``min_count`` times and more:
at most (ORDER + 1) * total_bytes / min_count of them, whatever the input.

Defined results: ``und`` with score 0 for null texts, texts without a letter
(Unicode category L), and when nothing was learned; ties go to the first
language by code point; rows with null lang teach nothing; further columns are
carried by ``keep_known`` and ignored by ``predict``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiopanel.llm.common import id_crc, text_chunks

ORDER = 3
LANG_BYTES = 3_000_000
TOTAL_BYTES = 16_000_000
MIN_COUNT = 2
PER_OCTAVE = 128
UNKNOWN = "und"


@dataclass
class Model:
    """The shared trie and per-language costs. ``step[k]`` maps (node of depth k, byte class) to a node of depth k+1."""

    langs: list[str]
    byte_class: np.ndarray
    step: list[np.ndarray]
    base: np.ndarray          # first global number of each depth's nodes
    weight: np.ndarray        # [language, node]: what a byte that ends at the node adds
    tail: np.ndarray          # [language, node]: taken back after the last byte
    root_escape: np.ndarray   # [language]: all escapes of the empty context

    def lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Code length in bits of each row under each language, [language, row]."""
        rows = len(off) - 1
        out = np.zeros((len(self.langs), rows))
        full = np.flatnonzero(np.diff(off) > 0)
        if not len(full):
            return out
        first = off[:-1][full]
        sym = self.byte_class[data]
        node = self.step[0][0, sym]
        deepest = np.where(node > 0, node + self.base[0], 0)
        for k in range(1, len(self.step)):
            before = np.empty_like(node)
            before[0] = 0
            before[1:] = node[:-1]
            before[first] = 0
            node = self.step[k][before, sym]
            np.copyto(deepest, node + self.base[k], where=node > 0)
        last = deepest[off[1:][full] - 1]
        for i in range(len(self.langs)):
            sums = np.add.reduceat(self.weight[i][deepest], first)
            out[i, full] = sums - self.tail[i][last] + self.root_escape[i]
        return out


def byte_grams(data: np.ndarray, off: np.ndarray, depth: int) -> np.ndarray:
    """Keys ``depth << 56 | bytes`` of all n-grams of 1..depth bytes that lie within a row."""
    keys, at = [], np.arange(len(data))
    start = np.repeat(off[:-1], np.diff(off))
    acc = np.zeros(len(data), np.int64)
    for k in range(1, depth + 1):
        shifted = np.zeros(len(data), np.int64)
        shifted[k - 1:] = data[:len(data) - k + 1].astype(np.int64) << (8 * (k - 1))
        acc = acc | shifted
        keys.append(acc[at - start >= k - 1] | (k << 56))
    return np.concatenate(keys) if keys else np.zeros(0, np.int64)


def build_model(langs: list[str], counts: dict[str, dict[int, int]], order: int = ORDER) -> Model:
    """Freeze counts per language (keys of ``byte_grams`` of up to order + 1 bytes) into a model."""
    size, n_lang = order + 1, len(langs)
    mask = (1 << 56) - 1
    union: dict[int, list[int]] = {}
    for i, lang in enumerate(langs):
        for key, n in counts[lang].items():
            union.setdefault(key, [0] * n_lang)[i] = n
    by_depth = [sorted(k & mask for k in union if k >> 56 == d) for d in range(1, size + 1)]
    used = sorted({g & 255 for g in by_depth[0]}) if by_depth else []
    byte_class = np.zeros(256, np.int32)
    for c, b in enumerate(used):
        byte_class[b] = c + 1
    number = [{g: i + 1 for i, g in enumerate(grams)} for grams in by_depth]
    base = np.cumsum([0, *[len(g) for g in by_depth[:-1]]]).astype(np.int64)
    nodes = 1 + sum(len(g) for g in by_depth)
    step = [np.zeros((1 if d == 0 else len(by_depth[d - 1]) + 1, len(used) + 1), np.int32) for d in range(size)]
    # Successor totals of every context (global number; the empty context is kept apart).
    total, distinct = np.zeros((n_lang, nodes)), np.zeros((n_lang, nodes))
    root_total, root_distinct = np.zeros(n_lang), np.zeros(n_lang)
    count = np.zeros((n_lang, nodes))
    for d, grams in enumerate(by_depth):
        for g in grams:
            me = int(base[d]) + number[d][g]
            own = np.array(union[(d + 1) << 56 | g], float)
            count[:, me] = own
            parent = 0 if d == 0 else number[d - 1].get(g >> 8, 0)
            step[d][parent, byte_class[g & 255]] = number[d][g]
            if d == 0:
                root_total += own
                root_distinct += own > 0
            else:
                up = int(base[d - 1]) + parent
                total[:, up] += own
                distinct[:, up] += own > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        root_esc = np.where(root_total > 0, -np.log2(root_distinct / (root_total + root_distinct)), 0.0)
        esc = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
    below = np.zeros((n_lang, nodes))   # escapes from a context down to order 0, itself included
    cost = np.zeros((n_lang, nodes))    # code length of the last byte after the node's own context
    weight, tail = np.zeros((n_lang, nodes)), np.zeros((n_lang, nodes))
    cost[:, 0] = 8.0
    below[:, 0] = root_esc
    weight[:, 0], tail[:, 0] = 8.0 + root_esc, root_esc
    for d, grams in enumerate(by_depth):
        low = (1 << (8 * d)) - 1
        for g in grams:
            me = int(base[d]) + number[d][g]
            suffix = 0 if d == 0 else int(base[d - 1]) + number[d - 1][g & low]
            parent = 0 if d == 0 else int(base[d - 1]) + number[d - 1][g >> 8]
            n, q, e = (root_total, root_distinct, root_esc) if d == 0 else (
                total[:, parent], distinct[:, parent], esc[:, parent])
            own = count[:, me]
            with np.errstate(divide="ignore", invalid="ignore"):
                seen = -np.log2(own / (n + q))
            cost[:, me] = np.where(own > 0, seen, e + cost[:, suffix])
            below[:, me] = esc[:, me] + below[:, suffix]
            context = below[:, me] if d < order else below[:, suffix]
            up = root_esc if d == 0 else below[:, parent]
            weight[:, me] = cost[:, me] - up + context
            tail[:, me] = context
    return Model(langs, byte_class, step, base, weight, tail, root_esc)


def _count_grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").to_pylist()
            for i, j, data, off in text_chunks(batch.column("text")):
                for name in sorted(set(lang[i:j])):
                    mine = np.array([x == name for x in lang[i:j]])
                    lens = np.where(mine, np.diff(off), 0)
                    own = data[np.repeat(mine, np.diff(off))]
                    keys, n = np.unique(byte_grams(own, np.concatenate([[0], np.cumsum(lens)]), order + 1), return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(keys), pa.string()),
                                                      "key": pa.array(keys, pa.int64()), "n": pa.array(n, pa.int64())})
    return run


def _hash_bucket(hash_col: Column) -> Column:
    """0 to 53 * ``PER_OCTAVE``: the top 53 bits of a hash on a logarithmic scale, so that a small share is as finely cut as a large one."""
    return F.floor(F.log2(F.shiftrightunsigned(hash_col, 11) + 1) * PER_OCTAVE).cast("int")


def sample_rows(labelled: DataFrame, lang_bytes: int, total_bytes: int) -> DataFrame:
    """Whole texts (lang, text) of each language in hash order, at most ``lang_bytes`` of it and ``total_bytes`` / languages.

    The bound holds at every size of the input: buckets are finer the smaller
    their hashes, so the share to take is met within one bucket of 0.5 % of
    it. A bucket that alone outweighs the bound (a longer text, or one row
    repeated very often) is passed over; a language of such buckets only
    teaches one text, its shortest.
    """
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "text", F.octet_length("text").cast("long").alias("bytes"),
        _hash_bucket(F.xxhash64("doc_id", "text")).alias("bucket"))
    hist = rows.groupBy("lang", "bucket").agg(F.sum("bytes").alias("bytes"))
    # At most 53 * PER_OCTAVE + 1 buckets a language reach a window; a few numbers a language reach the driver:
    # labels of a classifier, few whatever the input.
    langs = F.size(F.collect_set("lang").over(W.partitionBy(F.lit(1))))
    bound = F.least(F.lit(lang_bytes).cast("double"), F.lit(total_bytes) / langs)
    fits = F.when(F.col("bytes") <= F.col("bound"), F.col("bytes")).otherwise(0)
    run = (hist.withColumn("bound", bound).withColumn("fits", fits)
           .withColumn("upto", F.sum("fits").over(W.partitionBy("lang").orderBy("bucket"))))
    good = F.col("upto") <= F.col("bound")
    small = F.col("bytes") <= F.col("bound")
    cuts = run.groupBy("lang").agg(F.max(F.when(good & small, F.col("bucket"))).alias("cut"),
                                   F.collect_list(F.when(good & ~small, F.col("bucket"))).alias("passed")).collect()
    if not cuts:
        return rows.filter("false").select("lang", "text")
    take = F.lit(False)
    for r in cuts:
        if r["cut"] is not None:
            over = [x for x in r["passed"] if x < r["cut"]]
            mine = (F.col("lang") == r["lang"]) & (F.col("bucket") <= r["cut"])
            take = take | (mine & ~F.col("bucket").isin(over) if over else mine)
    sample = rows.filter(take).select("lang", "text")
    lone = [r["lang"] for r in cuts if r["cut"] is None]
    if lone:
        short = rows.filter(F.col("lang").isin(lone)).groupBy("lang").agg(F.min(F.struct("bytes", "text")).alias("t"))
        sample = sample.unionByName(short.select("lang", "t.text"))
    return sample


def fit(labelled: DataFrame, order: int = ORDER, lang_bytes: int = LANG_BYTES, total_bytes: int = TOTAL_BYTES,
        min_count: int = MIN_COUNT) -> Model:
    """Learn from rows (doc_id, text, lang). N-grams seen fewer than ``min_count`` times in all are left out."""
    sample = sample_rows(labelled, lang_bytes, total_bytes)
    parts = sample.mapInArrow(_count_grams(order), "lang string, key bigint, n bigint")
    per = parts.groupBy("key", "lang").agg(F.sum("n").alias("n"))
    often = per.groupBy("key").agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by"))
    found = often.filter(F.col("all") >= min_count).select("key", F.explode("by").alias("b")).select(
        "key", "b.lang", "b.n").toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    counts: dict[str, dict[int, int]] = {x: {} for x in langs}
    for key, lang, n in zip(*(found.column(c).to_pylist() for c in ("key", "lang", "n")), strict=True):
        counts[lang][key] = n
    return build_model(langs, counts, order)


def _score(shared, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            n = batch.num_rows
            best = np.zeros(n, np.int64)
            score, bits = np.zeros(n), np.zeros(n)
            if model.langs:
                for i, j, data, off in text_chunks(batch.column("text")):
                    length = model.lengths(data, off)
                    best[i:j] = np.argmin(length, axis=0)
                    low = length.min(axis=0)
                    score[i:j] = 1.0 / np.exp2(np.minimum(low - length, 0.0)).sum(axis=0)
                    bits[i:j] = low / np.maximum(np.diff(off), 1)
            names = np.array(model.langs or [UNKNOWN], dtype=object)
            letter = batch.column("has_letter").to_numpy(zero_copy_only=False)
            known = letter.astype(bool) & bool(model.langs)
            cols = {c: batch.column(c) for c in keep}
            cols["lang_pred"] = pa.array(np.where(known, names[best], UNKNOWN), pa.string())
            cols["score"] = pa.array(np.where(known, score, 0.0))
            cols["bits_per_byte"] = pa.array(np.where(known, bits, 8.0))
            yield pa.RecordBatch.from_pydict(cols)
    return run


def _scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    sent = docs.select(*dict.fromkeys([*keep, "text"]), letter)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema if f.name in keep)
    schema = f"{kinds}, lang_pred string, score double, bits_per_byte double"
    return sent.mapInArrow(_score(shared, keep), schema)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (posterior of the best language under equal priors), bits_per_byte."""
    return _scored(docs.select("doc_id", "text"), model, ["doc_id"])


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is known.

    Rejected are ``und`` rows and texts that no model codes in fewer bits than
    the 8 per byte that they have without any model.
    """
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    moved = docs.select(*[F.col(f"`{a}`").alias(b) for a, b in zip(names, inner, strict=True)])
    text = inner[names.index("text")]
    scored = _scored(moved.withColumnRenamed(text, "text"), model, ["text" if c == text else c for c in inner])
    kept = scored.filter((F.col("lang_pred") != UNKNOWN) & (F.col("bits_per_byte") < 8.0))
    return kept.select(*[F.col("text" if b == text else b).alias(a) for a, b in zip(names, inner, strict=True)])


def learnable(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """Rows that may teach: those whose crc32(doc_id as text) mod 4 is not 2."""
    held = held_out if held_out is not None else (id_crc() % 4 == 2)
    return docs.filter(~held).select("doc_id", "text", "lang")
