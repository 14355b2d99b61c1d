"""License scans by diagonal voting.

Every rolling k-gram of words of every document (pairs by default) is joined by its
hash to the positions at which license templates hold that k-gram, and checked word by
word. Templates may have any length, full license texts included, and come as a
list or from a table (``from_table``). A match votes for the diagonal ``document position - template position``.
Votes are summed by (document, template, diagonal); diagonals at most ``GAP``
apart are one span (words put in or left out shift the diagonal). Spans are
opened by diagonals that hold a k-gram with a longer word; votes of k-grams of short
words alone (``by nc``, ``4 0``) count for the spans within ``GAP``. A span is
verified when it covers ``COVER`` of all of the template's k-grams and its longer
ones stretch over no more than ``STRETCH`` times the template, and when it holds
every k-gram with a version word (one with a digit) or a word of ``VARIANT``: these
tell GPL 2 from GPL 3 and BY-SA from BY. Templates longer than ``LONG`` words must
hold only ``COVER`` of those k-grams, as long texts name groups in passing.

Base phrases are templates that must match in full on one diagonal: a place is
where the phrase's words stand consecutively.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text.

Defined results: null and empty texts have no words and no label; an empty table
gives an empty result; very long texts are read whole, their k-grams are rows of their
own; repeated rows get equal results; a label is given once however many spans carry it; further
columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiopanel.llm.common import text_of, written

GAP = 3
COVER = 0.8
STRETCH = 1.5
#: Pairs of two short words are too common to open a span of a notice; they vote for those that others open.
OPENING_LETTERS = 4
#: Words from which on a template counts as a full text, and templates that ``from_table`` takes at most.
LONG = 60
MOST_TEMPLATES = 5000
#: Words at which variants of a notice differ; their pairs must match in full, as those of version words.
VARIANT = frozenset("agpl apache attribution bsd by cc general gnu gpl isc lgpl mit mozilla mpl nc".split())

#: Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Wording of common public license notices.
NOTICES = {
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                "documentation files the software to deal in the software without restriction",
    "apache-2.0": "licensed under the apache license version 2 0",
    "gpl-3.0": "gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                  "public license as published by the free software foundation",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that "
                "the following conditions are met",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mit-notice": "released under the mit license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "mit-full-text":
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the software the software is provided as is without warranty of any kind "
        "express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
}

#: Names in ``SPDX-License-Identifier`` lines, as words, and their labels.
IDENTIFIERS = {
    "apache 2 0": "apache-2.0", "mit": "mit-notice", "isc": "isc-text", "gpl 2 0": "gpl-2.0", "gpl 3 0": "gpl-3.0",
    "lgpl 2 1": "lgpl-2.1", "lgpl 3 0": "lgpl-3.0", "agpl 3 0": "agpl-3.0", "mpl 2 0": "mpl-2.0", "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause", "cc by 4 0": "cc-by-4.0", "cc by sa 4 0": "cc-by-sa-4.0", "cc by nc 4 0": "cc-by-nc-4.0",
}

_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_RAW = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    base: bool
    k: int = 2

    @property
    def grams(self) -> list[tuple[int, tuple[str, ...]]]:
        """(position, words) of all rolling k-grams."""
        return [(i, self.words[i:i + self.k]) for i in range(len(self.words) - self.k + 1)]

    @property
    def opening(self) -> set[int]:
        """Positions of the k-grams that open a span: those with a longer word, or all if there is none."""
        return {i for i, g in self.grams if max(map(len, g)) > OPENING_LETTERS} or {i for i, _ in self.grams}

    @property
    def deciding(self) -> set[int]:
        """Positions of the k-grams with a version or variant word."""
        return {i for i, g in self.grams if any(w in VARIANT or any(c.isdigit() for c in w) for w in g)}


def words_of(text: str) -> tuple[str, ...]:
    return tuple(w for w in re.split(_SEPARATOR, text.lower()) if w)


def templates(base: dict[str, str] = BASE, notices: dict[str, str] | list[tuple[str, str]] | None = None, k: int = 2) -> list[Template]:
    """Base phrases (phrase to label) and ``notices`` (label and text, by default ``NOTICES`` and ``IDENTIFIERS``), in k-grams."""
    if notices is None:
        notices = [*NOTICES.items(), *((v, f"spdx license identifier {name}") for name, v in IDENTIFIERS.items())]
    told = [(v, words_of(phrase), True) for phrase, v in base.items()]
    told += [(v, words_of(text), False) for v, text in (notices.items() if isinstance(notices, dict) else notices)]
    if k < 2 or any(len(w) < 2 for _, w, _ in told):
        raise ValueError("a template has at least 2 words, a k-gram too")
    return [Template(v, w, is_base, min(k, len(w))) for v, w, is_base in told]


def from_table(texts: DataFrame, base: dict[str, str] = BASE, k: int = 2) -> list[Template]:
    """Templates of a table (label, text) of license texts, at most ``MOST_TEMPLATES`` rows; null texts are left out."""
    rows = texts.filter("label IS NOT NULL AND text IS NOT NULL").select("label", "text").limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    return templates(base, sorted((r["label"], r["text"]) for r in rows), k)


def _positions(spark: SparkSession, known: list[Template], k: int) -> DataFrame:
    """The positions of all k-grams of the templates that vote by this k."""
    rows = []
    for n, t in enumerate(known):
        opening = t.opening
        rows += [(n, i, *g, i in opening) for i, g in t.grams if t.k == k]
    words = [f"t{i}" for i in range(k)]
    schema = "tpl int, tpos int, " + ", ".join(f"{w} string" for w in words) + ", opens boolean"
    return spark.createDataFrame(rows, schema).withColumn("hash", F.xxhash64(*words))


def _hits(words: DataFrame, known: list[Template], k: int) -> DataFrame:
    """doc_id, th, pos, tpl, tpos, opens: equal k-grams of documents and templates."""
    shifted = [F.expr(f"slice(w, {i + 1}, greatest(size(w) - {i}, 0))").alias(f"w{i}") for i in range(k)]
    names = [f"w{i}" for i in range(k)]
    grams = (words.select("doc_id", "th", *shifted).select("doc_id", "th", F.posexplode(F.arrays_zip(*names)).alias("pos", "g"))
             .select("doc_id", "th", "pos", *[F.col(f"g.{n}").alias(n) for n in names])
             .filter(F.col(names[-1]).isNotNull()).withColumn("hash", F.xxhash64(*names)))
    equal = F.lit(True)
    for i in range(k):
        equal = equal & (F.col(f"w{i}") == F.col(f"t{i}"))
    # The templates are given, not data: their positions are broadcast.
    return grams.join(F.broadcast(_positions(words.sparkSession, known, k)), "hash").filter(equal).select(
        "doc_id", "th", "pos", "tpl", "tpos", "opens")


def _case(known: list[Template], value) -> Column:
    told = [value(t) for t in known]
    return F.element_at(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in told]), F.col("tpl") + 1)


def scan(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label, start, words, cover)."""
    known = known or templates()
    key = [F.col("doc_id"), F.xxhash64(text_of()).alias("th")]
    words = docs.select(*key, F.array_remove(F.split(F.lower(text_of()), _SEPARATOR), "").alias("w"))
    hits = reduce(DataFrame.unionByName, [_hits(words, known, k) for k in sorted({t.k for t in known})])
    diagonals = written(hits.groupBy("doc_id", "th", "tpl", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("seen"), F.min("pos").alias("low"), F.max("pos").alias("high"),
        F.min(F.when(F.col("opens"), F.col("pos"))).alias("open_low"),
        F.max(F.when(F.col("opens"), F.col("pos"))).alias("open_high")), "diagonals")
    grams = _case(known, lambda t: len(t.grams))
    k = _case(known, lambda t: t.k)
    need = _case(known, lambda t: math.ceil(len(t.deciding) * (1.0 if len(t.words) <= LONG else COVER)))
    is_base = _case(known, lambda t: t.base)
    label = _case(known, lambda t: t.label)
    own = ["doc_id", "th", "tpl"]
    base = diagonals.filter(is_base & (F.size("seen") == grams)).select(
        "doc_id", "th", label.alias("label"), F.lit(True).alias("base"), F.col("diagonal").alias("start"),
        (F.col("high") - F.col("low") + k).alias("words"), F.lit(1.0).alias("cover"))
    order = W.partitionBy(*own).orderBy("diagonal")
    opener = F.when(F.col("open_low").isNotNull(), F.col("diagonal"))
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)
    lined = (diagonals.filter(~is_base).withColumn("last", F.last(opener, ignorenulls=True).over(before))
             .withColumn("next", F.first(opener, ignorenulls=True).over(after))
             .withColumn("apart", F.coalesce(opener - F.col("last") > GAP, F.lit(False)).cast("int"))
             .withColumn("span", F.sum("apart").over(order)))
    # A diagonal that opens none counts for the spans before and after it that are near enough: one, both or none.
    near_last = F.when(F.col("diagonal") - F.col("last") <= GAP, F.col("span"))
    parted = F.coalesce(F.col("next") - F.col("last") > GAP, F.lit(False)).cast("int")
    near_next = F.when(F.col("next") - F.col("diagonal") <= GAP, F.col("span") + parted)
    of = F.when(opener.isNotNull(), F.array("span")).otherwise(F.array_distinct(F.array_compact(F.array(near_last, near_next))))
    # Positions are counted once a span; a template's positions bound what an aggregate holds.
    deciding = _case(known, lambda t: F.array(*[F.lit(i) for i in sorted(t.deciding)]).cast("array<int>"))
    spans = (lined.withColumn("span", F.explode(of)).withColumn("tpos", F.explode("seen")).groupBy(*own, "span").agg(
        F.collect_set("tpos").alias("seen"), F.min("low").alias("low"), F.max("high").alias("high"),
        (F.max("open_high") - F.min("open_low") + k).alias("open_words")))
    size = _case(known, lambda t: len(t.words))
    notice = (spans.select(
        "doc_id", "th", label.alias("label"), F.lit(False).alias("base"), F.col("low").alias("start"),
        (F.col("high") - F.col("low") + k).alias("words"), (F.size("seen") / grams).alias("cover"), "open_words", size.alias("size"),
        (F.size(F.array_intersect("seen", deciding)) >= need).alias("decided"))
        .filter(F.col("decided") & (F.col("cover") >= COVER) & (F.col("open_words") <= F.col("size") * STRETCH)).drop("open_words", "size", "decided"))
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = written(base.unionByName(notice).groupBy("doc_id", "th").agg(
        F.sum(F.col("base").cast("bigint")).alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        names(F.when(F.col("base"), F.col("label"))).alias("base_labels"), names(F.col("label")).alias("labels"),
        F.max("cover").alias("score"),
        F.array_sort(F.collect_set(F.struct("start", "words", "label", "cover"))).alias("spans")), "license-spans")
    slim = docs.select(*key, F.regexp_count(text_of(), F.lit(_WORD_RAW)).cast("bigint").alias("n_words"))
    other = found.withColumnRenamed("doc_id", "id2").withColumnRenamed("th", "th2")
    out = slim.join(other, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("th") == F.col("th2")), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"), "spans")
