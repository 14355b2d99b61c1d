"""Secret scans: wide candidates, and a random forest that removes false positives.

Candidates are all runs of 16 token characters and more, runs of 8 to 15 that mix
letters with digits or hold a capital after a small letter, and values of
assignments to names like ``password``. Each is described by its length,
character classes and their transitions, the share that dictionary words
cover, its place in a path, and the words beside it. A random forest trained
on labelled findings scores them; the pattern that found a candidate is not a
feature.

Where no reviewed findings exist, ``format_labels`` marks those whose format
settles them (issued key formats and assigned random strings are secrets; bare
numbers, repeated signs and words in small letters are none); all others are left
to the forest. Equal labelled findings (features and label) are one with their
number as weight; training takes at most half of ``TRAIN_ROWS`` of each class,
first by hash. The dictionary holds the ``DICTIONARY`` most frequent words, counted over
all documents.

Defined results: null and empty texts have no candidates; repeated rows report
their findings each; when the labelled findings lack a class, every candidate
is kept with score 0.5; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import first_by_hash, greatest, order_hash, text_of, written

TRAIN_ROWS = 20_000
DICTIONARY = 5000
TREES = 40
DEPTH = 8
#: Reach, in characters, of the features that look beyond the candidate.
AROUND, BESIDE = 200, 40
#: Words of one case without a digit, joined by signs or not.
ORDINARY = r"^([A-Z]?[a-z+/_-]+|[A-Z+/_-]+)$"

_NAMES = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)"
_ASSIGNED = re.compile(_NAMES + r"""["']?\s{0,3}[:=]\s{0,3}["']?([^\s"',;]{6,})""", re.IGNORECASE)
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{8,}={0,2}")
_LONG = 16
_MIXED = re.compile(r"[0-9][^A-Za-z]*[A-Za-z]|[A-Za-z][^0-9]*[0-9]|[a-z][^A-Z]*[A-Z]")
_NEAR = re.compile(_NAMES + r"|bearer|credential|private", re.IGNORECASE)
_RUN = re.compile(r"[A-Za-z]+")
_LETTERS = re.compile(r"[^\W\d_]+")

FEATURES = ("length", "digits", "upper", "lower", "signs", "hex", "distinct", "entropy", "digit_letter", "letter_digit",
            "lower_upper", "upper_lower", "same", "dictionary", "longest_run", "slashes", "dots", "run_length", "in_url",
            "assigned", "quoted", "name_before", "name_after", "word_before", "word_after")


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def describe(text: str, start: int, stop: int, dictionary: frozenset[str]) -> list[float]:
    """Values of ``FEATURES`` for the candidate ``text[start:stop]``."""
    token = text[start:stop]
    n = len(token)
    kinds = [_kind(c) for c in token]
    steps: dict[tuple[int, int], int] = {}
    for pair in zip(kinds, kinds[1:]):
        steps[pair] = steps.get(pair, 0) + 1
    count = {c: token.count(c) for c in set(token)}
    covered = longest = 0
    for m in _RUN.finditer(token):
        longest = max(longest, len(m.group()))
        if len(m.group()) >= 3 and m.group().lower() in dictionary:
            covered += len(m.group())
    left, right = start, stop
    while left > 0 and start - left < AROUND and not text[left - 1].isspace():
        left -= 1
    while right < len(text) and right - stop < AROUND and not text[right].isspace():
        right += 1
    around = text[left:right]
    before, after = text[max(0, start - BESIDE):start], text[stop:stop + BESIDE]
    share = lambda k: kinds.count(k) / n
    word = lambda s, i: float((_LETTERS.findall(s) or [""])[i].lower() in dictionary)
    return [float(n), share(0), share(2), share(1), share(3), sum(c in "0123456789abcdefABCDEF" for c in token) / n,
            len(count) / n, -sum(v / n * math.log2(v / n) for v in count.values()),
            (steps.get((0, 1), 0) + steps.get((0, 2), 0)) / n, (steps.get((1, 0), 0) + steps.get((2, 0), 0)) / n,
            steps.get((1, 2), 0) / n, steps.get((2, 1), 0) / n, sum(a == b for a, b in zip(token, token[1:])) / n,
            covered / n, float(longest), float(around.count("/")), float(around.count(".")), float(len(around)),
            float("://" in around), float(bool(re.search(r"[:=]\s*[\"']?$", before))), float(before[-1:] in "\"'" and before != ""),
            float(bool(_NEAR.search(before))), float(bool(_NEAR.search(after))), word(before, -1), word(after, 0)]


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, kind) of the candidates, each span once, in order."""
    assigned = [m.span(1) for m in _ASSIGNED.finditer(text)]
    found, at = [(a, b, "assigned") for a, b in assigned], 0
    for m in _TOKEN.finditer(text):
        if len(m.group()) < _LONG and not _MIXED.search(m.group()):
            continue
        while at < len(assigned) and assigned[at][1] <= m.start():
            at += 1
        if at == len(assigned) or assigned[at][0] >= m.end():
            found.append((*m.span(), "token"))
    return sorted(found)


def _find(dictionary: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column("doc_id"), []
            for row, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                out += [(row, a, b, k, text[a:b], describe(text, a, b, dictionary)) for a, b, k in spans(text)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids.take(pa.array(cols[0], pa.int64())), "start": pa.array(cols[1], pa.int32()),
                "stop": pa.array(cols[2], pa.int32()), "kind": pa.array(cols[3], pa.string()),
                "value": pa.array(cols[4], pa.string()), "features": pa.array(cols[5], pa.list_(pa.float64()))})
    return run


def dictionary_of(docs: DataFrame, words_bound: int = DICTIONARY) -> frozenset[str]:
    """The most frequent words of all documents, ties by hash: at most ``2 * words_bound`` words reach the driver."""
    words = docs.select(F.explode(F.split(F.lower(text_of()), r"[^\p{L}]+")).alias("word")).filter("length(word) >= 2")
    counts = written(words.groupBy("word").count(), "word-counts")
    return frozenset(r["word"] for r in greatest(counts, words_bound, [F.col("count"), order_hash("word")]))


def candidates(docs: DataFrame, dictionary: frozenset[str]) -> DataFrame:
    """doc_id, start, stop, kind, value, features of every candidate in the whole texts (positions in characters)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _find(dictionary), f"doc_id {kind}, start int, stop int, kind string, value string, features array<double>")


def format_labels(value: str = "value", kind: str = "kind") -> Column:
    """1 or 0 where the format alone settles a finding, else null."""
    v = F.col(value)
    issued = v.rlike(r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[0-9A-Za-z-]{10,})$")
    mixed = v.rlike(r"[0-9]") & v.rlike(r"[A-Za-z]")
    no = v.rlike(r"^[0-9+/_=-]+$") | v.rlike(r"^[A-Z]?[a-z+/_-]+$") | v.rlike(r"(.)\1{7}")
    return F.when(issued, 1).when(no, 0).when((F.col(kind) == "assigned") & mixed & (F.length(v) >= 10), 1)


def fit_forest(labelled: DataFrame, rows: int = TRAIN_ROWS):
    """Forest from (features, label); None unless both labels occur. The layout, hence the trees, is fixed by the data."""
    known = written(labelled.groupBy("features", F.col("label").cast("double").alias("label")).agg(
        F.count(F.lit(1)).cast("double").alias("weight")), "labelled")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    by = [F.col("features"), F.col("label")]
    no, yes = (first_by_hash(known.filter(F.col("label") == v), rows // 2, by, counts.get(v, 0)) for v in (0.0, 1.0))
    first = no.unionByName(yes).coalesce(1).sortWithinPartitions(F.xxhash64(*by), *by)
    data = written(first.select(array_to_vector("features").alias("x"), "label", "weight"), "findings")
    if data.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=17,
                                  minInstancesPerNode=2).fit(data)


def scan(found: DataFrame, forest) -> DataFrame:
    """``found`` with score (the forest's share for a secret) and is_secret (0.5 and more)."""
    if forest is None:
        return found.drop("features").withColumn("score", F.lit(0.5)).withColumn("is_secret", F.lit(True))
    scored = forest.transform(found.withColumn("x", array_to_vector("features")))
    out = scored.withColumn("score", vector_to_array("probability")[1])
    return out.select(*[c for c in found.columns if c != "features"], "score", (F.col("score") >= 0.5).alias("is_secret"))
