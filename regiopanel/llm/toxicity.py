"""Toxicity by a counterfactually regularised logistic classifier.

Features of a text are the words it holds and their beginnings of 4, 5 and 6
bytes (so that inflected forms share evidence), hashed, present or not. For
every labelled sentence with an identity term, copies are made in which the
term is swapped for others of its group and for a word that names no group;
training penalises the squared change
of the score's logit between a text and its copies next to the usual loss, so
that weight which the labels put on a group's name is taken back and a neutral
mention does not raise the score.

Learning uses a bounded sample: ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` labelled
rows that come first by hash. Features that stand apart in the sample are kept
(``FEATURES`` at most, by the z-score of their log odds), with all identity
terms. Labels, language, source and id are never inputs of a score.

Identity terms are a parameter (``Terms``); the given ones are English, German,
French and Spanish, and all apply to every text, as language is no input. The model
tells how many pairs it compared: none if no labelled text names a group.

Defined results: null and empty texts score by the intercept, as clean; very long
texts are read whole, a chunk or one text at a time; repeated rows of a labelled
document each teach; an empty table has no scores; a score of exactly 0.5 is predicted 1; rows
without label, with null label or null id teach nothing; when one class has no
example every score is the share of the other (0.5 when nothing was learned);
conflicting labels of an id count as toxic; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import byte_values, first_by_hash, greatest, order_hash, prefix_sums, slots, span_hash, text_chunks, word_spans, written

SAMPLE_TOXIC = 4000
SAMPLE_CLEAN = 8000
FEATURES = 2000
MIN_Z = 4.0
MIN_DOCS = 4
SWAPS = 2
BALANCE = 1.0
RIDGE = 1e-4
#: Words shorter than this many bytes are features by themselves only.
PREFIXES = (4, 5, 6)

#: By language, groups of identity terms (a term is swapped for others of its group) and a word that names no group.
IDENTITY = {
    "en": ("people", (
        ("women", "men", "girls", "boys"),
        ("woman", "man", "girl", "boy"),
        ("female", "male", "transgender", "nonbinary"),
        ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual"),
        ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
        ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
        ("black", "white", "asian", "latino", "arab", "african", "european"),
        ("immigrants", "refugees", "foreigners", "citizens"),
        ("disabled", "deaf", "blind", "autistic"),
        ("old", "young", "elderly", "teenage"),
    )),
    "de": ("leute", (
        ("frauen", "männer", "mädchen", "jungen"),
        ("lesben", "schwule", "bisexuelle", "heterosexuelle"),
        ("muslime", "christen", "juden", "buddhisten", "atheisten"),
        ("schwarze", "weiße", "asiaten", "araber", "afrikaner", "europäer"),
        ("einwanderer", "flüchtlinge", "ausländer", "bürger"),
        ("behinderte", "gehörlose", "blinde", "autisten"),
        ("alte", "junge", "senioren", "jugendliche"),
    )),
    "fr": ("gens", (
        ("femmes", "hommes", "filles", "garçons"),
        ("lesbiennes", "gays", "bisexuels", "hétérosexuels"),
        ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
        ("noirs", "blancs", "asiatiques", "arabes", "africains", "européens"),
        ("immigrés", "réfugiés", "étrangers", "citoyens"),
        ("handicapés", "sourds", "aveugles", "autistes"),
        ("vieux", "jeunes", "retraités", "adolescents"),
    )),
    "es": ("gente", (
        ("mujeres", "hombres", "niñas", "niños"),
        ("lesbianas", "homosexuales", "bisexuales", "heterosexuales"),
        ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
        ("negros", "blancos", "asiáticos", "árabes", "africanos", "europeos"),
        ("inmigrantes", "refugiados", "extranjeros", "ciudadanos"),
        ("discapacitados", "sordos", "ciegos", "autistas"),
        ("viejos", "jóvenes", "ancianos", "adolescentes"),
    )),
}


class Terms:
    """Identity terms of all languages given, as ``IDENTITY`` lists them; a term of several languages counts for the first."""

    def __init__(self, identity: dict[str, tuple[str, tuple[tuple[str, ...], ...]]] = IDENTITY):
        self.group: dict[str, tuple[tuple[str, ...], str]] = {}
        for no_group, groups in identity.values():
            for group in groups:
                for term in group:
                    self.group.setdefault(term, (group, no_group))
        named = "|".join(re.escape(t) for t in sorted(self.group, key=len, reverse=True))
        self.term = re.compile(r"(?<![^\W\d_])(" + (named or r"(?!)") + r")(?![^\W\d_])", re.IGNORECASE)

    def swapped(self, text: str, turn: int) -> str:
        """The text with every identity term replaced by the ``turn``-th next one of its group; turn 0: by the word for no group."""
        def other(m: re.Match) -> str:
            word = m.group(0)
            group, no_group = self.group[word.lower()]
            new = group[(group.index(word.lower()) + turn) % len(group)] if turn else no_group
            return new.capitalize() if turn and word[0].isupper() else new
        return self.term.sub(other, text)

    def counterfactuals(self, text: str) -> list[str]:
        """Copies of the text whose sentences with an identity term have it swapped: SWAPS times, and for no group."""
        if not self.term.search(text):
            return []
        parts = re.split(r"(?<=[.!?\n])", text)
        return ["".join(self.swapped(s, t) for s in parts) for t in [*range(1, SWAPS + 1), 0]]


TERMS = Terms()
swapped, counterfactuals = TERMS.swapped, TERMS.counterfactuals

_VALUES = byte_values()
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def row_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row) of all words and word beginnings, repeats included."""
    starts, ends, first = word_spans(data, off, _LETTERS)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = prefix_sums(_VALUES[data])
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    keys, rows = [span_hash(acc, starts, ends)], [row]
    for n in PREFIXES:
        long = ends - starts > n
        # A beginning differs from a word of the same letters.
        keys.append(span_hash(acc, starts[long], starts[long] + n) ^ np.uint64(0x5DEECE66D))
        rows.append(row[long])
    return np.concatenate(keys), np.concatenate(rows)


def text_features(text: str) -> set[int]:
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    return set(row_features(raw, np.array([0, len(raw)]))[0].view(np.int64).tolist())


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    intercept: float
    #: Texts learned from, and pairs of a text and a counterfactual copy that the penalty compared.
    rows: int = 0
    pairs: int = 0

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        rows = len(off) - 1
        logit = np.full(rows, self.intercept)
        keys, row = row_features(data, off)
        at = slots(keys, self.features)
        hit = at >= 0
        if hit.any():
            one = np.unique(row[hit] * len(self.features) + at[hit])
            logit += np.bincount(one // len(self.features), self.weights[one % len(self.features)], rows)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def train(x: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], n: int,
          balance: float = BALANCE, ridge: float = RIDGE, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights of present features (lists of positions) under log loss + ridge + ``balance`` * mean squared logit change.

    ``pairs``: features that a counterfactual copy lost and gained. Full-batch
    descent with momentum; deterministic.
    """
    size = np.array([len(r) for r in x])
    col = np.concatenate(x) if len(x) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(x)), size)
    lost = [np.concatenate([p[0], p[1]]) for p in pairs]
    sign = np.concatenate([np.concatenate([-np.ones(len(p[0])), np.ones(len(p[1]))]) for p in pairs]) if pairs else np.zeros(0)
    pcol = np.concatenate(lost) if pairs else np.zeros(0, np.int64)
    prow = np.repeat(np.arange(len(pairs)), [len(r) for r in lost]) if pairs else np.zeros(0, np.int64)
    w, b = np.zeros(n), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    step_w, step_b = np.zeros(n), 0.0
    # The curvature of a feature is bounded by its share of rows; rare ones may take longer steps.
    scale = 1 / (np.bincount(col, minlength=n) / (4 * len(y)) * 4 + ridge + 1e-3
                 + (balance * np.bincount(pcol, minlength=n) * 8 / len(pairs) if pairs else 0))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], len(y)) + b, -40, 40)))
        err = (p - y) / len(y)
        grad = np.bincount(col, err[row], n) + ridge * w
        if pairs:
            delta = np.bincount(prow, sign * w[pcol], len(pairs))
            grad += 2 * balance * np.bincount(pcol, sign * delta[prow], n) / len(pairs)
        step_w = 0.8 * step_w - 0.2 * scale * grad
        step_b = 0.8 * step_b - 0.2 * err.sum()
        w, b = w + step_w, b + step_b
    return w, b


def _features_of(terms: Terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic")
            for i, j, data, off in text_chunks(batch.column("text")):
                keys, row = row_features(data, off)
                order = np.lexsort((keys, row))
                keys, row = keys[order].view(np.int64), row[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
                keys, row = keys[new], row[new]
                at = np.searchsorted(row, np.arange(j - i + 1))
                lost, gained = [], []
                for r in range(j - i):
                    text = data[off[r]:off[r + 1]].tobytes().decode("utf-8")
                    own, less, more = None, [], []
                    for copy in terms.counterfactuals(text):
                        own = own if own is not None else set(keys[at[r]:at[r + 1]].tolist())
                        other = text_features(copy)
                        less.append(sorted(own - other))
                        more.append(sorted(other - own))
                    lost.append(less)
                    gained.append(more)
                kind = pa.list_(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict({
                    "toxic": toxic.slice(i, j - i), "features": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys)),
                    "lost": pa.array(lost, kind), "gained": pa.array(gained, kind)})
    return run


def fit(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN, terms: Terms = TERMS,
        balance: float | None = None, min_z: float | None = None) -> Model:
    """Learn from ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic); ``balance`` 0 leaves the penalty out."""
    one = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    have = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    by = [F.col("doc_id")]
    chosen = first_by_hash(one.filter("toxic = 1"), toxic, by, have.get(1, 0)).unionByName(
        first_by_hash(one.filter("toxic = 0"), clean, by, have.get(0, 0)))
    # At most toxic + clean rows, whatever the input.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    seen = written(sample.mapInArrow(
        _features_of(terms), "toxic int, features array<bigint>, lost array<array<bigint>>, gained array<array<bigint>>"), "toxic-features")
    size = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        share = 0.5 if not n1 + n0 else min(max(n1 / (n1 + n0), 0.01), 0.99)
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))), n1 + n0)
    per = seen.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("all")).withColumn("neg", F.col("all") - F.col("pos"))
    odds = F.log((F.col("pos") + 0.5) / (F.lit(n1) - F.col("pos") + 0.5)) - F.log((F.col("neg") + 0.5) / (F.lit(n0) - F.col("neg") + 0.5))
    spread = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    apart = (per.filter(F.col("all") >= MIN_DOCS).withColumn("z", F.abs(odds / spread))
             .filter(F.col("z") >= (MIN_Z if min_z is None else min_z)))
    known = {r["f"] for r in greatest(written(apart.select("f", "z"), "toxic-apart"), FEATURES, [F.col("z") * 2**20, order_hash("f")])}
    own = set().union(*(text_features(t) for t in terms.group))
    keep = np.unique(np.array(sorted(known | own), np.int64).view(np.uint64))
    names = F.array(*[F.lit(int(x)) for x in keep.view(np.int64)])
    within = lambda c: F.array_intersect(c, names)
    rows = seen.select("toxic", within("features").alias("x"), F.transform("lost", within).alias("lost"),
                       F.transform("gained", within).alias("gained")).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["toxic"], sorted(r["x"])))
    position = {int(k): i for i, k in enumerate(keep.view(np.int64))}
    at = lambda ks: np.array([position[k] for k in ks], np.int64)
    pairs = [(at(a), at(b)) for r in rows for a, b in zip(r["lost"], r["gained"], strict=True)]
    told = {} if balance is None else {"balance": balance}
    w, b = train([at(r["x"]) for r in rows], np.array([r["toxic"] for r in rows], float), pairs, len(keep), **told)
    return Model(keep, w, b, len(rows), len(pairs))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, j, data, off in text_chunks(batch.column("text")):
                out[i:j] = model.scores(data, off)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(out)})
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(_score(shared), f"doc_id {kind}, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
