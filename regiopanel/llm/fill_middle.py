"""Fill-in-the-middle transformation with a piecewise-linear learned rank index over the line boundaries.

A text of n lines has n + 1 boundaries. ``RankIndex`` learns them as a function
of their rank: segments of a straight line each, every one as long as all its
boundaries lie within ``error`` bytes of the line, and for each boundary the
small residual that the prediction misses. A cut at rank r is the prediction
plus the stored residual, exact, without a search or a list of offsets (one
byte a boundary instead of eight).

Lines are ``[^\\n]*\\n|[^\\n]+``. Two hashes of the id choose the cuts, a third
whether the text is transformed at all, a fourth the order of the parts:
``<P>`` prefix ``<S>`` suffix ``<M>`` middle (psm) or ``<S>`` suffix ``<P>`` prefix
``<M>`` middle (spm). ``restore`` reads the text back from the output and its form.

Defined results: null and empty texts, texts that hold one of the three marks
and those beyond ``rate`` stay as they are (plain, no part lengths); null ids hash
as the seed alone; repeated rows give equal results; an empty table an empty
result; a text of any length is cut whole (a task holds a bounded multiple of
its longest text); a line longer than the error bound ends a segment; further
columns are ignored by ``fim`` and carried by ``transform``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import text_chunks

#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


@dataclass(frozen=True)
class Params:
    """Seed of the id's hash, per cent of texts transformed, per cent of those in suffix-first order."""
    seed: int = 7
    rate: int = 100
    spm: int = 50


class RankIndex:
    """Ascending offsets as error-bounded straight segments over their ranks, with exact residuals.

    ``first`` rank, ``start`` offset and ``slope`` of each segment; a residual a rank.
    """

    def __init__(self, offsets: np.ndarray, error: int = 127):
        y = np.asarray(offsets, np.int64)
        self.size, self.error = len(y), error
        firsts, slopes = [], []
        i = 0
        while i < len(y):
            stop, slope = _segment(y, i, error)
            firsts.append(i)
            slopes.append(slope)
            i = stop
        self.first = np.array(firsts, np.int64)
        self.start = y[self.first] if len(y) else np.zeros(0, np.int64)
        self.slope = np.array(slopes, np.float64)
        self.residual = (y - self._predicted(np.arange(len(y)))).astype(np.int8 if error < 128 else np.int64)

    def _predicted(self, ranks: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.first, ranks, side="right") - 1
        return self.start[s] + np.rint((ranks - self.first[s]) * self.slope[s]).astype(np.int64)

    def __getitem__(self, rank):
        """Exact offset at one rank or an array of ranks."""
        r = np.asarray(rank, np.int64)
        return self._predicted(r) + self.residual[r]


def _segment(y: np.ndarray, i: int, error: int) -> tuple[int, float]:
    """End (exclusive) and slope of the longest segment from rank i whose rounded line stays within ``error``."""
    slack = error - 0.5   # rounding to whole bytes moves a prediction by at most a half
    low, high, stop, width = -np.inf, np.inf, i + 1, 32
    while stop < len(y):
        at = np.arange(stop, min(stop + width, len(y)))
        rise, run = (y[at] - y[i]).astype(np.float64), (at - i).astype(np.float64)
        lows = np.maximum.accumulate(np.maximum((rise - slack) / run, low))
        highs = np.minimum.accumulate(np.minimum((rise + slack) / run, high))
        bad = np.flatnonzero(lows > highs)
        good = int(bad[0]) if len(bad) else len(at)
        if good:
            low, high, stop = float(lows[good - 1]), float(highs[good - 1]), stop + good
        if len(bad):
            break
        width *= 4
    return stop, 0.0 if stop == i + 1 else (low + high) / 2


def boundaries(text: np.ndarray) -> np.ndarray:
    """Byte offsets of the line boundaries of one UTF-8 text: 0, then the end of each line."""
    ends = np.flatnonzero(text == 10) + 1
    if len(text) and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    return np.concatenate([[0], ends])


def points(text: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(text.decode("utf-8"))


def arrange(prefix: bytes, middle: bytes, suffix: bytes, form: str) -> bytes:
    if form == "psm":
        return b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])
    return b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])


def restore(output: bytes, form: str) -> bytes:
    """The text from an output: parts end at the next mark, which no transformed text holds."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, _, rest = output[len(first):].partition(second)
    two, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


def _draws(params: Params) -> list[Column]:
    """The first four groups of eight hex digits of the seed's and id's hash, as unsigned integers."""
    h = F.sha2(F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def _cut(params: Params, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)]
            for i, j, data, off in text_chunks(batch.column("text")):
                rows = [_row(data[off[r]:off[r + 1]], *(int(x[i + r]) for x in h), params) for r in range(j - i)]
                n, form, out, before, inside = zip(*rows)
                cols = {"n": pa.array(n, pa.int64()), "form": pa.array(form, pa.string()),
                        "prefix_chars": pa.array(before, pa.int64()), "middle_chars": pa.array(inside, pa.int64())}
                if with_text:
                    cols = {"row": batch.column("row").slice(i, j - i), **cols, "output": pa.array(out, pa.binary()).cast(pa.string())}
                else:
                    back = [restore(o, f) for o, f in zip(out, form)]
                    cols = {"doc_id": batch.column("doc_id").slice(i, j - i), **cols,
                            "output_sha256": pa.array([hashlib.sha256(o).hexdigest() for o in out], pa.string()),
                            "restored_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string())}
                yield pa.RecordBatch.from_pydict(cols)
    return run


def _row(raw: np.ndarray, h1: int, h2: int, h3: int, h4: int, params: Params) -> tuple:
    index = RankIndex(boundaries(raw))
    n, text = index.size - 1, raw.tobytes()
    if not text or h3 % 100 >= params.rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", text, None, None
    a, b = index[np.sort([h1 % (n + 1), h2 % (n + 1)])].tolist()
    form = "spm" if h4 % 100 < params.spm else "psm"
    return n, form, arrange(text[:a], text[a:b], text[b:], form), points(text[:a]), points(text[a:b])


FIELDS = "n bigint, form string, prefix_chars bigint, middle_chars bigint"


def fim(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """Digests: doc_id, n (lines), form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *_draws(params)).mapInArrow(
        _cut(params, False), f"doc_id {kind}, {FIELDS}, output_sha256 string, restored_sha256 string")


def transform(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``row`` (all columns of ``docs``) with n, form, prefix_chars, middle_chars and the ``output`` to train on."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    schema = docs.select(row.alias("row")).schema["row"].dataType.simpleString()
    return docs.select(row.alias("row"), "text", *_draws(params)).mapInArrow(
        _cut(params, True), f"row {schema}, {FIELDS}, output string")


def restored(transformed: DataFrame) -> DataFrame:
    """Rows of ``transform`` with ``restored``, the text rebuilt from output and form alone (in the JVM)."""
    def between(a: str, b: str) -> Column:
        start = F.instr("output", a) + len(a)
        return F.substring("output", start, F.instr("output", b) - start)
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    middle = F.substring("output", F.instr("output", m) + len(m), F.length("output"))
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return transformed.withColumn("restored", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm)
                                  .otherwise(F.col("output")))


def oracle(params: Params = Params()) -> str:
    """DuckDB SQL for the query: lines by a regular expression, parts by slices of the list."""
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
                  sha256('{params.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, len(u) AS n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS r FROM d),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}')
                       OR r[3] % 100 >= {params.rate} THEN 'plain'
                  WHEN r[4] % 100 < {params.spm} THEN 'spm' ELSE 'psm' END AS form FROM x),
e AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
             array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '{p}' || prefix || '{s}' || suffix || '{m}' || middle
                        WHEN 'spm' THEN '{s}' || suffix || '{p}' || prefix || '{m}' || middle ELSE text END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM e"""
