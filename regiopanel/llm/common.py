"""Shared helpers: column defaults, scratch tables, and word hashing over Arrow text buffers.

Text kernels work on the UTF-8 bytes of many documents at once (numpy), in
chunks of at most ``CHUNK_BYTES`` plus one document, so a task holds a bounded
multiple of the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from regiopanel.session import ensure_checkpoint_dir, scratch_path, ship_package

CHUNK_BYTES = 1_000_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: The white space of the word definitions: space and U+0009 to U+000D.
WHITESPACE = " \t\n\x0b\f\r"
WORD_REGEX = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators: shared checkpoint folder, package on the workers, bounded Arrow batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set(ARROW_ROWS, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage, keeps columns prunable and gives the optimizer a known size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def id_crc(c: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")))


def first_by_hash(df: DataFrame, limit: int, by: list[Column], total: int) -> DataFrame:
    """At most ``limit`` rows, first by the hash of ``by``: a sample that does not depend on the layout.

    A threshold on the hash lets about twice as many rows through, so what
    meets in one task is bounded however many tasks read ``df``.
    """
    h = F.xxhash64(*by)
    if total > 2 * limit:
        df = df.filter(h < F.lit(int(2**64 * (2 * limit / total)) - 2**63))
    return df.orderBy(h, *by).limit(limit)


DIGIT = 12


def greatest(df: DataFrame, limit: int, by: list[Column]) -> list[Row]:
    """The ``limit`` rows of greatest ``by`` (non-negative 64-bit integers, the first weighs most), greatest first.

    The place of the last row wanted is found digit by digit from histograms of
    ``2**DIGIT`` bins, so at most ``2 * limit`` rows reach the driver however
    many rows and tasks there are (rows equal in all of ``by`` stay together).
    ``df`` is read once for each digit: write it first if it is costly.
    """
    names = [f"_by{i}" for i in range(len(by))]
    keyed = df.select("*", *[c.cast("bigint").alias(n) for c, n in zip(by, names)])
    size, *most = keyed.agg(F.count(F.lit(1)), *[F.max(n) for n in names]).first()
    chosen, inside, above = F.lit(False), F.lit(True), 0
    digits = [(n, s) for n, m in zip(names, most) for s in range(max(int(m or 0).bit_length() - 1, 0) // DIGIT * DIGIT, -1, -DIGIT)]
    for name, shift in digits:
        if above + size <= 2 * limit:
            break
        digit = F.shiftright(name, shift).bitwiseAND(2**DIGIT - 1)
        bins = keyed.filter(inside).groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(bins, key=lambda r: -r["digit"]):
            if above + r["n"] >= limit:
                break
            above += r["n"]
        chosen, inside, size = chosen | (inside & (digit > r["digit"])), inside & (digit == r["digit"]), r["n"]
    rows = keyed.filter(chosen | inside).collect()
    return sorted(rows, key=lambda r: tuple(-r[n] for n in names))[:limit]


def order_hash(*cols: str) -> Column:
    """Non-negative hash that settles ties."""
    return F.xxhash64(*cols).bitwiseAND(2**63 - 1)


# ---------------------------------------------------------------- text blocks

def text_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, last row, bytes, row offsets) for runs of rows of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    if len(col) == 0:
        return
    col = pc.fill_null(col.cast(pa.large_string()), "")
    _, off_buf, data_buf = col.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), len(col))
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(data: np.ndarray, off: np.ndarray, word_byte: np.ndarray):
    """Starts and ends of the maximal runs of word bytes, and the first word number of each row.

    ``word_byte`` is a table of 256 booleans; runs never cross rows.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    w = word_byte[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    starts = np.flatnonzero(w & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    ends = np.flatnonzero(w & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_P = 0x9E3779B97F4A7C15
_PI = pow(_P, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, base, np.uint64), dtype=np.uint64)])


_LOW, _HIGH = _powers(_P, 4096), _powers(pow(_P, 4096, 2**64), 4096)
_LOW_I, _HIGH_I = _powers(_PI, 4096), _powers(pow(_PI, 4096, 2**64), 4096)


def _power(i: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    top = i >> 12
    if len(i) and int(top[-1]) >= len(high):
        high = _powers(int(high[1]), int(top[-1]) + 1)
    return low[i & 4095] * high[top]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running sums of ``value * P**position``; any span's hash follows from two entries."""
    with np.errstate(over="ignore"):
        acc = np.empty(len(values) + 1, np.uint64)
        acc[0] = 0
        np.cumsum(values * _power(np.arange(len(values)), _LOW, _HIGH), out=acc[1:])
        return acc


def span_hash(acc: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, equal for equal contents wherever they stand."""
    with np.errstate(over="ignore"):
        raw = (acc[ends] - acc[starts]) * _power(starts, _LOW_I, _HIGH_I)
        return mixed(raw + (ends - starts).astype(np.uint64))


def byte_values(fold_case: bool = True) -> np.ndarray:
    """Random 64-bit value of each byte; with ``fold_case``, A-Z share those of a-z."""
    v = _BYTE.copy()
    if fold_case:
        v[65:91] = v[97:123]
    return v


def space_words() -> np.ndarray:
    """Table of word bytes for words ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = False
    return t


def slots(keys: np.ndarray, table_keys: np.ndarray) -> np.ndarray:
    """Position of each key in a small sorted table, or -1; most misses fall to a 64K-bit filter."""
    out = np.full(len(keys), -1, np.int64)
    if not len(table_keys) or not len(keys):
        return out
    seen = np.zeros(65536, bool)
    seen[(table_keys & np.uint64(0xFFFF)).astype(np.int64)] = True
    hit = np.flatnonzero(seen[(keys & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.searchsorted(table_keys, keys[hit])
    at[at == len(table_keys)] = 0
    good = table_keys[at] == keys[hit]
    out[hit[good]] = at[good]
    return out
