"""Quantiles from refined histograms against numpy, and the keys they refine."""

import io
import math
import re
import struct
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from regiopanel.operators import quantiles
from regiopanel.operators.quantiles import gathered, histogram, percentiles, with_key
from regiopanel.operators.stats import boxplot_stats, to_long

EDGES = [0.0, -0.0, 1.0, -1.0, 2.0, 3.0, 1.5, 0.1, -0.1, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
         1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 1 - 2**-53, 1 + 2**-52, 2 - 2**-52, 1e300, 1e-300,
         123456789.123, 2.0**52, 2.0**53 - 1, 2.0**1023, 2.0**-1022, 2.0**-1074, 8 - 2**-50, 1023.9999999999999]


def _bits(v: float) -> int:
    b = struct.unpack("<q", struct.pack("<d", abs(v) + 0.0))[0]
    return -b if v < 0 else b


def test_keys_are_the_bits_of_the_doubles(spark):
    rng = np.random.default_rng(1)
    many = np.concatenate([np.array(EDGES), rng.normal(size=300), 2.0 ** rng.uniform(-1074, 1023, 600), -(2.0 ** rng.uniform(-30, 30, 300)),
                           np.nextafter(2.0 ** np.arange(-1070, 1023, 7), 0), np.nextafter(2.0 ** np.arange(-1070, 1023, 7), np.inf)])
    df = spark.createDataFrame([(float(v),) for v in many], "v double")
    for r in with_key(df, "v", "k").collect():
        assert r.k == _bits(r.v), r.v
    nan = with_key(spark.createDataFrame([(math.nan,), (math.inf,)], "v double"), "v", "k").orderBy("k").collect()
    assert math.isinf(nan[0].v) and math.isnan(nan[1].v)


PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def _columns():
    rng = np.random.default_rng(7)
    return {
        "normal": rng.normal(size=1001), "ties": rng.integers(0, 5, 800).astype(float), "one": np.array([3.25]), "same": np.full(500, 1.1),
        "wide": np.sign(rng.normal(size=600)) * 10.0 ** rng.uniform(-300, 300, 600), "tight": 1.0 + rng.integers(0, 1000, 700) * 2.0**-52,
        "signs": rng.normal(size=400) * 1e-310, "edges": np.array([v for v in EDGES if not math.isinf(v)]), "pair": np.array([-2.0, 2.0]),
    }


def test_percentiles_equal_numpy(spark):
    cols = _columns()
    rows = [(g, float(v)) for g, vs in cols.items() for v in vs] + [("normal", None), ("void", None), (None, 4.0), (None, 8.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    names = [f"q{i}" for i in range(len(PROBS))]
    got = {r.g: [r[n] for n in names] for r in percentiles(df, ["g"], "v", PROBS, names).collect()}
    assert set(got) == {*cols, None}
    assert got[None] == [4.0, 4.2, 5.0, 6.0, 7.0, 7.8, 8.0]
    for g, vs in cols.items():
        lo = np.sort(vs)
        for q, x in zip(PROBS, got[g]):
            h = (len(vs) - 1) * q
            a, b = lo[math.floor(h)], lo[math.ceil(h)]
            assert x == (a if a == b else a + (h - math.floor(h)) * (b - a)), (g, q)


def test_percentiles_without_groups_and_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert [tuple(r) for r in percentiles(df, [], "v", [0.1, 0.5]).collect()] == [(10.0, 50.0)]
    assert percentiles(df.filter("v < 0"), [], "v", [0.5]).collect() == []
    inf = spark.createDataFrame([(-math.inf,), (-math.inf,), (1.0,), (math.inf,), (math.inf,)], "v double")
    assert [tuple(r) for r in percentiles(inf, [], "v", [0.0, 0.5, 1.0]).collect()] == [(-math.inf, 1.0, math.inf)]


def test_many_groups_take_the_sorted_way(spark):
    df = spark.range(3000).select((F.col("id") % 300).alias("g"), F.sin("id").alias("v"))
    few = sorted(map(tuple, percentiles(df, ["g"], "v", [0.25, 0.5]).collect()))
    many = sorted(map(tuple, percentiles(df, ["g"], "v", [0.25, 0.5], max_groups=100).collect()))
    assert len(few) == 300 and [r[0] for r in few] == [r[0] for r in many]
    assert np.allclose([r[1:] for r in few], [r[1:] for r in many], rtol=1e-12)


def test_passes_look_only_at_bins_with_a_wanted_rank(spark, monkeypatch):
    seen = []

    def watch(name, plain):
        def call(rows, group_cols, used, *rest):
            wanted = next((x for x in rest if not isinstance(x, int)), None)
            seen.append((name, used, None if wanted is None else wanted.count()))
            return plain(rows, group_cols, used, *rest)
        monkeypatch.setattr(quantiles, name, call)
    watch("histogram", histogram)
    watch("gathered", gathered)
    df = spark.range(20_000).select(F.lit(1).alias("g"), F.randn(5).alias("v"))
    percentiles(df, ["g"], "v", [0.25, 0.5, 0.75])
    assert [x[:2] for x in seen] == [("histogram", 0), ("gathered", 16)] and seen[1][2] <= 6
    seen.clear()
    monkeypatch.setattr(quantiles, "GATHER", 1)
    want = [tuple(r) for r in percentiles(df, ["g"], "v", [0.25, 0.5, 0.75]).collect()]
    assert [x[:2] for x in seen if x[0] == "histogram"] == [("histogram", u) for u in (0, 16, 36)][:len(seen)]
    monkeypatch.setattr(quantiles, "GATHER", 100_000)
    assert [tuple(r) for r in percentiles(df, ["g"], "v", [0.25, 0.5, 0.75]).collect()] == want


def test_gathered_rows_are_bounded(spark, monkeypatch):
    """Rows that are exchanged: at most GATHER for each bin with a wanted rank."""
    taken = []
    plain = quantiles._in_bins
    monkeypatch.setattr(quantiles, "_in_bins", lambda *a: taken.append((a[2], plain(*a))) or taken[-1][1])
    monkeypatch.setattr(quantiles, "GATHER", 900)
    df = spark.range(30_000).select((F.col("id") % 2).alias("g"), F.randn(9).alias("v"))
    percentiles(df, ["g"], "v", [0.31])
    last = [rows for _, rows in taken if "_k" in rows.columns]
    assert len(last) == 1 and 0 < last[0].count() <= 900 * 4


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("refined", [False, True])
def test_no_row_is_exchanged_for_a_histogram(spark, refined):
    rows = spark.range(0, 40_000, 1, 4).select((F.col("id") % 3).alias("g"), F.randn(3).alias("_v"))
    rows = with_key(rows)
    wanted = F.broadcast(spark.createDataFrame([(1, 0x3FE0 + 3)], "g long, _prefix long")) if refined else None
    text = _plan(histogram(rows, ["g"], 16 if refined else 0, 36 if refined else 16, wanted))
    assert "rangepartitioning" not in text and "SortMergeJoin" not in text
    # The one exchange stands behind a partial aggregate.
    tree = text.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0] if "Final Plan" in text else text
    nodes = [re.sub(r"[^A-Za-z]", "", line.split("(")[0]) for line in tree.splitlines() if re.search(r"\(\d+\)\s*$", line)]
    shuffles = [i for i, n in enumerate(nodes) if n.endswith("Exchange") and not n.startswith("Broadcast")]
    assert len(shuffles) == 1 and nodes[shuffles[0] + 1].endswith("HashAggregate")


def test_box_plot_fences_meet_rows_without_an_exchange(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("label", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(4)])
    text = _plan(boxplot_stats(emb, "label", [f"x{i}" for i in range(4)]))
    assert "rangepartitioning" not in text and "SortMergeJoin" not in text
    long = to_long(emb, ["label"], ["x0"])
    q = {r.label: r for r in boxplot_stats(emb, "label", ["x0"]).collect()}
    for label in q:
        v = np.array([r.value for r in long.filter(F.col("label") == label).collect()])
        lo, hi = np.percentile(v, [25, 75])
        inside = v[(v >= lo - 1.5 * (hi - lo)) & (v <= hi + 1.5 * (hi - lo))]
        assert q[label].n_outliers == len(v) - len(inside) and q[label].whisker_lo == inside.min()
