import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from regiopanel.llm import mixing, sharding
from regiopanel.llm.common import prepare
from regiopanel.llm.queries import ORACLE, QUERIES, multi_ranks
from tests.conftest import SF_SMALL
from tests.llm import cases


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


def _mix_rows(spark, data):
    return mixing.plan_mix(cases.frame(spark, data)).collect()


def test_mix_matches_sorted_running_sums(spark):
    data = [r for r in cases.rows() if r[0] is not None]
    got = [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in _mix_rows(spark, data)]
    want = cases.duck(mixing.oracle(), cases.pandas_docs(data))
    cases.same_rows(got, [(int(a), int(b), int(c), float(d), int(e)) for a, b, c, d, e in want.itertuples(index=False)])


def test_mix_meets_targets_and_caps(spark):
    data = [(i, cases.prose(i, 20 + i % 50), None, s, 0) for i, s in enumerate(["a"] * 300 + ["b"] * 60 + ["c"] * 5 + [None] * 30)]
    rows = _mix_rows(spark, data)
    src = {d[0]: d[3] for d in data}
    per = {}
    for r in rows:
        p = per.setdefault(src[r.doc_id], [0, r.target, r.source_size])
        p[0] += r.taken
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
    total = sum(p[2] for p in per.values())
    assert abs(sum(p[1] for p in per.values()) - total) < 1e-6
    for taken, target, size in per.values():
        assert target <= 3 * size and abs(taken - target) <= 35
    assert rows == sorted(rows, key=rows.index) and sorted(map(str, rows)) == sorted(map(str, _mix_rows(spark, data)))


def test_mix_edge_cases(spark):
    assert _mix_rows(spark, []) == []
    assert [(r.target, r.taken) for r in _mix_rows(spark, [(1, None, None, None, None), (2, "", None, "x", 0)])] == [(0.0, 0), (0.0, 0)]
    docs = cases.frame(spark).withColumnRenamed("lang", "hash").withColumnRenamed("n_chars", "times")
    mixed = mixing.mix(docs)
    times = {}
    for r in mixing.plan_mix(docs).collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + r.times
    assert mixed.columns == docs.columns
    got = pd.Series([r.doc_id for r in mixed.collect()]).fillna(-1).value_counts().to_dict()
    assert {k if k is not None else -1: v for k, v in times.items() if v} == got


def test_native_operators_use_no_python_on_executors(spark):
    for name in ("op1_exact_dedup", "op9_source_mix"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), name


def test_shards_balance_bytes_and_keep_equal_texts(spark):
    texts = [cases.prose(i, 5 + (i * 37) % 200) for i in range(900)]
    data = [(i, t, None, "s", 0) for i, t in enumerate(texts)]
    data += [(10_000 + i, texts[i % 100], None, "s", 0) for i in range(300)]
    data += [(20_000 + i, "hot text " * 30, None, "s", 0) for i in range(900)]   # a large share in one text
    data += [(30_000, None, None, None, None), (None, "", None, None, None), (None, "", None, None, None)]
    rows = sharding.assign(cases.frame(spark, data)).collect()
    text = {d[0]: d[1] for d in data}
    frame = pd.DataFrame([r.asDict() for r in rows])
    assert len(frame) == len(data) and set(frame["shard"]) == set(range(24)) and set(frame["law"]) == {"bytes"}
    size = frame.groupby("shard")["size"].sum()
    assert size.max() / size.mean() < 1.05 and size.min() / size.mean() > 0.95
    for _, g in frame.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    own = frame[frame["doc_id"].notna()].copy()
    own["text"] = own["doc_id"].map(text)
    spread = own.groupby("text")["shard"].nunique()
    weight = own.groupby("text")["size"].sum()
    assert spread["hot text " * 30] >= 6 and (weight[spread > 1] > sharding.HOT_SHARE * size.mean()).all()
    import zlib
    for r in rows[:200]:
        t = text.get(r.doc_id) or ""
        assert r.size == len(t.encode()) + 8 and r.text_crc32 == zlib.crc32(t.encode()) and r.grown_shard is None


def _weighted_cut(points, dim, share):
    points = sorted(points, key=lambda p: (p[dim], p["sub"]))
    want, run = share * sum(p["size"] for p in points), 0
    for p in points:
        if run + p["size"] > want:
            return run, run + p["size"], want
        run += p["size"]
    return run, run, want


def test_cuts_are_weighted_medians(spark):
    data = [(i, cases.prose(i, 3 + (i * i) % 150), None, "s", 0) for i in range(400)]
    pts = sharding.points(cases.frame(spark, data)).cache()
    plain = [r.asDict() for r in pts.collect()]
    root = sharding.Node(0, 24)
    sharding._cut_level(pts, root, [root], sum(p["size"] for p in plain) / 24)
    low = sum(p["size"] for p in plain if (p[root.dim], p["sub"]) < (root.key, root.sub))
    under, over, want = _weighted_cut(plain, root.dim, 0.5)
    assert under - 1 <= low <= over + 1 or abs(low - want) <= sharding.TOLERANCE * want
    widest = max(sharding.DIMENSIONS, key=lambda d: max(p[d] >> 36 for p in plain) - min(p[d] >> 36 for p in plain))
    assert root.dim == widest


def test_whole_tree_against_plain_python(spark):
    """Every node's dimension and cut, and every row's shard, recomputed from all points in plain Python."""
    data = [(i, cases.prose(i, 3 + (i * i) % 150), None, "s", 0) for i in range(700)]
    data += [(1000 + i, cases.prose(i % 40, 3 + ((i % 40) ** 2) % 150), None, "s", 0) for i in range(160)]  # groups of five
    data += [(3000 + i, "hot text " * 60, None, "s", 0) for i in range(500)]
    frame = cases.frame(spark, data)
    pts = sharding.points(frame).cache()
    plain = [r.asDict() for r in pts.collect()]
    target = sum(p["size"] for p in plain) / 24
    root, leaf = sharding.build_tree(pts), {}

    def walk(node, points):
        if node.low is None:
            leaf.update({p["doc_id"]: node.first for p in points})
            return
        width = lambda d: max(p[d] >> 36 for p in points) - min(p[d] >> 36 for p in points)
        assert width(node.dim) == max(width(d) for d in sharding.DIMENSIONS)
        under = lambda p: (p[node.dim], p["sub"]) < (node.key, node.sub)
        low, high = [p for p in points if under(p)], [p for p in points if not under(p)]
        want = sum(p["size"] for p in points) * (node.shards // 2) / node.shards
        at_cut = {}
        for p in points:
            at_cut[p[node.dim]] = at_cut.get(p[node.dim], 0) + p["size"]
        off = abs(sum(p["size"] for p in low) - want)
        # Within half of the text on the cut, or half of the tolerated bin.
        lightest = max((w for w in at_cut.values() if w <= sharding.HOT_SHARE * target), default=0)
        single = max(p["size"] for p in points)
        assert off <= max(lightest, single, sharding.TOLERANCE * target) / 2 + 1
        parted = {p[node.dim] for p in low} & {p[node.dim] for p in high}
        assert all(at_cut[k] > sharding.HOT_SHARE * target for k in parted)
        assert (node.low.first, node.low.shards + node.high.shards) == (node.first, node.shards)
        walk(node.low, low)
        walk(node.high, high)
    walk(root, plain)
    got = {r.doc_id: r.shard for r in sharding.assign(frame).collect()}
    assert got == leaf and set(got.values()) == set(range(24))


def test_extra_columns_called_like_the_shards_own(spark):
    docs = cases.frame(spark, [(i, cases.prose(i, 9), None, "s", 0) for i in range(60)])
    clash = docs.select("*", *[F.lit("x").alias(c) for c in ("size", "shard", "slot", "sub", "bucket", "node", "size_dim")])
    order = lambda df: sorted((r.doc_id, r.size, r.shard, r.slot) for r in df.collect())
    assert order(sharding.assign(clash)) == order(sharding.assign(docs))


def test_shards_of_an_empty_table(spark):
    assert sharding.assign(cases.frame(spark, [])).collect() == []


def test_every_operator_is_registered():
    names = [n for n in QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


# ------------------------------------------------------------------ the pipeline against plain Python

def _expected(data, kept_by_language):
    import public_tokenizers
    import tiktoken
    rows = [r for r in data if r[0] in kept_by_language]
    groups = {}
    for r in rows:
        k = cases.normal(r[1])
        best = groups.get(k)
        if best is None or (-len(r[1]), r[0]) < (-len(best[1]), best[0]):
            groups[k] = r
    rows = sorted(groups.values())
    root = cases.linked([cases.shingles(r[1], 5) for r in rows], 80)
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    planned = cases.duck(mixing.oracle(), cases.pandas_docs(rows))
    times = {int(r.doc_id): int(r.taken) // int(r.size) for r in planned.itertuples() if r.size}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=multi_ranks(), special_tokens={})
    out = []
    for r in rows:
        ids = enc.encode_ordinary(r[1])
        out += [(r[0], len(ids), cases.sha(np.array(ids, "<u4").tobytes()), cases.sha(r[1].encode()), str(ids))] * times[r[0]]
    return out


def test_pipeline_matches_plain_python(spark, tmp_path):
    data = [r for r in cases.rows() if r[0] is not None]
    cases.frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    known = {r[0] for r in data if r[1] and any(c.isalpha() for c in r[1])}
    cases.same_rows([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, str(r.ids)) for r in got], _expected(data, known))


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.filter("false"), SF_SMALL).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.filter("false"), SF_SMALL).count() == 0
