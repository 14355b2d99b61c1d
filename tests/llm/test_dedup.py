import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from regiopanel.llm import embedding_dedup, exact_dedup, near_dedup
from regiopanel.llm.common import prepare
from regiopanel.session import scratch_path
from tests.llm import cases


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


def _exact(data):
    groups = defaultdict(list)
    for i, r in enumerate(data):
        groups[cases.normal(r[1])].append(i)
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda i: (-len(data[i][1] or ""), data[i][0] is None, data[i][0] or 0))
        for i in members:
            out.append((data[i][0], data[best][0], len(members), cases.sha(text.encode())))
    return out, len(groups)


def test_exact_dedup_matches_brute_force(spark):
    data = cases.rows()
    got = exact_dedup.ingest(cases.frame(spark), exact_dedup.new_index(spark)).collect()
    want, n_groups = _exact(data)
    cases.same_rows([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], want)
    assert sum(r.kept for r in got) == n_groups  # one row of each group, repeated rows included
    assert all(r.kept <= (r.doc_id == r.keep_id or r.keep_id is None) for r in got)


def test_exact_dedup_index_outlives_batches_and_names(spark):
    path = scratch_path(spark, "index-test")
    first = exact_dedup.DigestIndex(spark, path, buckets=4)
    a = spark.createDataFrame([(1, "x y"), (2, "xy"), (3, "z")], "doc_id bigint, text string")
    b = spark.createDataFrame([(4, "x  y longer? no"), (5, "x\ty"), (6, "new"), (7, "n e w")], "doc_id bigint, text string")
    assert {r.doc_id for r in exact_dedup.ingest(a, first).collect() if r.kept} == {1, 3}
    again = exact_dedup.DigestIndex(spark, path, buckets=4)
    got = {r.doc_id: r for r in exact_dedup.ingest(b, again).collect()}
    assert {i for i, r in got.items() if r.kept} == {4, 7} and got[5].keep_id == 1
    assert again.read().count() == 4
    # One file a bucket and batch at most.
    files = [f for f in again.read().inputFiles()]
    assert len(files) <= 2 * 4 and len({f.rsplit("_", 1)[1] for f in files}) <= 4


def _with_partitions(spark, n, run):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        return run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_exact_dedup_index_keeps_its_buckets(spark):
    """Reopened under another number of partitions, the index still knows what it has seen."""
    path = scratch_path(spark, "index-buckets")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id bigint, text string")
    first = _with_partitions(spark, 8, lambda: exact_dedup.DigestIndex(spark, path))
    _with_partitions(spark, 8, lambda: exact_dedup.ingest(docs, first).collect())
    first.close()
    again = _with_partitions(spark, 5, lambda: exact_dedup.DigestIndex(spark, path))
    assert again.buckets == 8
    more = docs.union(spark.createDataFrame([(900, "only here")], docs.schema))
    got = _with_partitions(spark, 5, lambda: exact_dedup.ingest(more, again).collect())
    assert len(got) == 201 and [r.doc_id for r in got if r.kept] == [900]
    assert again.read().count() == 201
    with pytest.raises(ValueError, match="8 buckets"):
        exact_dedup.DigestIndex(spark, path, buckets=4)
    again.close()
    assert not spark.catalog.tableExists(again.table) and not spark.catalog.tableExists(first.table)


def test_exact_dedup_batch_may_be_tried_again(spark):
    path = scratch_path(spark, "index-retry")
    index = exact_dedup.DigestIndex(spark, path, buckets=4)
    a = spark.createDataFrame([(1, "x y"), (2, "xy"), (3, "z"), (3, "z")], "doc_id bigint, text string")
    b = spark.createDataFrame([(4, "xy"), (5, "q")], "doc_id bigint, text string")
    once = sorted(map(tuple, exact_dedup.ingest(a, index, "monday").collect()))
    twice = sorted(map(tuple, exact_dedup.ingest(a, index, "monday").collect()))
    assert once == twice and sum(r[3] for r in once) == 2 and index.read().count() == 2
    # A try that had added a part only, and one through another handle.
    part = exact_dedup.DigestIndex(spark, path)
    got = {r.doc_id: r.kept for r in exact_dedup.ingest(b.filter("doc_id = 5"), part, "tuesday").collect()}
    assert got == {5: True}
    assert {r.doc_id: r.kept for r in exact_dedup.ingest(b, index, "tuesday").collect()} == {4: False, 5: True}
    assert {r.doc_id: r.kept for r in exact_dedup.ingest(a, index, "wednesday").collect()} == {1: False, 2: False, 3: False}
    assert index.read().count() == 3
    rows = exact_dedup.drop_duplicates(a, index, "monday")
    assert sorted(map(tuple, rows.collect())) == [(1, "x y"), (3, "z")]


def test_exact_dedup_refuses_text_ids_by_name(spark):
    docs = spark.createDataFrame([("a1", "x")], "doc_id string, text string")
    for run in (lambda: exact_dedup.ingest(docs, exact_dedup.new_index(spark)), lambda: exact_dedup.drop_duplicates(docs)):
        with pytest.raises(TypeError, match="doc_id"):
            run()


def test_exact_dedup_anti_join_does_not_shuffle_the_index(spark):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index-plan"), buckets=4)
    docs = cases.frame(spark)
    exact_dedup.ingest(docs, index).count()
    groups = exact_dedup._groups(exact_dedup._stage(docs))
    plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    right = plan[plan.index("FileScan"):] if plan.index("FileScan") < plan.index("Exchange") else plan[plan.rindex("FileScan"):]
    assert "Python" not in plan and "digest_index" in plan and right


def test_exact_dedup_carries_clashing_columns_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "p", "q"), (2, "a ", "r", "s"), (2, "a ", "r", "s")],
                                 "doc_id bigint, text string, digest string, row_no string")
    got = exact_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == [(2, "a ", "r", "s")]
    empty = cases.frame(spark, [])
    assert exact_dedup.ingest(empty, exact_dedup.new_index(spark)).collect() == []
    assert exact_dedup.drop_duplicates(empty).collect() == []


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_dedup_matches_brute_force(spark, words, percent):
    data = [r for r in cases.rows() if r[0] is not None]
    sets = [cases.shingles(r[1], words) for r in data]
    root = cases.linked(sets, percent)
    least = {}
    for i, r in enumerate(data):
        least[root[i]] = min(least.get(root[i], r[0]), r[0])
    p = near_dedup.Params(words, percent)
    got = near_dedup.near_duplicates(cases.frame(spark, data), p).collect()
    cases.same_rows([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got],
                    [(r[0], len(sets[i]), least[root[i]], r[0] == least[root[i]]) for i, r in enumerate(data)])


def test_near_dedup_settles_a_dense_group_below_the_threshold(spark):
    # All share bands with the first; most are linked only through others, or not at all.
    base = cases.prose(77, 60)
    data = [(0, cases.edited(base, list(range(0, 18, 2))), None, None, 0)]
    data += [(i, cases.edited(base, [j for j in range(40, 40 + i % 5)]), None, None, 0) for i in range(1, 15)]
    data += [(100 + i, cases.edited(base, [i, 20 + i, 40 + i, 7, 33]), None, None, 0) for i in range(15)]
    data += [(200 + i, cases.edited(base, [i, 20 + i, 40 + i, 7, 33, 50]), None, None, 0) for i in range(15)]
    sets = [cases.shingles(r[1], 3) for r in data]
    root = cases.linked(sets, 85)
    want = {r[0]: data[root[i]][0] for i, r in enumerate(data)}
    got = near_dedup.near_duplicates(cases.frame(spark, data), near_dedup.Params(3, 85)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_blocks_find_every_link_of_a_group():
    p = near_dedup.Params(3, 85)
    mult, rng, sets = near_dedup._multipliers(p), np.random.default_rng(4), []
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    for _ in range(120):
        new = base.copy()
        at = rng.choice(200, rng.integers(0, 25), replace=False)
        new[at] = rng.integers(0, 2**63, len(at), dtype=np.uint64)
        sets.append(np.unique(new))
    sketch = near_dedup.odd_sketches(np.stack([near_dedup.min_hashes(s, mult) for s in sets])).view(">i8").astype(np.int64)
    rows = [{"own": own, "cid": i, "comp": i, "sketch": sketch[i], "members": sets[i].view(np.int64)}
            for own in (True, False) for i in range(len(sets))]
    got = near_dedup._block_links(p)(pd.DataFrame(rows))
    want = set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            if i != j and 100 * both >= 85 * (len(a) + len(b) - both):
                want.add((i, j))
    assert len(want) > 500 and set(zip(got["a"], got["b"])) == want


def test_near_dedup_null_ids_extra_columns_and_empty_tables(spark):
    base = cases.prose(5, 80)
    data = [(None, base, "p"), (None, base + " end", "q"), (3, base, "r"), (4, None, "s"), (5, " ", "t"), (5, " ", "t")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, n string")
    got = near_dedup.near_duplicates(docs, near_dedup.Params()).collect()
    assert len(got) == 6 and {r.component_id for r in got if r.n_shingles} == {3}
    kept = near_dedup.drop_near_duplicates(docs, near_dedup.Params())
    assert kept.columns == docs.columns
    cases.same_rows([tuple(r) for r in kept.collect()], [data[2], *data[3:]])
    empty = cases.frame(spark, [])
    assert near_dedup.near_duplicates(empty).collect() == [] and near_dedup.drop_near_duplicates(empty).collect() == []


def test_odd_sketches_estimate_high_similarity():
    p = near_dedup.Params(3, 85)
    mult, rng, errors = near_dedup._multipliers(p), np.random.default_rng(1), []
    for similar in (0.85, 0.9, 0.95, 1.0):
        for _ in range(40):
            both = int(400 * similar)
            s = rng.integers(0, 2**63, 800 - both, dtype=np.uint64)
            a, b = s[:400], np.concatenate([s[:both], s[400:]])
            sk = near_dedup.odd_sketches(np.stack([near_dedup.min_hashes(x, mult) for x in (a, b)]))
            bits = int(np.bitwise_count(sk[0] ^ sk[1]).sum())
            true = both / (800 - both)
            errors.append(abs(near_dedup.estimate(bits, p) - true))
            if true >= 0.85:
                assert bits <= p.most_bits
    assert np.mean(errors) < 0.06


def _vectors():
    rng = np.random.default_rng(3)
    out, vid = [], 0
    for size in (1, 1, 1, 2, 5, 40):
        centre = rng.standard_normal(64)
        for _ in range(size):
            out.append((vid, (centre + rng.standard_normal(64) * 0.18).astype(np.float32).tolist()))
            vid += 1
    out += [(vid + i, rng.standard_normal(64).astype(np.float32).tolist()) for i in range(250)]
    vid += 250
    same = out[7][1]
    out += [(vid, same), (vid + 1, same), (vid + 2, None), (vid + 3, [0.0] * 64), (vid + 4, [float("nan")] + [1.0] * 63),
            (vid + 5, [float("inf")] + [1.0] * 63), (vid + 6, [None] + [1.0] * 63), (vid + 7, []), (vid + 8, [2 * x for x in same])]
    return out


def test_embedding_dedup_recall_against_brute_force(spark):
    data = _vectors()
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(
        spark.createDataFrame(data, "vec_id bigint, embedding array<float>")).collect()}
    good = [i for i, (_, v) in enumerate(data) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.array([data[i][1] for i in good], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    ids = np.array([data[i][0] for i in good])
    assert len(got) == len(data)
    found = np.array([got[i].n_links for i in ids])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.97 * near.sum()
    label = ids.copy()
    for _ in range(len(ids)):
        label = np.minimum(label, np.where(near, label[None, :], 10**9).min(axis=1))
    assert np.mean(np.array([got[i].component_id for i in ids]) == label) >= 0.99
    for i, (vid, _) in enumerate(data):
        if i not in good:
            assert (got[vid].n_links, got[vid].component_id, got[vid].kept) == (0, vid, True)


def test_embedding_dedup_empty_and_null_ids(spark):
    schema = "vec_id bigint, embedding array<float>, v string"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    v = [1.0, 0.5, 0.25]
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(None, v, "a"), (2, v, "b"), (2, v, "b")], schema)).collect()
    assert sorted((r.n_links, r.component_id) for r in got) == [(2, 2)] * 3


def test_embedding_dedup_scales_before_the_norm(spark):
    data = [(0, [1e200, 2e200]), (1, [1e-200, 2e-200]), (2, [1.0, 2.0]), (3, [2.0, -1.0]), (4, None), (5, [0.0, 0.0])]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(data, "vec_id bigint, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(0, 2, 0), (1, 2, 0), (2, 2, 0), (3, 0, 3), (4, 0, 4), (5, 0, 5)]


def test_embedding_dedup_hot_vectors_and_many_nulls(spark):
    rng = np.random.default_rng(10)
    hot = rng.standard_normal(16)
    near = hot + 0.01 * rng.standard_normal(16)
    data = [(i, hot.tolist()) for i in range(1500)] + [(1500, near.tolist())] + [(i, None) for i in range(1501, 2500)]
    data += [(2500 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 16)))]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(data, "vec_id bigint, embedding array<double>")).collect()}
    assert len(got) == len(data) == 3100
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (1500, 0, i == 0) for i in range(1501))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(1501, 2500))


def test_hamming_bound_keeps_pairs_at_the_threshold_and_parts_unrelated_ones():
    rng = np.random.default_rng(11)
    unit = rng.standard_normal((3000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    model = embedding_dedup.fit(unit, 3000)
    bound = embedding_dedup.hamming_bound(unit, model)
    x = _pairs(rng, 1500, 64, 0, 0.95)
    code = embedding_dedup.code_bits(x, *model)
    assert ((code[::2] != code[1::2]).sum(1) <= bound).all()
    assert ((code[:-2:2] != code[2::2]).sum(1) > bound).mean() > 0.95
    assert (embedding_dedup.unpacked(embedding_dedup.packed(code), code.shape[1]) == code).all()


def _recall(spark, data, lengths):
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(data, "vec_id bigint, embedding array<double>")).collect()}
    share = {}
    for d in lengths:
        own = [(i, v) for i, v in data if len(v) == d]
        x = np.array([v for _, v in own])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        links = (x @ x.T >= 0.95).sum(1) - 1
        found = np.array([got[i].n_links for i, _ in own])
        assert (found <= links).all() and links.sum()
        share[d] = found.sum() / links.sum()
    return share


def _pairs(rng, n, d, common, cosine):
    """Unit vectors around a common direction; each second one is at ``cosine`` from the one before."""
    x = rng.standard_normal((n, d))
    x[:, 0] += common * math.sqrt(d)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = rng.standard_normal((n, d))
    g -= (g * x).sum(1, keepdims=True) * x
    y = cosine * x + math.sqrt(1 - cosine**2) * g / np.linalg.norm(g, axis=1, keepdims=True)
    return np.stack([x, y], 1).reshape(2 * n, d)


def test_embedding_dedup_recall_with_a_common_direction(spark):
    x = _pairs(np.random.default_rng(8), 1500, 64, 1.5, 0.955)
    assert 0.8 < np.linalg.norm(x.mean(0)) < 0.9
    assert _recall(spark, list(enumerate(x.tolist())), [64])[64] >= 0.95


def test_embedding_dedup_links_vectors_of_every_length(spark):
    rng = np.random.default_rng(9)
    parts = [*_pairs(rng, 300, 48, 0, 0.97), *_pairs(rng, 200, 32, 0, 0.97), *_pairs(rng, 10, 7, 0, 0.97)]
    data = [(i, v.tolist()) for i, v in enumerate(parts)]
    share = _recall(spark, data, [48, 32, 7])
    assert min(share.values()) >= 0.95 and share[7] == 1


def test_table_plan_follows_the_logarithm():
    small, large = embedding_dedup.plan_tables(1000), embedding_dedup.plan_tables(10**9)
    assert small[0] < large[0] < 40 and small[1] < large[1] < 250
