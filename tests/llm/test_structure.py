"""Merkle manifest, fill-in-the-middle and packing against plain-Python versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regiopanel.llm import fill_middle, merkle, packing
from regiopanel.llm.common import prepare, written
from regiopanel.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm import cases


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def case_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("cases")
    cases.frame(spark, DATA).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    cases.frame(spark, []).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def clash_dir(spark, tmp_path_factory):
    """Columns called like those the operators add."""
    path = tmp_path_factory.mktemp("clash")
    names = ["row", "tree", "leaf", "path", "root", "at", "size", "h1", "n", "form", "output", "g", "bin", "length", "piece", "row_no"]
    cases.frame(spark, DATA).select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)]).write.parquet(f"{path}/documents.parquet")
    return str(path)


DATA = cases.rows() + [(600 + i, f"Upper {i}", "en", "a", 1) for i in range(30)]
NEW = ["op11_merkle_manifest", "op12_fill_middle", "op13_best_fit_packing"]


@pytest.mark.parametrize("name", NEW)
def test_empty_tables_and_clashing_columns(spark, case_dir, empty_dir, clash_dir, name):
    plain = QUERIES[name](spark, case_dir)
    none = QUERIES[name](spark, empty_dir)
    assert none.columns == plain.columns and none.collect() == []
    drop = ["sequence_id", "offset"]   # numbers of sequences are free
    cases.same_rows([tuple(r) for r in plain.drop(*drop).collect()],
                    [tuple(r) for r in QUERIES[name](spark, clash_dir).drop(*drop).collect()])


# ------------------------------------------------------------------ Merkle manifest

def _h(*parts):
    return cases.sha("".join(parts).encode())


def _leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    values = [doc_id, source, lang, n_chars, cases.fold(text) if lower and text is not None else text]
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        top = levels[-1]
        levels.append([_h(*top[i:i + 16]) for i in range(0, len(top), 16)])
    return levels


def _steps(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 16 * 16:i // 16 * 16 + 16]
        out.append((run[:i % 16], run[i % 16 + 1:]))
        i //= 16
    return out


def _plain_manifest(data):
    """One tuple a row, by lists and loops."""
    by_source = defaultdict(list)
    for r in data:
        by_source[r[3]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        rows = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[s] = rows, _levels([_leaf(r) for r in rows])
    top = _levels([trees[s][1][-1][0] for s in order])
    root = top[-1][0]
    for k, s in enumerate(order):
        rows, levels = trees[s]
        for i, r in enumerate(rows):
            steps = _steps(levels, i) + _steps(top, k)
            crc = zlib.crc32(("" if r[0] is None else str(r[0])).encode())
            h = _leaf(r, lower=crc % 5 == 0)
            for left, right in steps:
                h = _h(*left, h, *right)
            proof = _h(*["".join(a + b) for a, b in steps])
            yield (r[0], _leaf(r), levels[-1][0], root, proof, h, h == root)


def test_manifest_of_awkward_rows(spark, case_dir):
    got = QUERIES["op11_merkle_manifest"](spark, case_dir).collect()
    cases.same_rows([tuple(r) for r in got], list(_plain_manifest(DATA)))
    assert any(not r.verified for r in got) and any(r.verified for r in got)


def test_manifest_sql_agrees_with_plain_python():
    data = [r for r in DATA if r[0] is not None]
    found = cases.duck(ORACLE["op11_merkle_manifest"], cases.pandas_docs(data))
    cases.same_rows([(int(r[0]), *r[1:]) for r in found.itertuples(index=False)], list(_plain_manifest(data)))


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_blocks_of_any_width_give_the_same_trees(spark, levels):
    # 5000 leaves of a hot source are 313, 20 or 2 blocks; up to four rounds.
    data = [(i, f"t{i}", None, "hot", i) for i in range(5000)] + [(10_000 + i, "x", "en", f"s{i:03d}", 1) for i in range(300)]
    data += [(20_000 + i, "y", "en", None, 1) for i in range(17)]
    leaves = written(cases.frame(spark, data).select("doc_id", "source", merkle.leaf().alias("leaf")), "leaves")
    found = merkle.manifest(leaves, levels=levels)
    got = found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("p"),
                       merkle.fold(F.col("leaf"), F.col("path")).alias("f")).collect()
    want = list(_plain_manifest(data))
    cases.same_rows([tuple(r)[:5] for r in got], [w[:5] for w in want])
    assert {r.f for r in got} == {want[0][3]}


def test_one_document_is_its_own_root(spark):
    leaves = written(cases.frame(spark, [(1, "a", None, "s", 1)]).select("doc_id", "source", merkle.leaf().alias("leaf")), "leaves")
    (r,) = merkle.manifest(leaves).collect()
    assert r.leaf == r.subroot == r.root and r.path == []


def test_no_task_holds_a_tree(spark):
    """Leaves are gathered by (source, block): no exchange on the source alone carries leaves."""
    data = [(i, f"t{i}", None, "hot", i) for i in range(600)]
    leaves = written(cases.frame(spark, data).select("doc_id", "source", merkle.leaf().alias("leaf")), "leaves")
    nodes = leaves.select(F.col("source").alias("tree"), F.col("leaf").alias("digest"), F.struct("doc_id").alias("row"))
    made = merkle.forest(nodes, [F.col("row.doc_id")], levels=1)
    first = made.rounds[0]
    assert first.count() == 38 and first.agg(F.max(F.size("rows"))).first()[0] == 16
    assert [b.count() for b in made.rounds] == [38, 3, 1]


# ------------------------------------------------------------------ fill in the middle

def _plain_fim(row, rate=100, spm=50):
    doc_id, text = row[0], row[1] or ""
    h = cases.sha(f"7:{'' if doc_id is None else doc_id}".encode())
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, cases.sha(text.encode()), cases.sha(text.encode())
    a, b = sorted([h1 % (n + 1), h2 % (n + 1)])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < spm else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), cases.sha(out.encode()), cases.sha(text.encode())


def _line_cases():
    texts = ["\n", "\n\n\n", "a", "a\n", "a\nb", "\na", "é\n日本\n🙂🙂\r\nx", "x <P> y\nz", "<S>", "a\n<M>\n", "<\nP>\nS>", "ends with <", "<S\n>",
             "\n" * 5000, "w " * 9000 + "\n" + "q\n" * 3000 + "long " * 4000, " \x0b\x0c\x85 one line"]
    return cases.rows() + [(500 + i, t, "en", "a", 1) for i, t in enumerate(texts)] + [(900 + i, "u\nv\nw\nx", "en", "a", 1) for i in range(40)]


def test_fim_equals_plain_python(spark):
    docs = cases.frame(spark, _line_cases())
    cases.same_rows([tuple(r) for r in fill_middle.fim(docs).collect()], [_plain_fim(r) for r in _line_cases()])
    some = fill_middle.Params(rate=60, spm=30)
    got = [tuple(r) for r in fill_middle.fim(docs, some).collect()]
    cases.same_rows(got, [_plain_fim(r, 60, 30) for r in _line_cases()])
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fim_sql_agrees_with_plain_python():
    data = [r for r in _line_cases() if r[0] is not None]
    found = cases.duck(ORACLE["op12_fill_middle"], cases.pandas_docs(data)).astype({"prefix_chars": "Int64", "middle_chars": "Int64"})
    got = [tuple(None if pd.isna(v) else v for v in r) for r in found.itertuples(index=False)]
    cases.same_rows(got, [_plain_fim(r) for r in data])


def test_outputs_are_restored_by_spark(spark):
    docs = cases.frame(spark, _line_cases()).withColumn("output", F.lit("mine")).withColumn("n", F.lit(0))
    made = fill_middle.restored(fill_middle.transform(docs))
    assert made.schema["row"].dataType.names == docs.columns
    rows = made.collect()
    assert len(rows) == len(_line_cases()) and all(r.restored == (r.row.text or "") for r in rows)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2000), max_size=400), st.sampled_from([1, 4, 127, 1000]))
def test_rank_index_is_exact_and_bounded(steps, error):
    y = np.concatenate([[0], np.cumsum(steps)]).astype(np.int64)
    index = fill_middle.RankIndex(y, error)
    assert (index[np.arange(len(y))] == y).all() and index[len(y) - 1] == y[-1]
    assert np.abs(index.residual.astype(np.int64)).max() <= error


def test_rank_index_is_smaller_than_the_offsets():
    rng = np.random.default_rng(5)
    y = np.cumsum(rng.integers(30, 90, 50_000))
    index = fill_middle.RankIndex(y)
    assert len(index.first) < 50_000 / 40 and index.residual.dtype == np.int8
    assert len(fill_middle.RankIndex(np.arange(1_000_000) * 7).first) == 1


# ------------------------------------------------------------------ packing

@pytest.fixture(scope="module")
def definition():
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def whole(definition):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(definition)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids + [1]


ODD = ["", " ", "á ́b", "don't DON'T we're 's 't", "ﬁ Å ÅNGSTRÖM İstanbul ΣΑΣ ς", "x y z　w \x1c\x1d\x1e\x1f\x85 q", "<|endoftext|> a<|startoftext|>b <|EndOfText|>",
       "日本語 テキスト 한국어 ก็", "👩‍👩‍👧 🙂🙂", "12345 1 2 ½ ٣", "éé\te\n̈", "﻿bom ​zero", "A" * 3000, "...!!--- ((()))",
       "x's 5's ..'s ''t O'Neil \"quoted\" a_b-c/d.e é, É. ÷× é÷2 3×4 café's naïve?", "A\u0301. e\u0301, =\u0338 x\u0338y 1\u0301", "\x00\x01a\x7fb"]


def test_word_ids_equal_whole_texts(definition, whole):
    from regiopanel.llm.common import text_chunks
    import pyarrow as pa
    texts = ODD + [r[1] for r in cases.rows()] + ODD[::-1]
    tok = packing.WordTokenizer(definition)
    at_row = 0
    for i, j, data, off in text_chunks(pa.array(texts, pa.string()), limit=200):
        ids, at = tok.encode(data, off)
        for r in range(j - i):
            assert ids[at[r]:at[r + 1]].tolist() == whole(texts[i + r])[:-1], texts[i + r]
            at_row += 1
    assert at_row == len(texts)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("aB's.,<|>1é×÷ \u0301\u0338\u2014tl", max_size=40)))
def test_word_ids_of_any_text(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    if not hasattr(test_word_ids_of_any_text, "tok"):
        with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
            d = f.read()
        test_word_ids_of_any_text.tok = packing.WordTokenizer(d), Tokenizer.from_str(d)
    tok, plain = test_word_ids_of_any_text.tok
    raw = np.frombuffer(text.encode("utf-8", "ignore"), np.uint8)
    ids, _ = tok.encode(raw, np.array([0, len(raw)]))
    assert ids.tolist() == plain.encode(raw.tobytes().decode(), add_special_tokens=False).ids


def _check_pieces(rows, data, whole, sequence):
    """Pieces rebuild the documents, and every sequence is gapless and no longer than allowed."""
    want = Counter()
    for doc_id, text, *_ in data:
        ids = whole(text)
        for k, s in enumerate(range(0, len(ids), sequence)):
            part = ids[s:s + sequence]
            want[(doc_id, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= sequence
    return len(by)


def test_packed_pieces_rebuild_the_documents(spark, case_dir, whole):
    rows = QUERIES["op13_best_fit_packing"](spark, case_dir).collect()
    n = _check_pieces(rows, DATA, whole, 4096)
    assert n == math.ceil(sum(r.length for r in rows) / 4096)


def test_rounds_over_small_groups_lose_nothing(spark, definition, whole):
    # A third of the rows share one id; groups of 64 pieces (some 30 sequences) need several rounds.
    data = [(7 if i % 3 == 0 else i, cases.prose(i % 40, 1 + (i * 13) % 60), None, None, None) for i in range(900)]
    rows = packing.pack_documents(cases.frame(spark, data), definition, sequence=128, group=64).collect()
    n = _check_pieces(rows, data, whole, 128)
    assert n <= 1.06 * packing.lower_bound(np.array([r.length for r in rows]), 128)
    assert len({-1 - r.sequence_id >> 56 for r in rows if r.sequence_id < 0}) >= 3


def _fewest(sizes, capacity):
    """Least number of bins, by trying everything."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for b in sorted(set(bins)):
            if b + sizes[i] <= capacity:
                k = bins.index(b)
                place(i + 1, bins[:k] + [b + sizes[i]] + bins[k + 1:])
        place(i + 1, [*bins, sizes[i]])
    place(0, [])
    return best[0]


def test_packs_of_small_sets_are_near_the_fewest():
    rng = random.Random(3)
    over = 0
    for _ in range(120):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(0, 11))]
        found, fewest = packing.pack(sizes, 50), _fewest(sizes, 50)
        bins = np.count_nonzero(found.fill)
        assert packing.lower_bound(np.array(sizes, np.int64), 50) <= fewest <= bins <= fewest + 1
        over += bins > fewest
    assert over <= 3


def test_search_empties_bins_that_best_fit_leaves():
    rng = random.Random(8)
    sizes = [rng.randint(100, 1900) for _ in range(4000)]
    start = packing.best_fit(sizes, 4096)
    before = np.array([sum(sizes[i] for i in b) for b in start])
    found = packing.Search(sizes, start, 4096).run()
    assert np.count_nonzero(found.fill) < len(start) and found.fill.sum() == sum(sizes) and found.fill.max() <= 4096
    assert all(found.steps[k] for k in ("move", "swap", "pair"))
    assert (found.fill ** 2).sum() > (before ** 2).sum()
    assert np.count_nonzero(found.fill) <= 1.005 * found.least
    assert sorted(i for b in found.bins for i in b) == list(range(4000))


def test_packing_of_sf_small_reaches_the_bound(spark):
    rows = QUERIES["op13_best_fit_packing"](spark, SF_SMALL).select("length", "sequence_id").collect()
    assert len({r.sequence_id for r in rows}) == packing.lower_bound(np.array([r.length for r in rows]), 4096)
