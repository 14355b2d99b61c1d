"""Rows and plain-Python versions that the tests of the training-data operators share."""

import hashlib
import re
from collections import Counter

import duckdb
import pandas as pd

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = ("amber birch cedar delta ember fjord grove haven inlet jetty knoll ledge marsh north ocean pearl quill ridge "
         "shore tidal under vapor water xenon yield zonal").split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 7))
    return " ".join(out)


def edited(text: str, at: list[int]) -> str:
    words = text.split(" ")
    for i in at:
        words[i] = f"changed{i}"
    return " ".join(words)


def rows() -> list[tuple]:
    """Nulls in every column, empty, white space only, very long, ties, repeated rows, near and exact copies."""
    long = prose(1, 30_000)
    base = prose(2, 120)
    out = [
        (0, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n\x0b\f\r ", "en", "a", 7), (3, "...!!", None, "b", 5),
        (4, long, "en", "a", len(long)), (5, long.replace(" ", "\n"), "en", "b", 1), (6, base, "en", "a", 1),
        (7, base, "en", "a", 1), (7, base, "en", "a", 1), (8, base + "  ", "en", "c", 1), (9, edited(base, [50]), "en", "c", 1),
        (10, edited(base, [50, 51, 52]), "de", "c", 1), (11, edited(base, [20, 90]), "de", None, 1), (12, "one two", "de", "b", 1),
        (13, "one  TWO", "de", "b", 1), (None, "no id here at all", "de", "b", 1), (None, "no id here at all", "de", "b", 1),
        (14, "Élan vital İstanbul 日本語 🙂", "fr", "é", 1), (15, "x", "fr", "z", 1),
    ]
    out += [(100 + i, prose(50 + i, 40 + i), "en" if i % 3 else "de", "abc"[i % 3], 1) for i in range(20)]
    group = prose(9, 100)
    out += [(200 + i, edited(group, [i, 99 - i] if i % 2 else [i, i + 30, 60 + i % 30, 8, 44, 71, 90][:5 + i % 3]), "en", "a", 1)
            for i in range(12)]
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text or ""))
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def linked(sets, percent):
    """Root index of every set's group of linked sets."""
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def duck(sql: str, documents: pd.DataFrame) -> pd.DataFrame:
    con = duckdb.connect()
    con.register("documents", documents)
    return con.sql(sql).df()


def pandas_docs(data) -> pd.DataFrame:
    df = pd.DataFrame(data, columns=["doc_id", "text", "lang", "source", "n_chars"])
    return df.astype({"doc_id": "Int64", "n_chars": "Int64"})


def same_rows(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert Counter(map(key, a)) == Counter(map(key, b))
