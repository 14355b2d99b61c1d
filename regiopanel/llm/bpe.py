"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its
encoding: the token whose own start has a last token with which it forms a
valid pair (BPE on the two tokens' bytes gives the two back). A table of these
last tokens encodes a piece left to right, gives the encoding of every prefix,
grows by exact appends, and is recomputed only from an edit on
(``PrefixTable``).

Texts are cut by the pattern of the vocabulary (letters, numbers, other signs,
white space, English contractions) with array operations over whole batches;
each distinct piece is encoded once per worker and its ids are copied to all
its places. A piece that is itself in the vocabulary is that token.

Defined results: null and empty texts give no ids; an empty table gives an empty
result; very long texts are encoded whole; repeated rows give equal results; further columns are ignored by ``encode``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from regiopanel.llm.common import mixed, prefix_sums, text_chunks, _power, _LOW_I, _HIGH_I

#: Pieces whose ids a worker remembers; the memory starts anew beyond that.
CACHE_PIECES = 400_000
CACHE_PAIRS = 250_000


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}


class Vocabulary:
    """Ranks of tokens, and which pairs of tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.by_id = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.pairs: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Plain BPE: merge the adjacent parts of lowest joint rank until none is left. Used on two tokens at a time."""
        get = self.ranks.get
        none = len(self.ranks) + 1
        cuts = list(range(len(piece) + 1))
        joint = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while joint:
            low = min(joint)
            if low == none:
                break
            i = joint.index(low)
            del cuts[i + 1], joint[i]
            if i < len(joint):
                joint[i] = get(piece[cuts[i]:cuts[i + 2]], none)
            if i:
                joint[i - 1] = get(piece[cuts[i - 1]:cuts[i + 1]], none)
        return [self.ranks[piece[x:y]] for x, y in zip(cuts, cuts[1:])]

    def whole(self, token: int) -> bool:
        """Whether BPE makes the token out of its own bytes."""
        got = self._whole.get(token)
        if got is None:
            got = self._whole[token] = self.merged(self.by_id[token]) == [token]
        return got

    def pair(self, left: int, right: int) -> bool:
        key = left << 32 | right
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = self.merged(self.by_id[left] + self.by_id[right]) == [left, right]
        return got


class PrefixTable:
    """Last token of every prefix of a growing byte string.

    ``extend`` appends bytes; ``splice`` replaces a span and recomputes from it
    on, stopping where the old entries must hold again; ``tokens`` reads the
    encoding of any prefix.
    """

    def __init__(self, vocab: Vocabulary, data: bytes = b""):
        self.vocab = vocab
        self.data = b""
        self.last: list[int] = []
        self.extend(data)

    def _last_at(self, end: int) -> int:
        v, data, last = self.vocab, self.data, self.last
        get, pairs = v.ranks.get, v.pairs
        for start in range(max(0, end - v.longest), end):
            token = get(data[start:end])
            if token is not None:
                if start:
                    ok = pairs.get(last[start - 1] << 32 | token)
                    if ok is None:
                        ok = v.pair(last[start - 1], token)
                else:
                    ok = v.whole(token)
                if ok:
                    return token
        raise ValueError("the vocabulary lacks a byte")

    def extend(self, more: bytes) -> None:
        n = len(self.data)
        self.data += more
        for end in range(n + 1, len(self.data) + 1):
            self.last.append(self._last_at(end))

    def truncate(self, end: int) -> None:
        """Back to the first ``end`` bytes; their entries stay as they are."""
        self.data = self.data[:end]
        del self.last[end:]

    def splice(self, start: int, stop: int, new: bytes) -> int:
        """Replace ``data[start:stop]``; returns how many entries were computed anew."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        same, reach = 0, self.vocab.longest
        end = start
        while end < len(self.data):
            end += 1
            self.last.append(self._last_at(end))
            before = end - shift
            if end > start + len(new) and self.last[-1] == old[before - 1]:
                same += 1
            else:
                same = 0
            # With a token's length of equal entries on unchanged bytes, all later ones are equal too.
            if same >= reach:
                self.last += old[before:]
                break
        return end - start

    def tokens(self, end: int | None = None) -> list[int]:
        out, at = [], len(self.data) if end is None else end
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.vocab.by_id[token])
        return out[::-1]


def encode_piece(vocab: Vocabulary, piece: bytes) -> list[int]:
    token = vocab.ranks.get(piece)
    return [token] if token is not None else PrefixTable(vocab, piece).tokens()


def encode_pieces(vocab: Vocabulary, pieces: list[bytes]) -> list[list[int]]:
    """Ids of many pieces: in byte order, so that each keeps the table entries of the prefix it shares with the last."""
    out: list[list[int]] = [[]] * len(pieces)
    table, get = PrefixTable(vocab), vocab.ranks.get
    for i in sorted(range(len(pieces)), key=pieces.__getitem__):
        piece = pieces[i]
        token = get(piece)
        if token is not None:
            out[i] = [token]
            continue
        n, before = 0, table.data
        while n < len(before) and n < len(piece) and before[n] == piece[n]:
            n += 1
        table.truncate(n)
        table.extend(piece[n:])
        out[i] = table.tokens()
    return out


# ---------------------------------------------------------------- cutting texts into pieces

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point, by the pattern's own terms."""
    table = np.full(0x110000, OTHER, np.uint8)
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    text = "".join(points)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, text):
            a, b = ord(text[m.start()]), ord(text[m.end() - 1])
            if b - a == m.end() - m.start() - 1:
                table[a:b + 1] = kind
            else:  # the run spans the surrogates
                for ch in m.group():
                    table[ord(ch)] = kind
    return table


def cut(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Starts of the pieces of texts laid end to end; ``first``: starts of the non-empty texts.

    The cutting rules: runs of letters, of numbers and of other signs, each
    with one space before it if there is one; white space that is left, less its
    last character where a sign follows; 's 't 're 've 'm 'll 'd where a piece
    would begin with the apostrophe.
    """
    n = len(points)
    kind = _classes()[points]
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    begins[n] = True
    change = begins.copy()
    change[1:n] |= kind[1:] != kind[:-1]
    start = change[:n].copy()
    # The last character of a white-space run, when something of the same text follows.
    space = kind == SPACE
    tail = np.flatnonzero(space[:-1] & ~space[1:] & ~begins[1:n])
    start[tail] = True
    joined = tail[points[tail] == 0x20]
    start[joined + 1] = False
    # Contractions: a lone apostrophe that starts a piece, followed by letters of the same text.
    ap = np.flatnonzero((points == 0x27) & start)
    ap = ap[ap + 1 < n]
    ap = ap[~begins[ap + 1] & (kind[ap + 1] == LETTER)]
    if len(ap):
        one = points[ap + 1]
        single = np.isin(one, [ord(c) for c in "stmd"])
        has2 = (ap + 2 < n)
        nxt = np.minimum(ap + 2, n - 1)
        two = np.where(has2 & ~begins[nxt], points[nxt], 0)
        double = ~single & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
                            | ((one == ord("l")) & (two == ord("l"))))
        for which, length in ((single, 2), (double, 3)):
            at = ap[which]
            start[at + 1] = False
            after = at + length
            start[after[after < n]] = True
    return np.flatnonzero(start)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``starts[i] : starts[i] + lens[i]``."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


class Encoder:
    """Encodes batches of texts; remembers the ids of pieces by their 64-bit hash."""

    def __init__(self, ranks: dict[bytes, int]):
        self.vocab = Vocabulary(ranks)
        size = max(ranks.values(), default=-1) + 1
        lens = np.zeros(size, np.int64)
        for b, i in ranks.items():
            lens[i] = len(b)
        self.token_len = lens
        self.token_at = np.concatenate([[0], np.cumsum(lens)])[:-1]
        by_id = self.vocab.by_id
        self.token_bytes = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(size)), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros((1 << 14, 2), np.int64)
        self.used = 0

    def _learn(self, keys: list[int], pieces: list[bytes]) -> None:
        for key, ids in zip(keys, encode_pieces(self.vocab, pieces), strict=True):
            k = len(self.known)
            if k == len(self.at):
                self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used:self.used + len(ids)] = ids
            self.at[k] = self.used, len(ids)
            self.used += len(ids)
            self.known[key] = k

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of each text's ids."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        text = data.tobytes().decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)           # byte at which each character starts
        chars = np.searchsorted(lead, off)                     # text offsets in characters
        full = np.flatnonzero(np.diff(chars) > 0)
        starts = cut(points, chars[:-1][full])
        ends = np.append(starts[1:], len(points))
        with np.errstate(over="ignore"):
            values = mixed(points.astype(np.uint64) + np.uint64(0x1234567))
            acc = prefix_sums(values)
            keys = mixed((acc[ends] - acc[starts]) * _power(starts, _LOW_I, _HIGH_I) + (ends - starts).astype(np.uint64))
        distinct, where, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > CACHE_PIECES:
            self._forget()
        known, names = self.known, distinct.tolist()
        new = [i for i, key in enumerate(names) if key not in known]
        at = where[new]
        self._learn([names[i] for i in new],
                    [text[x:y].encode("utf-8") for x, y in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        slot = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        piece = self.at[slot[back]]
        ids = self.ids[ragged(piece[:, 0], piece[:, 1])]
        upto = np.concatenate([[0], np.cumsum(piece[:, 1])])
        return ids, upto[np.searchsorted(starts, chars)]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[ragged(self.token_at[ids], self.token_len[ids])].tobytes()


_ENCODERS: dict[str, Encoder] = {}


def _stamp(ranks: dict[bytes, int]) -> str:
    return hashlib.sha256(b"".join(b"%d:%d:%s" % (i, len(b), b) for b, i in sorted(ranks.items()))).hexdigest()


def _encoder(shared, stamp: str) -> Encoder:
    # One encoder per worker and vocabulary: the pieces it has met stay known to its later tasks.
    if stamp not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[stamp] = Encoder(shared.value)
    return _ENCODERS[stamp]


def _encode(shared, stamp: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared, stamp)
        for batch in batches:
            doc_id = batch.column("doc_id")
            for i, j, data, off in text_chunks(batch.column("text")):
                ids, at = enc.encode(data, off)
                rows = [ids[at[r]:at[r + 1]] for r in range(j - i)]
                cols = {
                    "doc_id": doc_id.slice(i, j - i),
                    "n_tokens": pa.array(np.diff(at), pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in rows], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(enc.decode(x)).hexdigest() for x in rows], pa.string()),
                }
                if with_ids:
                    cols["ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32), pa.int32()))
                yield pa.RecordBatch.from_pydict(cols)
    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (little-endian unsigned 32-bit ids), decoded_sha256; with ``with_ids`` the ids too."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(_encode(shared, _stamp(ranks), with_ids), schema)


def _decode(shared, stamp: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared, stamp)
        for batch in batches:
            texts = [None if x is None else enc.decode(np.array(x, np.int64)).decode("utf-8", "replace")
                     for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})
    return run


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id and text of rows with ``ids`` (invalid UTF-8 shows as U+FFFD; null ids give null)."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(_decode(shared, _stamp(ranks)), f"doc_id {kind}, text string")
