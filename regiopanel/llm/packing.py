"""Best-fit packing of tokenized documents into fixed-length sequences, improved by swaps.

Documents are tokenized once; those longer than a sequence are cut into full
sequences and a rest. Rests are dealt to groups of bounded size. A group is
packed by best fit (in the order its pieces come; also from the largest on, if
that is not yet the least number of bins) and then improved by local search: the least filled bin gives its pieces away by moves into other
underfull bins, by exchanges of one of its pieces for a smaller one, or of two
of its pieces for one. Each step moves tokens from a bin to one that is then
fuller than it was, so the sum of squared fills grows with every step, until
the bin is empty; this goes on until a lower bound shows that fewer bins cannot do.

Bins of a group that stay least filled are not final: their pieces (at most an
eighth of the group) meet those of other groups in the next, smaller round.
So the waste of the groups is packed again, and the last round is one group.
Nothing but lengths takes part in the rounds.

Defined results: null and empty texts are a piece of one token (the end token);
rows with the same id, and repeated rows, are packed each for itself; equal
lengths keep the order of their rows; a document of any length gives as many
pieces as it needs; an empty table gives an empty result; further columns are
ignored. Special tokens in a text are what the tokenizer file makes of them.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import byte_values, prefix_sums, space_words, span_hash, text_chunks, word_spans, written

SEQUENCE = 4096
END_ID = 1
#: Pieces of a group, and the share of them that a group may hand on.
GROUP = 32_768
HANDED_ON = 8
#: Bins that the search tries to empty in vain, one after the other, before it ends.
PATIENCE = 200
#: Words and ids a worker remembers; its memory starts anew beyond that.
CACHE_WORDS = 1_000_000
CACHE_IDS = 6_000_000


# ---------------------------------------------------------------- tokens

def _byte_classes() -> np.ndarray:
    """1 for ASCII letters, 2 for digits, 3 for other printable signs, 0 for the rest."""
    t = np.zeros(256, np.uint8)
    t[0x21:0x7F] = 3
    t[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
    t[0x30:0x3A] = 2
    return t


class WordTokenizer:
    """Ids of texts from a tokenizer that lower-cases, drops white space and cuts letters, digits and signs apart.

    Texts are cut at ASCII white space and where an ASCII letter, digit or
    sign meets one of another kind (an accented Latin-1 letter counts as a
    letter before a digit or sign; nothing is cut after an apostrophe, which
    may begin a contraction). Normal forms and the tokenizer's own cuts do not
    reach over such places, so the ids are those of the whole text. Each
    distinct word is tokenized once and its ids are copied to all its places.
    A chunk that may hold a special token is cut at white space only and its
    case is kept.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = sorted({t[:2] for t in special})
        self.folded, self.exact = byte_values(fold_case=True), byte_values(fold_case=False)
        self.word, self.kind = space_words(), _byte_classes()
        self._forget()

    def _forget(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)   # sorted hashes of words, their slots
        self.start, self.count, self.ids = [np.zeros(0, t) for t in (np.int64, np.int64, np.uint32)]

    def _spans(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        kind, w = self.kind[data], self.word[data]
        cut = np.zeros(n + 1, bool)
        a, b = kind[:-1], kind[1:]
        cut[1:n] = (a > 0) & (b > 0) & ((a != b) | (a == 2)) & ~((data[:-1] == 0x27) & (b == 1))
        # C3 xx is a letter of Latin-1, but for the signs C3 97 and C3 B7.
        accent = np.flatnonzero(data[:-2] == 0xC3) if n > 2 else np.zeros(0, np.int64)
        accent = accent[(data[accent + 1] != 0x97) & (data[accent + 1] != 0xB7) & (kind[accent + 2] > 1)]
        cut[accent + 2] = True
        cut[off] = True
        before = np.append(False, w[:-1])
        after = np.append(w[1:], False)
        return np.flatnonzero(w & (~before | cut[:n])), np.flatnonzero(w & (~after | cut[1:])) + 1

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end and how many each has; joined by spaces they are one text."""
        ids, counts = [], []
        for i in range(0, len(words), 2000):
            batch = words[i:i + 2000]
            got = self.tokenizer.encode(" ".join(batch), add_special_tokens=False)
            begin = np.cumsum([0, *(len(x) + 1 for x in batch)])
            at = np.fromiter((x for x, _ in got.offsets), np.int64, len(got))
            ids.append(np.array(got.ids, np.uint32))
            counts.append(np.diff(np.searchsorted(at, begin)))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids begin."""
        raw = data.tobytes()
        if any(t in raw for t in self.special):
            starts, ends, _ = word_spans(data, off, self.word)
            values = self.exact
        else:
            starts, ends = self._spans(data, off) if len(data) else (np.zeros(0, np.int64),) * 2
            values = self.folded
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        keys = span_hash(prefix_sums(values[data]), starts, ends)
        distinct, where, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > CACHE_WORDS or len(self.ids) > CACHE_IDS:
            self._forget()
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            at = where[new]
            ids, count = self._learn([raw[x:y].decode("utf-8") for x, y in zip(starts[at].tolist(), ends[at].tolist())])
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
            self.slot = np.insert(self.slot, place[new], np.arange(len(self.count), len(self.count) + len(new)))
            self.keys = np.insert(self.keys, place[new], distinct[new])
            self.count, self.ids = np.concatenate([self.count, count]), np.concatenate([self.ids, ids])
            place = np.searchsorted(self.keys, distinct)
        slot = self.slot[place][back]
        begin, count = self.start[slot], self.count[slot]
        upto = np.concatenate([[0], np.cumsum(count)])
        return self.ids[np.arange(int(upto[-1])) + np.repeat(begin - upto[:-1], count)], upto[np.searchsorted(starts, off)]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(shared, stamp: str) -> WordTokenizer:
    # One a worker: the words it has met stay known to its later tasks.
    if stamp not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[stamp] = WordTokenizer(shared.value)
    return _TOKENIZERS[stamp]


def _pieces(shared, stamp: str, sequence: int, end_id: int):
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(shared, stamp)
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column("text")):
                ids, at = tok.encode(data, off)
                row, piece, start, length, crc = [], [], [], [], []
                for r in range(j - i):
                    own = np.concatenate([ids[at[r]:at[r + 1]], end])
                    for k, s in enumerate(range(0, len(own), sequence)):
                        part = own[s:s + sequence]
                        row.append(i + r)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64())})
    return run


def pieces(docs: DataFrame, definition: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and the end token, cut into sequences.

    ``definition`` is the text of a tokenizer file.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    kind = docs.schema["doc_id"].dataType.simpleString()
    stamp = hashlib.sha256(definition.encode()).hexdigest()
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(shared, stamp, sequence, end_id),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


# ---------------------------------------------------------------- bins

def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: each item, in order, goes to the fullest bin that can hold it."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0                                     # bit f: some bin has f free
    for item, size in enumerate(sizes):
        fits = open_ >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                open_ ^= 1 << free
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(item)
        left = free - size
        if left:
            by_free[left].append(b)
            open_ |= 1 << left
    return bins


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: by the sum, and by counts of pieces of which only k fit into one bin.

    With a large piece (more than capacity - t) no piece of t and more fits;
    the others of more than half each need a bin, and the rest of at least t the space those leave.
    """
    if not len(sizes):
        return 0
    ordered = np.sort(sizes)
    sums = np.concatenate([[0], np.cumsum(ordered)])
    best = -(-int(sums[-1]) // capacity)
    for k in range(1, 16):
        best = max(best, -(-int(len(sizes) - np.searchsorted(ordered, capacity // (k + 1), side="right")) // k))
    t = np.unique(ordered[ordered <= capacity // 2])
    large = len(sizes) - np.searchsorted(ordered, capacity - t, side="right")
    half = np.searchsorted(ordered, capacity // 2, side="right")
    upto = np.searchsorted(ordered, capacity - t, side="right")
    middle, middle_sum = upto - half, sums[upto] - sums[half]
    small = sums[half] - sums[np.searchsorted(ordered, t, side="left")]
    extra = np.maximum(0, -(-(small - (middle * capacity - middle_sum)) // capacity))
    return int(max(best, (large + middle + extra).max(initial=0)))


class Search:
    """Local search over the underfull bins of a group; ``steps`` counts moves, swaps and two-for-one swaps.

    A step takes pieces of the giving bin and at most one smaller piece of
    the taking bin, which must become fuller than the giver was: squared fill
    grows. Steps that fill a bin to the brim come first; a table of the sums
    that would do so makes them a lookup.
    """

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.capacity, self.size = capacity, sizes
        self.sizes = np.array(sizes, np.int64)
        self.bins = [set(b) for b in bins]
        self.fill = np.array([sum(sizes[i] for i in b) for b in bins], np.int64)
        self.home = np.zeros(len(sizes), np.int64)
        for b, items in enumerate(bins):
            self.home[items] = b
        self.least = lower_bound(self.sizes, capacity)
        self.steps = {"move": 0, "swap": 0, "pair": 0}
        # Gift that would fill a bin: in return for one of its pieces (brim), or for nothing (gap).
        self.brim: list[list[int]] = [[] for _ in range(2 * capacity + 1)]
        self.gap: list[list[int]] = [[] for _ in range(capacity + 1)]
        for b in range(len(bins)):
            self._offer(b)

    def _offer(self, b: int) -> None:
        free = self.capacity - int(self.fill[b])
        if 0 < free < self.capacity:
            self.gap[free].append(b)
            for i in self.bins[b]:
                self.brim[self.size[i] + free].append(i)

    def run(self) -> "Search":
        """Empty the least filled bins one by one, until no fewer bins can do or ``PATIENCE`` in turn resist."""
        tried: set[int] = set()
        while np.count_nonzero(self.fill) > self.least and len(tried) < PATIENCE:
            under = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
            under = under[np.argsort(self.fill[under], kind="stable")[:PATIENCE]]
            giver = next((b for b in under.tolist() if b not in tried), None)
            if giver is None:
                break
            if self._empty(giver):
                tried.clear()
            else:
                tried.add(giver)
        return self

    def _empty(self, giver: int) -> bool:
        while self.bins[giver]:
            step = self._to_the_brim(giver) or self._largest(giver)
            if step is None:
                self._offer(giver)
                return False
            self._apply(giver, *step)
        return True

    def _gifts(self, giver: int) -> list[tuple[int, tuple[int, ...]]]:
        """One piece of each size, and pairs of a piece with one of the smallest: (size, pieces), largest first."""
        kinds = {self.size[i]: i for i in sorted(self.bins[giver], reverse=True)}
        small = min(self.bins[giver], key=lambda i: (self.size[i], i))
        one = [(s, (i,)) for s, i in kinds.items()]
        two = [(s + self.size[small], (i, small)) for s, i in kinds.items() if i != small]
        return sorted(one + two, reverse=True)

    def _to_the_brim(self, giver: int):
        cap, size, fill, home = self.capacity, self.size, self.fill, self.home
        best = None
        for s, gift in self._gifts(giver):
            if best and s <= best[0]:
                break
            if len(gift) == 1:
                stack = self.gap[s]
                while stack and fill[stack[-1]] + s != cap:
                    stack.pop()
                b = next((b for b in reversed(stack) if b != giver and fill[b] + s == cap), None)
                if b is not None:
                    best = (s, gift, None, b)
                    continue
            if s >= len(self.brim):
                continue
            live = [i for i in self.brim[s] if size[i] + cap - fill[home[i]] == s and fill[home[i]] < cap]
            self.brim[s] = live
            back = min((i for i in live if size[i] < s and home[i] != giver), key=lambda i: (size[i], i), default=None)
            if back is not None and (best is None or s - size[back] > best[0]):
                best = (s - size[back], gift, back, int(home[back]))
        return best and best[1:]

    def _largest(self, giver: int):
        """The step that gives most away, by a scan of all underfull bins."""
        cap, mine = self.capacity, int(self.fill[giver])
        open_ = (self.fill > 0) & (self.fill < cap)
        open_[giver] = False
        under = np.flatnonzero(open_)
        if not len(under):
            return None
        fills = self.fill[under]
        items = np.flatnonzero(open_[self.home])
        size, at = self.sizes[items], self.fill[self.home[items]]
        best, step = 0, None
        for s, gift in self._gifts(giver):
            if s <= best:
                break
            if len(gift) == 1:
                fit = np.flatnonzero((fills + s <= cap) & (fills + s > mine))
                if len(fit):
                    best, step = s, (gift, None, int(under[fit[np.argmax(fills[fit])]]))
                    continue
            gain = np.where((size < s) & (at + s - size <= cap) & (at + s - size > mine), s - size, 0)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, step = int(gain[k]), (gift, int(items[k]), int(self.home[items[k]]))
        return step

    def _apply(self, giver: int, gift: tuple[int, ...], back: int | None, taker: int) -> None:
        self._move(gift, giver, taker)
        if back is not None:
            self._move((back,), taker, giver)
        self._offer(taker)
        self.steps["move" if back is None else "swap" if len(gift) == 1 else "pair"] += 1

    def _move(self, items: tuple[int, ...], source: int, target: int) -> None:
        for i in items:
            self.bins[source].remove(i)
            self.bins[target].add(i)
            self.home[i] = target
            self.fill[source] -= self.size[i]
            self.fill[target] += self.size[i]


def pack(sizes: list[int], capacity: int = SEQUENCE) -> Search:
    """Best fit and local search from the given order and, if that leaves more bins than must be, from the largest on.

    The result with fewer bins is kept.
    """
    found = Search(sizes, best_fit(sizes, capacity), capacity).run()
    if np.count_nonzero(found.fill) == found.least:
        return found
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bins = [[order[i] for i in b] for b in best_fit([sizes[i] for i in order], capacity)]
    other = Search(sizes, bins, capacity).run()
    return min(found, other, key=lambda x: np.count_nonzero(x.fill))


def _packed(capacity: int, group: int, last: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row_no", kind="stable").reset_index(drop=True)
        found = pack(frame["length"].tolist(), capacity)
        fill, home = found.fill, found.home
        n = np.bincount(home, minlength=len(fill))
        # The least filled bins are handed on, the first of them always, while their pieces are few.
        order = np.argsort(fill, kind="stable")
        order = order[(fill[order] > 0) & (fill[order] < capacity)]
        handed = np.zeros(len(fill), bool)
        if not last and len(order):
            few = np.cumsum(n[order]) * HANDED_ON <= group
            few[0] = True
            handed[order[few]] = True
        out = frame[["g", "row_no", "length"]].copy()
        out["bin"] = home
        out["final"] = ~handed[home]
        out = out.sort_values(["bin", "row_no"], kind="stable")
        out["offset"] = out.groupby("bin")["length"].cumsum() - out["length"]
        return out
    return run


def sequences(found: DataFrame, capacity: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """``found`` (rows with ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset`` in that sequence.

    ``found`` must be a written table with a number ``row_no`` of each row.
    """
    full = found.filter(F.col("length") == capacity).select(
        "row_no", F.col("row_no").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = found.filter(F.col("length") < capacity).select("row_no", "length")
    placed, rounds = full, 0
    count = rest.count()
    while count:
        groups, rounds = math.ceil(count / group), rounds + 1
        dealt = rest.withColumn("g", F.pmod(F.xxhash64("row_no", F.lit(rounds)), F.lit(groups)).cast("int"))
        schema = "g int, row_no bigint, length bigint, bin bigint, final boolean, offset bigint"
        packed = written(dealt.groupBy("g").applyInPandas(_packed(capacity, group, groups == 1), schema), "packed")
        # Negative numbers: the round, the group and the bin in it; row numbers (full sequences) are not negative.
        number = F.lit(-1) - ((F.lit(rounds).cast("bigint") * F.lit(1 << 56)) + (F.col("g").cast("bigint") * F.lit(1 << 20)) + F.col("bin"))
        placed = placed.unionByName(packed.filter("final").select("row_no", number.alias("sequence_id"), "offset"))
        rest = packed.filter("NOT final").select("row_no", "length")
        count = rest.count() if groups > 1 else 0
    return found.join(placed, "row_no")


def pack_documents(docs: DataFrame, definition: str, sequence: int = SEQUENCE, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    found = written(pieces(docs, definition, sequence, end_id).withColumn("row_no", F.monotonically_increasing_id()), "pieces")
    return sequences(found, sequence, group).drop("row_no")
