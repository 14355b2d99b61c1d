"""Sums of Euclidean distances between two sets of rows of one or two dimensions, without all their pairs.

Rows are halved into boxes. Two boxes with a gap between them meet through
Chebyshev nodes: seen from outside, ``|x - y|`` over a box is a polynomial up
to an error that falls as ``exp(-p asinh(gap / half width))`` with ``p`` nodes a
dimension, so ``p`` is chosen by pair for ``ERROR`` of each distance, the size
of the rounding of a plain sum. Boxes without a gap are parted further, and
small ones meet row by row. The work grows with the rows, times a logarithm.
"""

from __future__ import annotations

import functools
import math

import numpy as np

LEAF_ROWS = 512  # boxes of so many rows are not parted
ERROR = 1e-10  # of a distance taken through nodes, relative; sums measured within 1e-12
MOST_NODES = {1: 20, 2: 20}  # nodes a dimension at most, by dimensions; from three on all pairs are cheaper at any size here
STEP_VALUES = 1 << 17  # values of a step, so that they stay in the cache


class Boxes:
    """A tree of boxes over ``x`` (rows, dimensions); ``sums`` gathers what each row is given, in the order of ``x``."""

    def __init__(self, x: np.ndarray):
        self.order, self.most = np.arange(len(x)), MOST_NODES[x.shape[1]]
        self.box: list[tuple] = []
        self._part(x, 0, len(x))
        self.x = np.ascontiguousarray(x[self.order].T)
        self.at_rows, self.at_nodes, self.seen = np.zeros(len(x)), {}, {}

    def _part(self, x: np.ndarray, lo: int, hi: int) -> int:
        rows = self.order[lo:hi]
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        me, wide, children = len(self.box), high - low, ()
        half = (wide / 2).tolist()
        self.box.append(())
        if hi - lo > LEAF_ROWS and wide.any():
            mid = (hi - lo) // 2
            self.order[lo:hi] = rows[np.argpartition(x[rows, wide.argmax()], mid)]
            children = self._part(x, lo, lo + mid), self._part(x, lo + mid, hi)
        self.box[me] = lo, hi, (low + wide / 2).tolist(), half, children
        return me

    def _polynomials(self, i: int, lo: int, hi: int) -> list[np.ndarray]:
        """Chebyshev polynomials (degree, row) of rows ``lo`` to ``hi`` of box ``i``, by dimension."""
        out = []
        for v, c, h in zip(self.x[:, lo:hi], self.box[i][2], self.box[i][3]):
            s = (v - c) / h if h else np.zeros(hi - lo)
            t = np.empty((self.most, hi - lo))
            t[0], t[1] = 1.0, s
            for k in range(2, self.most):
                t[k] = 2 * s * t[k - 1] - t[k - 2]
            out.append(t)
        return out

    def _slices(self, i: int):
        lo, hi = self.box[i][:2]
        step = STEP_VALUES // self.most
        return ((s, min(s + step, hi)) for s in range(lo, hi, step))

    def moments(self, i: int) -> np.ndarray:
        """Sums over the rows of box ``i`` of the products of the polynomials."""
        if i not in self.seen:
            total = 0.0
            for lo, hi in self._slices(i):
                first, *second = self._polynomials(i, lo, hi)
                total = total + (first @ second[0].T if second else first.sum(axis=1))
            self.seen[i] = total.reshape([self.most] * len(self.x))
        return self.seen[i]

    def side(self, i: int, nodes: list[int] | None) -> tuple:
        """Places (from the centre) and weights of box ``i``: its nodes, or its rows where they are fewer."""
        lo, hi, centre, half, _ = self.box[i]
        if nodes is None or math.prod(nodes) >= hi - lo:
            return self.x[:, lo:hi] - np.array(centre)[:, None], None, None
        cut = tuple(map(slice, nodes))
        weight, place = self.moments(i)[cut], np.empty((len(nodes), math.prod(nodes)))
        for k, (h, p) in enumerate(zip(half, nodes)):
            weight = weight.reshape(p, -1).T @ _nodes(p)[1]
            place[k].reshape(math.prod(nodes[:k]), p, -1)[:] = (h * _nodes(p)[0])[:, None]
        return place, weight.ravel(), cut

    def give(self, i: int, cut: tuple | None, value: np.ndarray) -> None:
        """Adds values at the places of :meth:`side`."""
        if cut is None:
            self.at_rows[self.box[i][0]:self.box[i][1]] += value
            return
        for c in cut:
            value = value.reshape(c.stop, -1).T @ _nodes(c.stop)[1].T
        if i not in self.at_nodes:
            self.at_nodes[i] = np.zeros([self.most] * len(self.x))
        self.at_nodes[i][cut] += value.reshape([c.stop for c in cut])

    def sums(self) -> np.ndarray:
        for i, given in self.at_nodes.items():
            for lo, hi in self._slices(i):
                first, *second = self._polynomials(i, lo, hi)
                value = given.T @ first
                if second:
                    value = np.einsum("kn,kn->n", value, second[0])
                self.at_rows[lo:hi] += value
        out = np.empty(len(self.order))
        out[self.order] = self.at_rows
        return out


@functools.cache
def _nodes(p: int) -> tuple[np.ndarray, np.ndarray]:
    """``p`` Chebyshev nodes and (degree, node): the coefficients of a function by its values there."""
    angle = (2 * np.arange(p) + 1) * np.pi / (2 * p)
    by = np.cos(np.outer(np.arange(p), angle)) * 2 / p
    by[0] /= 2
    return np.cos(angle), by


def _enough(gap: float, half: list[float], most: int) -> list[int] | None:
    """Nodes by dimension that a box needs at this gap; None where they are too many."""
    out = []
    for h in half:
        p = 1 if not h else math.ceil(-math.log(ERROR) / max(math.asinh(gap / h), 1e-9))
        if p > most:
            return None
        out.append(max(1, p))
    return out


def _distances(a: np.ndarray, b: np.ndarray, work: np.ndarray) -> np.ndarray:
    d, more = work[:, :a.shape[1] * b.shape[1]].reshape(2, a.shape[1], b.shape[1])
    np.subtract(a[0][:, None], b[0], out=d)
    np.multiply(d, d, out=d)
    for p, q in zip(a[1:], b[1:]):
        np.subtract(p[:, None], q, out=more)
        np.multiply(more, more, out=more)
        np.add(d, more, out=d)
    return np.sqrt(d, out=d)


def _meet(x: Boxes, i: int, y: Boxes, j: int, nodes_x: list[int] | None, nodes_y: list[int] | None, work: np.ndarray) -> None:
    """Distances of two boxes, given to both."""
    (a, wa, ca), (b, wb, cb) = x.side(i, nodes_x), y.side(j, nodes_y)
    a = a + (np.array(x.box[i][2]) - y.box[j][2])[:, None]
    if b.shape[1] > work.shape[1]:
        work = np.empty((2, b.shape[1]))
    to_a, to_b, step = np.empty(a.shape[1]), np.zeros(b.shape[1]), max(1, STEP_VALUES // b.shape[1])
    for s in range(0, a.shape[1], step):
        d = _distances(a[:, s:s + step], b, work)
        to_a[s:s + step] = d @ (np.ones(d.shape[1]) if wb is None else wb)
        to_b += (np.ones(len(d)) if wa is None else wa[s:s + step]) @ d
    x.give(i, ca, to_a)
    if x is not y or i != j:
        y.give(j, cb, to_b)


def box_sums(x: np.ndarray, y: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums of |x - y| over the other side, for each x and for each y; without ``y`` over the pairs of ``x``. All finite."""
    bx = Boxes(x)
    by = bx if y is None else Boxes(y)
    todo, work = [(0, 0)], np.empty((2, STEP_VALUES))
    while todo:
        i, j = todo.pop()
        lx, hx, cx, wx, kids_x = bx.box[i]
        ly, hy, cy, wy, kids_y = by.box[j]
        if bx is by and i == j:
            if kids_x:
                todo += [(kids_x[0], kids_x[0]), kids_x, (kids_x[1], kids_x[1])]
            elif any(wx):
                _meet(bx, i, by, j, None, None, work)
            continue
        gap = math.hypot(*[max(0.0, abs(p - q) - h - k) for p, q, h, k in zip(cx, cy, wx, wy)])
        nodes_x, nodes_y = _enough(gap, wx, bx.most), _enough(gap, wy, by.most)
        # Without enough of a gap the wider box is parted; small boxes meet by their rows.
        if (nodes_x and nodes_y) or not (kids_x or kids_y) or (hx - lx) * (hy - ly) <= LEAF_ROWS ** 2:
            _meet(bx, i, by, j, nodes_x, nodes_y, work)
        elif kids_x and (not kids_y or math.hypot(*wx) >= math.hypot(*wy)):
            todo += [(kids_x[0], j), (kids_x[1], j)]
        else:
            todo += [(i, kids_y[0]), (i, kids_y[1])]
    to_x = bx.sums()
    return to_x, to_x if by is bx else by.sums()
