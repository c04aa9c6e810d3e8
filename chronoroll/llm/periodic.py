"""Maximal periodic runs of words, by longest common extensions on suffix trees.

A run is a stretch of consecutive words of one text with smallest period
``q`` and at least ``max(least, 2 q)`` words, which no neighbouring word
extends. Every run has a root that is a Lyndon word in the order of its words
or in the reversed order. So for each order the longest Lyndon word from every
place is a candidate root (it ends before the next smaller suffix), extended
to the right by the longest common extension of two suffixes and to the left
by that of the reversal. Both come from a suffix tree built by Ukkonen's
algorithm: the Euler tour of the tree, kept as the least string depth between
neighbouring leaves, answers each lowest-common-ancestor query in constant
time with a table of minima over powers of two.

Trees are built only where a run can be. Each word of a run lies in a window
of ``(least + 1) // 2`` words that occurs twice in the run, so stretches of
words covered by repeated windows hold every run whole (hashes are compared
there: a collision can only add a stretch). The stretches of one text, with
separators that equal nothing, make the string of its trees, whose symbols
are numbered by the words themselves.

Texts are independent of each other: no shuffle, memory is bounded by the
longest text. Defined cases: a null or empty text has no words and no runs;
repeated rows are judged each; an empty table gives an empty result; extra
columns are carried, those named like a result column are replaced.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import words as W

LEAST = 12
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FIELDS = {"n_words": T.LongType(), "runs": T.ArrayType(RUN), "collapsed": T.StringType()}


class Tree:
    """Suffix tree of ``s``, a list of numbers whose last one occurs nowhere else (Ukkonen's algorithm)."""

    def __init__(self, s: list[int]):
        n, base = len(s), max(s) + 1
        start, end, up, link, depth, suffix = [0], [0], [-1], [0], [0], [-1]
        child: dict[int, int] = {}
        node = edge = length = todo = leaves = 0
        for i, c in enumerate(s):
            todo += 1
            last = 0
            while todo:
                if not length:
                    edge = i
                key = node * base + s[edge]
                down = child.get(key)
                if down is None:
                    under = node
                else:
                    size = end[down] - start[down]
                    if length >= size:
                        node, edge, length = down, edge + size, length - size
                        continue
                    at = start[down] + length
                    if s[at] == c:
                        if last:
                            link[last] = node
                        length += 1
                        break
                    under = len(start)
                    start.append(start[down])
                    end.append(at)
                    up.append(node)
                    link.append(0)
                    depth.append(depth[node] + length)
                    suffix.append(-1)
                    child[key] = under
                    start[down] = at
                    up[down] = under
                    child[under * base + s[at]] = down
                    key = under * base + c
                child[key] = len(start)
                start.append(i)
                end.append(n)
                up.append(under)
                link.append(0)
                depth.append(n - leaves)
                suffix.append(leaves)
                leaves += 1
                if last:
                    link[last] = under
                last = under
                todo -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - todo + 1
        self.symbols = np.array(s, np.int64)
        self.first = self.symbols[np.array(start)]
        self.up, self.depth, self.suffix = np.array(up), depth, suffix

    def tour(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(suffixes in order of their leaves, least depth between each leaf and the one before it).

        ``key`` orders the symbols.
        """
        order = np.lexsort((-key[self.first], self.up))
        cut = np.searchsorted(self.up[order], np.arange(len(order) + 1)).tolist()
        kids, up, depth, suffix = order.tolist(), self.up.tolist(), self.depth, self.suffix
        seen, least, stack, fresh = [], [], [0], False
        while stack:
            v = stack.pop()
            if fresh:
                least.append(depth[up[v]])
                fresh = False
            if suffix[v] >= 0:
                seen.append(suffix[v])
                fresh = True
            else:
                stack += kids[cut[v]:cut[v + 1]]
        return np.array(seen), np.array([0, *least])


class Extensions:
    """Longest common extensions of two suffixes in constant time, many at once."""

    def __init__(self, seen: np.ndarray, least: np.ndarray):
        self.rank = np.empty(len(seen), np.int64)
        self.rank[seen] = np.arange(len(seen))
        self.levels = [least.astype(np.int32)]
        while 2 ** len(self.levels) <= len(least):
            below, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp(hi - lo)[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            m = level == k
            row = self.levels[k]
            out[m] = np.minimum(row[lo[m]], row[hi[m] - 2 ** int(k)])
        return out


def _next_less(rank: np.ndarray) -> np.ndarray:
    """For each place the next one of smaller rank, or the length."""
    r = rank.tolist()
    n = len(r)
    out, stack = [n] * n, []
    for i in range(n - 1, -1, -1):
        x = r[i]
        while stack and r[stack[-1]] > x:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return np.array(out)


def runs(s: list[int], least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of the runs of ``s`` (numbers from 1), by start, then period."""
    n = len(s)
    if not n:
        return np.empty((0, 3), np.int64)
    tree = Tree([*s, 0])
    size = max(s) + 1
    forward = np.arange(size)
    backward = np.where(forward > 0, size - forward, 0)  # a suffix that ends is smaller in both orders
    right = Extensions(*tree.tour(forward))
    seen, _ = tree.tour(backward)
    other = np.empty(n + 1, np.int64)
    other[seen] = np.arange(n + 1)
    left = Extensions(*Tree([*reversed(s), 0]).tour(forward))
    i = np.tile(np.arange(n), 2)
    j = np.concatenate([_next_less(right.rank)[:n], _next_less(other)[:n]])
    i, j = i[j < n], j[j < n]
    ahead, behind = right(i, j), left(n - i, n - j)  # a suffix of the reversal from n - i reads what lies before i
    behind[i == 0] = 0
    period, length = j - i, j - i + ahead + behind
    found = np.stack([i - behind, length, period], 1)[length >= np.maximum(2 * period, least)]
    found = np.unique(found[:, [0, 2, 1]], axis=0)
    return found[:, [0, 2, 1]]


def stretches(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the stretches of words covered by windows of ``k`` that repeat in the stretch.

    ``h`` are hashes of words, ``first`` each text's first word.
    """
    at = np.flatnonzero(W.inside(first, k))
    hashes = W.FIRST.windows(h, k)[at]
    part = W.owner(first)[at]
    while True:
        key = W.mix(part.astype(np.uint64) + np.uint64(1)) ^ hashes
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        some = at[again]
        # windows that overlap or touch within one part are one stretch
        new = np.ones(len(some), bool)
        new[1:] = (some[1:] > some[:-1] + k) | (part[again][1:] != part[again][:-1])
        if again.all():
            break
        at, hashes, part = some, hashes[again], np.cumsum(new)
    start = at[new]
    return start, (at[np.append(new[1:], True)] + k if len(at) else start)


def _measure(buf: np.ndarray, off: np.ndarray, least: int) -> dict:
    start, end, first = W.split(buf, off)
    a, b = stretches(W.FIRST.runs(buf, start, end), first, (least + 1) // 2)
    long = b - a >= least
    a, b = a[long], b[long]
    text = np.searchsorted(first, a, "right") - 1
    raw = buf.tobytes()
    found: list[list] = [[] for _ in range(len(off) - 1)]
    cut = np.append(np.flatnonzero(np.diff(text, prepend=-1)), len(text))
    dropped: dict[int, np.ndarray] = {}
    for lo, hi in zip(cut, cut[1:]):
        t = int(text[lo])
        number: dict[bytes, int] = {}
        s, place = [], []
        for x, y in zip(a[lo:hi].tolist(), b[lo:hi].tolist()):
            s += [number.setdefault(raw[p:q], len(number) + 1) for p, q in zip(start[x:y].tolist(), end[x:y].tolist())]
            s.append(0)
            place.append(np.arange(x, y + 1))
        for k, p in enumerate(np.flatnonzero(np.array(s) == 0).tolist()):
            s[p] = len(number) + 1 + k
        r = runs(s[:-1], least)
        if len(r):
            r[:, 0] = np.concatenate(place)[r[:, 0]] - first[t]
            n = int(first[t + 1] - first[t])
            d = np.zeros(n + 1, np.int64)
            np.add.at(d, r[:, 0] + r[:, 2], 1)
            np.add.at(d, r[:, 0] + r[:, 1], -1)
            dropped[t] = np.cumsum(d[:n]) > 0
            found[t] = [dict(zip(("start", "length", "period"), x)) for x in r.tolist()]
    collapsed = []
    for t, (lo, hi) in enumerate(zip(off.tolist(), off[1:].tolist())):
        words = raw[lo:hi].split()  # ASCII white space: the separators of words
        collapsed.append(b" ".join(compress(words, ~dropped[t]) if t in dropped else words).decode())
    return {"n_words": np.diff(first), "runs": found, "collapsed": collapsed}


def find(docs: DataFrame, *, text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length and period, by start, then period) and ``collapsed``.

    ``collapsed`` keeps each run's first period only: the words left, one space between.
    """
    return W.add_columns(docs, text, FIELDS, lambda buf, off: _measure(buf, off, least))
