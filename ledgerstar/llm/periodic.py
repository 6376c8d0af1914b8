"""Periodic runs of words, by suffix-tree LCE.

A run is a maximal stretch of words with a smallest period. The root of every
run is the longest Lyndon word at one of its positions, under the order of the
words or under its opposite. So each position has two candidates: the longest
Lyndon word there, extended as far as its period holds, to the right by the
longest common extension of two suffixes and to the left by that of two
suffixes of the reversal. Both come from Ukkonen suffix trees whose lowest
common ancestors are range minima over their Euler tours, in constant time.

A run of exponent e holds each of its words at least e times. Words that are
rarer in a stretch therefore cut it into stretches that no run crosses; trees
are built for what is left when this is repeated, which in most texts is
little.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import binary_column, sliced

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

#: Rounds of cutting stretches at rare words; further cuts would change no result.
ROUNDS = 12


class SuffixTree:
    """Ukkonen's suffix tree of numbers below ``size``, zero only as the last; ``lce`` compares many suffixes at once."""

    def __init__(self, s: list[int], size: int):
        n = len(s)
        child: dict[int, int] = {}  # node * size + first symbol of the edge -> node below
        begin, stop, link, suffix = [0], [0], [0], [-1]
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            last = 0
            while waiting:
                if not length:
                    edge = i
                key = node * size + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    begin.append(i)
                    stop.append(n)
                    link.append(0)
                    suffix.append(i - waiting + 1)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    at = begin[below]
                    span = stop[below] - at
                    if length >= span:
                        node = below
                        edge += span
                        length -= span
                        continue
                    if s[at + length] == c:
                        if last:
                            link[last] = node
                        length += 1
                        break
                    split = len(begin)
                    begin += (at, i)
                    stop += (at + length, n)
                    link += (0, 0)
                    suffix += (-1, i - waiting + 1)
                    child[key] = split
                    child[split * size + c] = split + 1
                    begin[below] = at + length
                    child[split * size + s[at + length]] = below
                    if last:
                        link[last] = split
                    last = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.n, self.suffix = n, suffix
        keys = np.fromiter(child, np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        del child
        self.parent, self.symbol, self.below = keys // size, keys % size, below
        self.size = size
        self._tour([e - b for b, e in zip(begin, stop, strict=True)])

    def _children(self, opposite: bool) -> list[list[int]]:
        """Children of each node, last first; the end of the text (zero) is the least under both orders."""
        rank = np.where(self.symbol > 0, self.size - self.symbol, 0) if opposite else self.symbol
        order = np.lexsort((-rank, self.parent))
        out: list[list[int]] = [[] for _ in self.suffix]
        for p, b in zip(self.parent[order].tolist(), self.below[order].tolist(), strict=True):
            out[p].append(b)
        return out

    def _tour(self, span: list[int]) -> None:
        """Euler tour: the depth (in words) at each step, and the step at which each suffix's leaf is met."""
        children, suffix = self._children(False), self.suffix
        depth, tour, met, stack = [0] * len(suffix), [], [0] * self.n, [0]
        before = 0
        while stack:
            v = stack.pop()
            if v < 0:
                before = ~v
                tour.append(depth[before])
                continue
            depth[v] = depth[before] + span[v] if v else 0
            if suffix[v] >= 0:
                met[suffix[v]] = len(tour)
            before = v
            tour.append(depth[v])
            for w in children[v]:
                stack += (~v, w)
        self.met = np.array(met, dtype=np.int64)
        self.least = RangeMin(np.array(tour, dtype=np.int32))

    def ranks(self, opposite: bool = False) -> np.ndarray:
        """Rank of each suffix, under the order of the symbols or the opposite one."""
        if not opposite:
            order = np.argsort(self.met)
        else:
            children, suffix, found, stack = self._children(True), self.suffix, [], [0]
            while stack:
                v = stack.pop()
                if suffix[v] >= 0:
                    found.append(suffix[v])
                stack += children[v]
            order = np.array(found)
        out = np.empty(self.n, dtype=np.int64)
        out[order] = np.arange(self.n)
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``i`` and ``j`` (different)."""
        a, b = self.met[i], self.met[j]
        return self.least(np.minimum(a, b), np.maximum(a, b))


class RangeMin:
    """Minima of ranges in constant time: a sparse table over blocks, running minima inside them."""

    BLOCK = 16

    def __init__(self, values: np.ndarray):
        short = -len(values) % self.BLOCK
        self.rows = np.concatenate([values, np.full(short, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, self.BLOCK)
        self.left = np.minimum.accumulate(self.rows, axis=1).ravel()
        self.right = np.minimum.accumulate(self.rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [self.rows.min(axis=1)]
        step = 1
        while 2 * step <= len(self.rows):
            row = self.table[-1]
            self.table.append(np.minimum(row[: len(row) - step], row[step:]))
            step *= 2

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least value of each ``lo <= k <= hi``."""
        first, last = lo // self.BLOCK, hi // self.BLOCK
        out = np.minimum(self.right[lo], self.left[hi])
        same = np.flatnonzero(first == last)
        if len(same):
            k = np.arange(self.BLOCK)
            inside = (k >= (lo[same] % self.BLOCK)[:, None]) & (k <= (hi[same] % self.BLOCK)[:, None])
            out[same] = np.where(inside, self.rows[first[same]], np.iinfo(self.rows.dtype).max).min(axis=1)
        gap = last - first - 1
        level = np.frexp(np.maximum(gap, 1))[1] - 1
        for k in np.unique(level[gap > 0]).tolist():
            at = np.flatnonzero((level == k) & (gap > 0))
            row = self.table[k]
            between = np.minimum(row[first[at] + 1], row[last[at] - (1 << k)])
            out[at] = np.minimum(out[at], between)
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """Next position with a smaller rank: where the longest Lyndon word at each position ends."""
    values, out, stack = rank.tolist(), [0] * len(rank), []
    for i in range(len(values) - 1, -1, -1):
        v = values[i]
        while stack and values[stack[-1]] > v:
            stack.pop()
        out[i] = stack[-1] if stack else len(values)
        stack.append(i)
    return np.array(out, dtype=np.int64)


def maximal_runs(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a stretch of numbers."""
    n = len(ids)
    distinct, symbols = np.unique(ids, return_inverse=True)
    size = len(distinct) + 1
    word = symbols + 1
    ahead = SuffixTree([*word.tolist(), 0], size)
    back = SuffixTree([*word[::-1].tolist(), 0], size)
    found = set()
    for opposite in (False, True):
        end = np.minimum(next_smaller(ahead.ranks(opposite))[:n], n)
        i = np.arange(n)
        period = end - i
        keep = period * min_exponent <= n
        i, end, period = i[keep], end[keep], period[keep]
        if not len(i):
            continue
        # A suffix that starts at the end is the end mark alone: nothing is common with it.
        stop = end + ahead.lce(i, end)
        start = i - back.lce(n - i, n - end)
        good = stop - start >= np.maximum(min_length, min_exponent * period)
        found.update(zip(start[good].tolist(), (stop - start)[good].tolist(), period[good].tolist(), strict=True))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Stretches outside of which no run lies: each word occurs ``min_exponent`` times in its stretch, or not enough rounds were made."""
    todo, done = [(0, len(ids))], []
    for last in [False] * (ROUNDS - 1) + [True]:
        cut = []
        for lo, hi in todo:
            part = ids[lo:hi]
            if hi - lo > 4096:
                common = np.bincount(part)[part] >= min_exponent
            else:
                _, where, counts = np.unique(part, return_inverse=True, return_counts=True)
                common = counts[where] >= min_exponent
            if last or common.all():
                done.append((lo, hi))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[False], common, [False]])))
            for a, b in edges.reshape(-1, 2).tolist():
                if b - a >= min_length:
                    cut.append((lo + a, lo + b))
        todo = cut
    return done


def runs_of(words: list, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period), by start and period, of every run of ``words`` that is long enough, as a count of words and of periods.

    A run is a stretch of consecutive words with smallest period q that no neighbouring word extends keeping it.
    """
    if len(words) < max(min_length, min_exponent):
        return []
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    out = []
    for lo, hi in stretches(ids, max(min_length, min_exponent), min_exponent):
        out += [(lo + start, length, period) for start, length, period in maximal_runs(ids[lo:hi], min_length, min_exponent)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that any run holds after its first period."""
    if not runs:
        return words
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(dropped)[:-1] == 0).tolist()]


def find_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs`` (doc_id, text; others ignored).

    Words are runs of anything but bytes 0x09-0x0D and 0x20, numbered from 0; ``rewrite`` may change a document's
    words first. runs: those of at least ``min_length`` words and ``min_exponent`` (2 or more) periods, by start and
    period. collapsed: the words, joined by one space, without those that any run holds after its first period.
    A null text counts as empty: no words, no runs, an empty text. Repeated rows and null ids are handled like
    others. Memory grows with the longest stretch whose words all recur in it (about 1 KB a word), not with the text.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in sliced(batches):
            ids, sizes, found, kept = batch.column(0), [], [], []
            for doc_id, text in zip(ids.to_pylist(), binary_column(batch.column(1)).to_pylist(), strict=True):
                words = text.split()
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                runs = runs_of(words, min_length, min_exponent)
                sizes.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                kept.append(b" ".join(collapse(words, runs)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
