"""Periodic runs of words: maximal repetitions found by longest-common-extension queries.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) and length at least max(6, 4q). For every period q the positions 0, q,
2q ... form a grid; a run of period q and length >= 2q holds two grid points q
apart, and one forward and one backward extension query from such a point give
the whole maximal stretch. Over all q this is n/1 + n/2 + ... = O(n log n)
queries (the harmonic grid).

Extension queries use a difference cover: with period V = 13 and the cover
{0, 1, 3, 9}, any two positions reach positions of the cover after the same
shift of fewer than V words. Only suffixes that start at cover positions are
sorted (by prefix doubling in steps of V words, which stay on the cover), the
longest common prefixes of neighbours in that order are kept in a sparse table,
and a query compares at most V - 1 words directly before one range-minimum
lookup. The backward queries use the same structure over the reversed words.

Per document the work is numpy arrays inside a Pandas UDF; Spark spreads the
documents over tasks. A document is one unit: its runs can span all of it.

Defined cases: a NULL text or one without words has no runs and an empty
collapsed text; repeated rows are separate documents, each with its own result;
extra columns are carried through, output names replace input columns of the same
name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.llm.common import words as split_words

V = 13
COVER = (0, 1, 3, 9)
MIN_LENGTH = 6
MIN_EXPONENT = 4

SPAN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
RESULT = T.StructType(
    [
        T.StructField("n_runs", T.LongType()),
        T.StructField("runs", T.ArrayType(SPAN)),
        T.StructField("collapsed", T.StringType()),
    ]
)
OUTPUT = ["n_runs", "runs", "collapsed"]


def _shifts() -> np.ndarray:
    """shift[a, b]: the smallest d >= 0 with (a + d) % V and (b + d) % V both on the cover."""
    on = np.zeros(V, dtype=bool)
    on[list(COVER)] = True
    table = np.zeros((V, V), dtype=np.int64)
    for a in range(V):
        for b in range(V):
            table[a, b] = next(d for d in range(V) if on[(a + d) % V] and on[(b + d) % V])
    return table


SHIFT = _shifts()


class Extension:
    """Longest common extension of two positions of an integer sequence."""

    def __init__(self, seq: np.ndarray):
        n = len(seq)
        self.n = n
        size = n + 3 * V
        padded = np.empty(size, dtype=np.int64)
        padded[:n] = seq
        padded[n:] = -np.arange(1, size - n + 1)  # distinct, and unlike every word
        self.seq = padded
        on = np.isin(np.arange(size) % V, COVER)
        on[n + V :] = False  # cover positions far past the end are never asked for
        pos = np.flatnonzero(on)
        self.index = np.full(size, -1, dtype=np.int64)
        self.index[pos] = np.arange(len(pos))
        self.pos = pos
        self.levels = self._sort(padded, pos)
        rank = self.levels[-1]
        order = np.argsort(rank, kind="stable")
        self.rank = rank
        lcp = self._neighbour_lcp(pos[order[:-1]], pos[order[1:]])
        self.table = [lcp]
        step = 1
        while 2 * step <= len(lcp):
            prev = self.table[-1]
            self.table.append(np.minimum(prev[:-step], prev[step:]))
            step *= 2

    def _sort(self, padded, pos) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first V * 2^k words, k = 0, 1, ..."""
        m = len(pos)
        cols = padded[np.minimum(pos[:, None] + np.arange(V)[None, :], len(padded) - 1)]
        order = np.lexsort(cols.T[::-1])
        diff = np.any(cols[order[1:]] != cols[order[:-1]], axis=1)
        rank = np.empty(m, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(diff)])
        levels = [rank]
        h = V
        while m and rank.max() < m - 1:
            nxt = pos + h
            inside = nxt < len(self.index)
            second = np.full(m, -1, dtype=np.int64)
            idx = self.index[nxt[inside]]
            second[inside] = np.where(idx >= 0, rank[np.maximum(idx, 0)], -1)
            order = np.lexsort((second, rank))
            r, s = rank[order], second[order]
            diff = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
            rank = np.empty(m, dtype=np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(diff)])
            levels.append(rank)
            h *= 2
        return levels

    def _sampled_equal(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size = len(self.index)
        ok = (a < size) & (b < size)
        ia = self.index[np.minimum(a, size - 1)]
        ib = self.index[np.minimum(b, size - 1)]
        ok &= (ia >= 0) & (ib >= 0)
        ranks = self.levels[level]
        return ok & (ranks[np.maximum(ia, 0)] == ranks[np.maximum(ib, 0)])

    def _neighbour_lcp(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of sampled suffixes a and b, by halving the doubled ranks."""
        a, b = a.copy(), b.copy()
        lcp = np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            span = V << level
            eq = self._sampled_equal(level, a, b)
            a += span * eq
            b += span * eq
            lcp += span * eq
        lcp += self._direct(a, b, V)
        return lcp

    def _direct(self, a: np.ndarray, b: np.ndarray, limit) -> np.ndarray:
        """Equal words from a and b compared one by one, at most `limit` (scalar or per pair)."""
        size = len(self.seq)
        run = np.zeros(len(a), dtype=np.int64)
        alive = np.ones(len(a), dtype=bool)
        limit = np.broadcast_to(np.asarray(limit), a.shape)
        for k in range(V):
            pa, pb = a + k, b + k
            same = (pa < size) & (pb < size)
            same &= self.seq[np.minimum(pa, size - 1)] == self.seq[np.minimum(pb, size - 1)]
            alive &= same & (k < limit)
            run += alive
        return run

    def _sampled(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Extension of two distinct sampled positions: a range minimum over the sorted order."""
        ra, rb = self.rank[self.index[a]], self.rank[self.index[b]]
        lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
        width = hi - lo
        k = np.floor(np.log2(np.maximum(width, 1))).astype(np.int64)
        out = np.empty(len(a), dtype=np.int64)
        for level in np.unique(k):
            sel = k == level
            t = self.table[level]
            out[sel] = np.minimum(t[lo[sel]], t[hi[sel] - (1 << level)])
        return out

    def query(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from positions a and b (a != b, both within the sequence)."""
        if len(a) == 0:
            return np.zeros(0, dtype=np.int64)
        d = SHIFT[a % V, b % V]
        head = self._direct(a, b, d)
        out = head.copy()
        far = head == d
        if far.any():
            out[far] = d[far] + self._sampled(a[far] + d[far], b[far] + d[far])
        return out


BATCH = 1 << 20


def find_runs(seq: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of an integer sequence, by start, then period."""
    n = len(seq)
    if n < MIN_LENGTH:
        return []
    fwd = bwd = None
    found = []
    q = 1
    last = n // MIN_EXPONENT
    while q <= last:
        # periods q .. hi-1 whose grid points fit in one batch
        hi, count = q, 0
        while hi <= last and (count == 0 or count + (n - 1 - hi) // hi + 1 <= BATCH):
            count += (n - 1 - hi) // hi + 1
            hi += 1
        periods = np.arange(q, hi, dtype=np.int64)
        per = (n - 1 - periods) // periods + 1
        period = np.repeat(periods, per)
        first = np.cumsum(per) - per
        i = (np.arange(len(period)) - np.repeat(first, per)) * period
        q = hi
        # The first grid point inside a run has its next three words equal to
        # those one period on (length >= max(6, 4q)): a necessary test, exact.
        ahead = np.ones(len(i), dtype=bool)
        for k in range(3):
            far = i + k + period
            ahead &= (far < n) & (seq[np.minimum(i + k, n - 1)] == seq[np.minimum(far, n - 1)])
        i, period = i[ahead], period[ahead]
        if len(i) == 0:
            continue
        if fwd is None:
            fwd, bwd = Extension(seq), Extension(seq[::-1])
        f = fwd.query(i, i + period)
        b = bwd.query(n - i - period, n - i)
        start, length = i - b, b + f + period
        keep = length >= np.maximum(MIN_LENGTH, MIN_EXPONENT * period)
        found.append(np.stack([start[keep], length[keep], period[keep]], axis=1))
    if not found:
        return []
    cand = np.concatenate(found)
    if len(cand) == 0:
        return []
    # one row per stretch; the smallest period that spans it is its smallest period
    order = np.lexsort((cand[:, 2], cand[:, 1], cand[:, 0]))
    cand = cand[order]
    first = np.ones(len(cand), dtype=bool)
    first[1:] = (cand[1:, 0] != cand[:-1, 0]) | (cand[1:, 1] != cand[:-1, 1])
    cand = cand[first]
    order = np.lexsort((cand[:, 2], cand[:, 0]))
    return [tuple(int(x) for x in row) for row in cand[order]]


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """Words joined by one space, without those a run holds after its first period."""
    if not runs:
        return " ".join(words)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop)[: len(words)] > 0
    return " ".join(w for w, g in zip(words, gone) if not g)


def _one(words) -> dict:
    if words is None or len(words) == 0:
        return {"n_runs": 0, "runs": [], "collapsed": ""}
    words = list(words)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    found = find_runs(ids)
    return {
        "n_runs": len(found),
        "runs": [{"start": s, "length": l, "period": p} for s, l, p in found],
        "collapsed": collapse(words, found),
    }


@F.pandas_udf(RESULT)
def _detect(words: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_one(w) for w in words])


def periodic_runs(docs: DataFrame, word_list: Column | None = None) -> DataFrame:
    """docs with n_runs, runs (start, length, period by start, then period) and collapsed.

    `word_list` is an array of words per row; by default the words of `text`.
    """
    arr = split_words(F.col("text")) if word_list is None else word_list
    keep = [c for c in docs.columns if c not in OUTPUT]
    return docs.select(*keep, _detect(arr).alias("_r")).select(*keep, *[F.col(f"_r.{c}").alias(c) for c in OUTPUT])
