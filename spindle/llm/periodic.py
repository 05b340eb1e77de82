"""Periodic runs of words by internal pattern matching.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) and length >= max(``min_length``, ``exponent`` * q). Runs are found
without trying every period:

* prefix doubling ranks every place by its next 2^k words; the last ranks give
  the suffix array, and the suffixes that begin with a dyadic block (2^k words
  at a multiple of 2^k) are one interval of it;
* a wavelet tree over the suffix array answers range successor queries: the
  next place after x, of the places in that interval. So the occurrences of a
  block in its neighbouring window (the next two block lengths) are met in text
  order. A run with 2^k <= q < 2^(k+1) holds an aligned block of 2^k words that
  occurs again q words later;
* occurrences at most half a block apart are an arithmetic progression whose
  difference is the block's own period. It is jumped over in one step: the
  periods it can stand for are its first distance and the distance between the
  ends of the two periodic stretches (every other distance has a divisor that
  is a period too). All other occurrences give their distance. A block thus has
  a few candidates;
* each candidate is extended both ways by comparing ranks; equal stretches keep
  their smallest period. With exponent 4 a longer period of a run has the same
  stretch, so what is left is exactly the runs.

A task handles texts in slices of about 1 MB (one longer text is one slice) with
memory linear in the slice times the logarithm of its words. Words of different
texts never compare equal, so most places are alone after a few doublings and
leave the sort. Words are told apart by a 64-bit hash. No shuffle; a lost task
is simply run again.

Defined cases: a null text and an empty one have no words, no runs and an empty
collapsed text; rows are independent, so null ids and repeated rows are judged
each on its own; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrowtext as at
from .runtime import on_workers

EXPONENT = 4
MIN_LENGTH = 6

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class WaveletTree:
    """Range successor over a permutation: bit planes from the highest, each
    with its running count of ones; values with a zero bit go before the others."""

    def __init__(self, values: np.ndarray):
        self.planes, self.zeros = [], []
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.planes.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of ``low:high`` are smaller than x."""
        count = np.where(x >> self.bits > 0, high - low, 0)
        for k, (ones, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = ones[low], ones[high]
            one = ((x >> (self.bits - 1 - k)) & 1).astype(bool)
            count = count + np.where(one & (x >> self.bits == 0), (high - low) - (b - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest (from 0) of the values of ``low:high``."""
        value = np.zeros(len(low), np.int64)
        for k, (ones, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = ones[low], ones[high]
            without = (high - low) - (b - a)
            one = n >= without
            value += np.where(one, 1 << (self.bits - 1 - k), 0)
            n = np.where(one, n - without, n)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value >= x of ``low:high``, or -1."""
        n = self.below(low, high, x)
        out = np.full(len(low), -1, np.int64)
        some = np.flatnonzero(n < high - low)
        out[some] = self.nth(low[some], high[some], n[some])
        return out


class Ranks:
    """Ranks of every place by its next 2^k words, for k = 0, 1, ... as long as
    some text can hold a run of that period; a rank is the number of places
    before its group. ``blocks`` are the dyadic blocks that occur again."""

    def __init__(self, symbol: np.ndarray, doc: np.ndarray, exponent: int):
        n = len(symbol)
        words = np.bincount(doc)[doc]
        order = np.lexsort([symbol, doc])
        fresh = np.ones(n, bool)
        fresh[1:] = (symbol[order[1:]] != symbol[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
        begin = np.flatnonzero(fresh)
        count = np.diff([*begin, n])
        group = np.cumsum(fresh) - 1
        rank = np.empty(n, np.int32)
        rank[order] = begin[group]
        again = np.empty(n, np.int32)
        again[order] = count[group]
        self.ranks = [rank]
        found = []
        active = np.flatnonzero(again > 1)
        step = 1
        while True:
            held = active[(active % step == 0) & (words[active] >= exponent * step)]
            found.append((held, np.full(len(held), step), rank[held].astype(np.int64), rank[held] + again[held].astype(np.int64)))
            if not len(held) and not (words[active] >= exponent * step).any():
                break
            after = active + step
            follow = np.where(after < n, rank[np.minimum(after, n - 1)], -1).astype(np.int64) + 1
            key = rank[active].astype(np.int64) * (n + 1) + follow
            order = np.argsort(key, kind="stable")
            key, placed = key[order], active[order]
            new, old = np.ones(len(key), bool), np.ones(len(key), bool)
            new[1:], old[1:] = key[1:] != key[:-1], rank[placed[1:]] != rank[placed[:-1]]
            at_, was = np.arange(len(key)), rank[placed]
            begin = np.flatnonzero(new)
            count = np.diff([*begin, len(key)])
            group = np.cumsum(new) - 1
            rank = rank.copy()
            rank[placed] = was + (begin[group] - np.maximum.accumulate(np.where(old, at_, 0)) if len(key) else 0)
            again = np.ones(n, np.int32)
            again[placed] = count[group]
            self.ranks.append(rank)
            active = active[again[active] > 1]
            step *= 2
        self.blocks = [np.concatenate(x) for x in zip(*found)]
        self.suffixes = np.argsort(rank, kind="stable")

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j)."""
        got, n = np.zeros(len(i), np.int64), len(self.ranks[0])
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, live = self.ranks[k], np.arange(len(i))
            while len(live):
                b = j[live] + got[live]
                live = live[(b < n) & (rank[i[live] + got[live]] == rank[np.minimum(b, n - 1)])]
                got[live] += 1 << k
                if k < len(self.ranks) - 1:
                    break
        return got

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j (i < j)."""
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, step, live = self.ranks[k], 1 << k, np.arange(len(i))
            while len(live):
                a = i[live] - got[live] - step
                live = live[(a >= 0) & (rank[np.maximum(a, 0)] == rank[j[live] - got[live] - step])]
                got[live] += step
                if k < len(self.ranks) - 1:
                    break
        return got


def _candidates(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) candidates of all dyadic blocks."""
    block, size, low, high = ranks.blocks
    tree = WaveletTree(ranks.suffixes)
    place, end = block.copy(), np.full(len(block), -1, np.int64)
    found = []
    live = np.arange(len(block))
    while len(live):
        near = tree.successor(low[live], high[live], place[live] + 1)
        ok = (near >= 0) & (near < block[live] + 2 * size[live])
        live, near = live[ok], near[ok]
        b, s, was = block[live], size[live], place[live]
        far = near - b >= s
        found.append((b[far], (near - b)[far]))
        gap = near - was
        chain = np.flatnonzero(2 * gap <= s)
        at_, p = live[chain], gap[chain]
        stretch = near[chain] + ranks.forward(was[chain], near[chain])
        first = was[chain] == b[chain]
        end[at_[first]] = stretch[first]
        unknown = (end[at_] < 0).nonzero()[0]
        own = b[chain][unknown]
        end[at_[unknown]] = own + p[unknown] + ranks.forward(own, own + p[unknown])
        q = stretch - end[at_]
        fits = ~first & (q >= s[chain]) & (q < 2 * s[chain])
        found.append((b[chain][fits], q[fits]))
        place[live] = near
        place[at_] = was[chain] + (stretch - was[chain] - s[chain]) // p * p
    at_ = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    period = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
    return at_, period


def find_runs(symbol: np.ndarray, doc: np.ndarray, exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, ordered by start, then period. ``doc``
    rises and tells the texts apart; ``exponent`` is 4 or more."""
    empty = np.zeros(0, np.int64)
    if not len(symbol):
        return empty, empty, empty
    ranks = Ranks(symbol, doc, exponent)
    at_, period = _candidates(ranks)
    ok = at_ + period < len(symbol)
    at_, period = at_[ok], period[ok]
    start = at_ - ranks.backward(at_, at_ + period)
    end = at_ + period + ranks.forward(at_, at_ + period)
    ok = (end - start >= np.maximum(min_length, exponent * period))
    start, end, period = start[ok], end[ok], period[ok]
    order = np.lexsort([period, end, start])
    start, end, period = start[order], end[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort([period, start])
    return start[order], end[order], period[order]


def _run_batches(batches, exponent: int, min_length: int):
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        for part in at.slices(batch.column(1)):
            start, end = at.runs(~_IS_SPACE[part.data], part.offsets)
            rows = part.hi - part.lo
            doc = np.searchsorted(part.offsets, start, "right") - 1
            first = np.searchsorted(start, part.offsets, "left")
            a, b, q = find_runs(at.hash_ranges(part.data, start, end), doc, exponent, min_length)
            cover = np.zeros(len(start) + 1, np.int64)
            np.add.at(cover, a + q, 1)
            np.add.at(cover, b, -1)
            dropped = np.cumsum(cover[:-1]) > 0
            lost = np.add.reduceat(np.append(dropped, False), first[:-1]) * (np.diff(first) > 0) if rows else []
            texts = []
            for r in range(rows):
                if lost[r]:
                    held = np.flatnonzero(~dropped[first[r]:first[r + 1]]) + first[r]
                    whole = part.data[part.offsets[r]:part.offsets[r + 1]].tobytes()
                    texts.append(b" ".join([whole[x:y] for x, y in zip((start[held] - part.offsets[r]).tolist(), (end[held] - part.offsets[r]).tolist())]))
                else:
                    texts.append(b" ".join(part.data[part.offsets[r]:part.offsets[r + 1]].tobytes().split()))
            owner = doc[a] if len(a) else np.zeros(0, np.int64)
            edge = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
            runs = pa.ListArray.from_arrays(edge, pa.StructArray.from_arrays(
                [pa.array(a - first[owner]), pa.array(b - a), pa.array(q)], fields=list(run)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(part.lo, rows), pa.array(np.diff(first).astype(np.int64)), runs, pa.array(texts, pa.binary()).cast(pa.string())],
                names=["row_key", "n_words", "runs", "collapsed"])


def runs(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """row_key, n_words, runs (start, length and period in words, by start, then
    period) and collapsed: the words joined by one space, without those that a
    run holds after its first period. One row per row of ``docs``."""
    if exponent < 4:
        raise ValueError("exponent is 4 or more")
    on_workers(spark)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`").alias("row_key"), F.col(f"`{text}`").alias("t")).mapInArrow(
        lambda b: _run_batches(b, exponent, min_length),
        f"row_key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def brute_force(words: list, exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of one text, by trying every period (for tests)."""
    number: dict = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // exponent + 1):
        equal = np.concatenate([[False], w[q:] == w[:-q], [False]])
        begin, end = np.flatnonzero(equal[1:] & ~equal[:-1]), np.flatnonzero(equal[:-1] & ~equal[1:])
        for i, j in zip(begin.tolist(), end.tolist()):
            if j + q - i >= max(min_length, exponent * q):
                found.setdefault((i, j + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())
