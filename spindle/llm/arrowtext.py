"""Vectorised word helpers over Arrow text batches.

A word is a maximal run matching ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after
A-Z are lower-cased; the class is decided byte by byte in UTF-8, so numpy can
find and hash all words of a batch at once. Word identity is a 64-bit hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20          # texts are handled in slices of about this size; one longer text is one slice

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
BYTE_VALUE = np.random.RandomState(20240607).randint(1, 2**63 - 1, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(B^i, B^-i) mod 2^64 for i < n; those of a usual slice are kept, longer ones are not."""
    if "b" not in _POWERS or len(_POWERS["b"]) < n:
        made = {}
        for key, base in (("b", _BASE), ("inv", _BASE_INV)):
            steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            steps[0] = 1
            made[key] = np.multiply.accumulate(steps)
        if n > CHUNK_BYTES + 1:
            return made["b"], made["inv"]
        _POWERS.update(made)
    return _POWERS["b"][:n], _POWERS["inv"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Slice:
    """Rows ``lo:hi`` of a batch: raw bytes and, for each row, its byte range."""
    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


def slices(column: pa.Array, chunk_bytes: int = CHUNK_BYTES):
    """Cut a string column into Slices; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type)
    _, obuf, dbuf = column.buffers()
    off = np.frombuffer(obuf, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(dbuf, dtype=np.uint8) if dbuf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + chunk_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Slice(lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


@dataclass
class Words:
    """Words of a slice: row, byte range and hash of each; ``first[r]:first[r+1]`` are those of row r."""
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    low: np.ndarray


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of True, cut at row borders."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def range_hasher(low: np.ndarray):
    """A function (start, end) -> 64-bit hashes of byte ranges (equal bytes, equal hash)."""
    power, inverse = _powers(len(low) + 1)
    total = np.empty(len(low) + 1, np.uint64)
    total[0] = 0
    np.cumsum(BYTE_VALUE[low] * power[:-1], out=total[1:])
    return lambda start, end: mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def hash_ranges(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return range_hasher(low)(start, end) if len(start) else np.zeros(0, np.uint64)


def words(s: Slice) -> Words:
    low = LOWER[s.data]
    start, end = runs(IS_WORD[low], s.offsets)
    doc = np.searchsorted(s.offsets, start, "right") - 1
    first = np.searchsorted(start, s.offsets, "left")
    return Words(doc, start, end, hash_ranges(low, start, end), first, low)


def text_words(text: str | None) -> list[str]:
    """The words of one text, as strings (for small things: phrases, templates, items)."""
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8)
    low = LOWER[data].tobytes()
    start, end = runs(IS_WORD[np.frombuffer(low, np.uint8)], np.array([0, len(raw)]))
    return [low[a:b].decode() for a, b in zip(start, end)]


def word_hashes(tokens: list[str]) -> np.ndarray:
    """The hashes that ``words`` gives to these words."""
    if not tokens:
        return np.zeros(0, np.uint64)
    raw = [t.encode() for t in tokens]
    end = np.cumsum([len(x) for x in raw])
    return hash_ranges(np.frombuffer(b"".join(raw), np.uint8), end - [len(x) for x in raw], end)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first word) of every k-word window; a row of fewer than k
    words, but not none, has one window: all of its words."""
    count = np.diff(w.first)
    per = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    row = np.repeat(np.arange(len(count)), per)
    begin = np.cumsum(per) - per
    at = np.arange(len(row)) - begin[row] + w.first[:-1][row]
    h = np.zeros(len(row), np.uint64)
    last = w.first[1:][row]
    padded = np.concatenate([w.hash, np.zeros(k, np.uint64)])
    for j in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + np.where(at + j < last, padded[at + j], np.uint64(j + 1))
    return mix(h), row, at
