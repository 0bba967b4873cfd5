"""Vectorised word hashing over whole texts, for use inside Arrow tasks.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. Words, shingles and windows are
identified by 64-bit polynomial hashes over all their bytes (random byte table, odd base, wrap-around
arithmetic, mixed at the end), computed for a slice of texts at once with prefix sums, so cost is linear
in the bytes and no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21          # texts are worked on in slices of about this many bytes (a longer text is its own slice)

_RNG = np.random.default_rng(20240229)
_TABLE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
_LOWER_TABLE = _TABLE.copy()
_LOWER_TABLE[65:91] = _TABLE[97:123]
_BASE = 0x9E3779B97F4A7C17          # = 3 mod 4, invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD_BASE = 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
SYMBOLS = ~np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])   # separators of plain words
_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("n", 0)
    if have < n:
        size = max(n, 2 * SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
        _POWERS["n"] = size
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of ``column`` whose texts hold about ``limit`` bytes (one row at least)."""
    if not len(column):
        return
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """Words of a slice of texts.

    ``first[i]:first[i + 1]`` are the words of text i; ``start``/``end`` are byte positions in ``data``.
    """

    def __init__(self, texts: list[bytes], lower: bool, separators: np.ndarray = _SPACE):
        blob = b" ".join(texts)
        self.data = data = np.frombuffer(blob, np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        word = ~separators[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER_TABLE if lower else _TABLE)[data] * up[: len(data)], out=total[1:])
        h = (total[self.end] - total[self.start]) * down[self.start]
        self.hash = mix(h ^ (self.end - self.start).astype(np.uint64))
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends)]).astype(np.int64)
        self._total, self._down = total, down

    def prefix_hash(self, size: int) -> np.ndarray:
        """Hash of each word's first ``size`` bytes; 0 for a word that has no more than these."""
        long = self.end - self.start > size
        at = self.start[long]
        out = np.zeros(len(self.start), np.uint64)
        out[long] = mix((self._total[at + size] - self._total[at]) * self._down[at] ^ np.uint64(size << 32))
        return out

    def windows(self, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every ``size``-word window, row bounds); with ``short`` a text of 1..size-1 words gives one
        window made of all its words."""
        w, first = self.hash, self.first
        counts = np.diff(first)
        n = len(w) - size + 1
        roll = np.zeros(max(n, 0), np.uint64)
        power = 1
        for k in range(size if n > 0 else 0):
            roll += w[k:k + n] * np.uint64(power)
            power = power * _WORD_BASE % (1 << 64)
        own = np.maximum(counts - size + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(own)])
        pos = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], own)
        out = mix(roll[pos]) if len(pos) else np.zeros(0, np.uint64)
        if not short:
            return out, bounds
        few = np.flatnonzero((counts > 0) & (counts < size))
        if len(few):
            extra = np.array([self._whole(int(first[i]), int(counts[i])) for i in few], np.uint64)
            out = np.insert(out, bounds[few], extra)
            own[few] = 1
            bounds = np.concatenate([[0], np.cumsum(own)])
        return out, bounds

    def _whole(self, start: int, size: int) -> int:
        return int(_short_hash(self.hash[start:start + size], size)[0])

    def short_windows(self, size: int) -> np.ndarray:
        """Hash of every run of ``size`` words, of the kind ``short`` gives whole short texts."""
        return _short_hash(self.hash, size)


def _short_hash(words: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(words) - size + 1)
    roll = np.full(n, size, np.uint64)
    power = 1
    for k in range(size):
        roll += words[k:k + n] * np.uint64(power)
        power = power * _WORD_BASE % (1 << 64)
    return mix(roll ^ np.uint64(0xA5A5A5A5A5A5A5A5))


def words_of(column: pa.Array, lower: bool) -> Words:
    """Words of a slice of a string column; a null text has none."""
    return Words([b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()], lower)


def plain_words_of(column: pa.Array) -> Words:
    """Lower-cased words without ASCII punctuation; a null text has none."""
    return Words([b"" if v is None else v.lower().encode() for v in column.to_pylist()], False, SYMBOLS)


def distinct_per_text(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in rising order, with new bounds."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    v, r = v[keep], r[keep]
    return v, np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(bounds) - 1))]).astype(np.int64)
