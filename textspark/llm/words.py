"""Words of a slice of texts as numpy arrays: places, 64-bit hashes, and hashes of runs of words.

A word is a maximal run of bytes other than space and the five ASCII controls 09-0D; letters A-Z may be folded.
Hashes are polynomials modulo 2^64 with a final mix. Two different words, or runs, agree with a chance of about 2^-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93


class _Powers:
    """Powers of an odd base and of its inverse, made as far as the longest slice needs."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS: dict[int, _Powers] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _POWERS.setdefault(base, _Powers(base)).upto(n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def buffer(column: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins (one entry more than texts). Null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.zeros(0, np.uint8)
    return (_FOLD[data] if fold else data), edges - edges[0]


@dataclass
class Words:
    data: np.ndarray  # bytes of the slice
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    first: np.ndarray  # first word of each text, and the number of words
    hash: np.ndarray  # uint64 of each word

    def text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def runs(self, k: int, base: int = _WORD_BASE) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they all lie in the word's text."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        hashes = run_hashes(self.hash, k, base)
        text = self.text()
        return hashes, text[: n - k + 1] == text[k - 1 :]


def run_hashes(values: np.ndarray, k: int, base: int = _WORD_BASE) -> np.ndarray:
    up, down = _powers(base, len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=total[1:])
    return mix((total[k:] - total[:-k]) * down[: len(values) - k + 1])


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _WORD_BASE) -> np.ndarray:
    """Hash of values[start:end] for many spans; equal to `run_hashes` where the length is k."""
    up, down = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def split_words(column: pa.Array, fold: bool = True, blank: np.ndarray = _SPACE) -> Words:
    """Words of each text; `blank` marks the bytes between words."""
    data, edges = buffer(column, fold)
    solid = ~blank[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    inner = edges[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(_BYTE_BASE, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return Words(data, start, end, np.searchsorted(start, edges), hashes)


def first_of_runs(sorted_values: np.ndarray) -> np.ndarray:
    """Marks the first of equal neighbours."""
    out = np.ones(len(sorted_values), bool)
    out[1:] = sorted_values[1:] != sorted_values[:-1]
    return out


@dataclass
class ShingleSets:
    values: np.ndarray  # uint64, sorted and distinct within each text
    ends: np.ndarray  # end of each text's values


def shingle_sets(words: Words, k: int) -> ShingleSets:
    """Distinct k-word shingles of each text; a text of fewer words has its whole sequence as one."""
    counts = np.diff(words.first)
    hashes, inside = words.runs(k)
    sizes = np.maximum(counts - k + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < k))
    hashes = hashes[inside]
    if len(short):
        whole = span_hashes(words.hash, words.first[short], words.first[short + 1])
        hashes = np.insert(hashes, np.cumsum(sizes)[short], whole)
        sizes[short] = 1
    else:
        hashes = hashes.copy()
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        hashes[a:b].sort()
    fresh = first_of_runs(hashes)
    fresh[(ends - sizes)[sizes > 0]] = True
    return ShingleSets(hashes[fresh], np.concatenate([[0], np.cumsum(fresh)])[ends])
