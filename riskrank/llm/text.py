"""Vectorised text kernels for Arrow batches: words, lines and hashes of stretches and windows.

A word is a maximal run of bytes outside `\\x20` and `\\x09-\\x0D`.  These bytes never occur inside a UTF-8
sequence, so all work is on the bytes of an Arrow column, many documents at a time and without a Python loop per
word.  A null text counts as empty here.

Words, lines and texts are hashed eight bytes at a time, each step mixing all that came before; beyond `LANES` steps by
keyed BLAKE2.  Windows of a fixed number of words or bytes have Rabin-Karp hashes modulo 2**64.  These take one sum for
all windows, but texts can be made that collide under any base (Thue-Morse words): of 1024 values at least, so windows
have to be shorter than `MAX_WINDOW`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are handled at once; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Steps of eight bytes that are hashed for many stretches at once; longer ones go to BLAKE2, one by one.
LANES = 16
#: Values in a window of a Rabin-Karp hash, at most.
MAX_WINDOW = 512

_KEY = b"riskrank stretches, version 3"
_SEED, _STEP = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_TAIL_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, hence invertible modulo 2**64
_LOW = 1 << 12


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of an unsigned 64-bit hash over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BYTE_BASE))


class Powers:
    """Powers of an odd base modulo 2**64: as a run from 0, and at any exponent through two short tables."""

    def __init__(self, base: int):
        self.base, self.run = base, np.ones(1, np.uint64)
        low = np.full(_LOW, base, np.uint64)
        low[0] = 1
        self.low = np.multiply.accumulate(low)
        self.high = np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.run) < n:
            self.run = np.multiply.outer(self._high(n), self.low).ravel()
        return self.run[:n]

    def _high(self, n: int) -> np.ndarray:
        need = n // _LOW + 1
        if len(self.high) < need:
            high = np.full(need, pow(self.base, _LOW, 1 << 64), np.uint64)
            high[0] = 1
            self.high = np.multiply.accumulate(high)
        return self.high

    def at(self, i: np.ndarray) -> np.ndarray:
        high = self._high(int(i.max()) + 1 if len(i) else 1)
        return high[i >> 12] * self.low[i & (_LOW - 1)]


_POW = {b: (Powers(b), Powers(pow(b, -1, 1 << 64))) for b in (_BYTE_BASE, _WORD_BASE)}


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp prefix sums of `values` (uint64), with a leading zero."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * _POW[base][0].upto(len(values)), out=out[1:])
    return out


def between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the stretches [start, end), wherever they lie."""
    return mix((sums[ends] - sums[starts]) * _POW[base][1].at(starts) + (ends - starts).astype(np.uint64))


def column(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, from 0) of an Arrow string column; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if not len(array) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def stretch_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches [start, end) of some bytes, wherever they lie."""
    size = (ends - starts).astype(np.int64)
    out = mix(size.astype(np.uint64) * _STEP ^ _SEED)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from every position
    live = np.flatnonzero((size > 0) & (size <= 8 * LANES))
    for step in range(LANES):
        if not len(live):
            break
        left = size[live] - 8 * step
        lane = eight[starts[live] + 8 * step] & _TAIL_MASK[np.minimum(left, 8)]
        out[live] = mix(out[live] * _STEP ^ lane)
        live = live[left > 8]
    for i in np.flatnonzero(size > 8 * LANES).tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8, key=_KEY).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


class Block:
    """Some whole documents: their bytes, document offsets, and the words in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offsets, self.first, self.n_docs = offsets, first, len(offsets) - 1

    @property
    def rows(self) -> slice:
        return slice(self.first, self.first + self.n_docs)

    def split(self) -> Block:
        """Find the words: `starts`, `ends` (byte positions) and `word_at` (first word of each document)."""
        n = len(self.data)
        space = SPACE[self.data]
        full = np.flatnonzero(np.diff(self.offsets))
        before, after = np.empty(n, bool), np.empty(n, bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        before[self.offsets[full]] = True
        after[self.offsets[full + 1] - 1] = True
        word = ~space
        self.starts, self.ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
        self.word_at = np.searchsorted(self.starts, self.offsets)
        return self

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte stretches."""
        return stretch_hashes(self.data, starts, ends)

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)

    def word_docs(self) -> np.ndarray:
        """Document (within the block) of every word."""
        return np.repeat(np.arange(self.n_docs), np.diff(self.word_at))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every window of `width` consecutive values."""
    if width > MAX_WINDOW:
        raise ValueError(f"windows of {width} values, at most {MAX_WINDOW} can be told apart")
    if len(values) < width:
        return np.zeros(0, np.uint64)
    sums = prefix(values, _WORD_BASE)
    starts = np.arange(len(values) - width + 1)
    return between(sums, starts, starts + width, _WORD_BASE)


def windows_inside(word_at: np.ndarray, width: int) -> np.ndarray:
    """Starts of the windows that do not cross a document's end."""
    counts = np.diff(word_at)
    ok = np.ones(max(int(word_at[-1]), 0), bool)
    for back in range(1, width):
        ends = word_at[1:][counts >= back] - back
        ok[ends] = False
    return np.flatnonzero(ok)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `np.unique` with first places and inverse, for 64-bit hashes: sorts their high bits with the places below.

    Where high bits are shared by different hashes, which happens to few arrays, `np.unique` does it.
    """
    n = len(hashes)
    low = np.uint64(max(1, n.bit_length()))
    mask = (np.uint64(1) << low) - np.uint64(1)
    packed = np.sort((hashes & ~mask) | np.arange(n, dtype=np.uint64))
    place = (packed & mask).astype(np.int64)
    found, high = hashes[place], packed & ~mask
    new = np.ones(n, bool)
    new[1:] = found[1:] != found[:-1]
    if (new[1:] & (high[1:] == high[:-1])).any():
        return np.unique(hashes, return_index=True, return_inverse=True)
    of = np.empty(n, np.int64)
    of[place] = np.cumsum(new) - 1
    return found[new], place[new], of


def sort_pairs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of pairs of numbers from 0 on, and which of them in this order differ from the one before."""
    n = len(first)
    new = np.ones(n, bool)
    if not n:
        return np.zeros(0, np.int64), new
    low, width = np.uint64(n.bit_length()), np.uint64(max(1, int(second.max()).bit_length()))
    if int(first.max()).bit_length() + int(width) + int(low) > 64:
        order = np.lexsort((second, first))
        new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
        return order, new
    packed = (first.astype(np.uint64) << width) | second.astype(np.uint64)
    packed = np.sort((packed << low) | np.arange(n, dtype=np.uint64))
    new[1:] = (packed[1:] >> low) != (packed[:-1] >> low)
    return (packed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64), new


def blocks(texts, lower: bool = False, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of about `limit` bytes."""
    data, offsets = column(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield Block(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, lower)
        first = last
