"""Token ids of whole texts by a tokenizer of the `tokenizers` library that splits at white space.

Most words of a corpus occur again and again, so a task encodes each distinct word once and looks the rest up.  A
word's trailing ASCII punctuation is split off first, and A-Z are lower-cased: for a lower-casing BPE whose
pre-tokenizer never joins a letter or digit with punctuation after it, neither changes the ids.  Documents in which
the text of a special token could begin (`<|`) go to the tokenizer as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from riskrank.llm.text import LOWER, Block

#: Distinct words that a task remembers.
MEMORY = 400_000

_TAIL = np.zeros(256, bool)
_TAIL[list(b".,;:!?|#$%&*()[]{}=+-/\\\"~^@_>")] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True

#: The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for code points from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHAR = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each stretch, one after another."""
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return shift + np.arange(len(shift))


class WordIds:
    """Ids of words by their hash, kept from block to block."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def encode(self, word: str) -> list[int]:
        plain = word.isascii()
        if word.isalpha() and (plain or (max(word) < "\u0180" and word == word.lower()
                                         and unicodedata.is_normalized("NFC", word))):
            piece = word if plain else word.encode().decode("latin-1").translate(_BYTE_CHAR)
            return [t.id for t in self.tokenizer.model.tokenize(piece)]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def learn(self, keys: np.ndarray, words: Iterator[str]) -> None:
        found = [self.encode(w) for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(size.sum()))
        start = len(self.flat) + np.cumsum(size) - size
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.start = np.concatenate([self.start, start])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.flat = np.concatenate([self.flat, flat])

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One memory per worker process."""
    return WordIds(path)


def _special(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents with `<|` in them."""
    at = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if len(data) > 1 else np.zeros(0, np.int64)
    return np.unique(np.searchsorted(offsets, at, "right") - 1)


def block_ids(block: Block, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a block, each followed by `end`, and where each document begins."""
    memory = word_ids(path)
    raw = block.data
    block = Block(LOWER[raw], block.offsets, block.first).split()
    odd = _special(raw, block.offsets)

    stop = block.ends.copy()
    live = np.arange(len(stop))
    while len(live):
        live = live[(stop[live] > block.starts[live]) & _TAIL[block.data[np.maximum(stop[live] - 1, 0)]]]
        stop[live] -= 1
    bare = (stop > block.starts) & _ALNUM[block.data[np.maximum(stop - 1, 0)]] & (stop < block.ends)
    stop = np.where(bare, stop, block.ends)
    n_units = 1 + bare.astype(np.int64)
    at = np.cumsum(n_units) - n_units
    total = int(n_units.sum())
    begin, finish = np.empty(total, np.int64), np.empty(total, np.int64)
    begin[at], finish[at] = block.starts, stop
    begin[at[bare] + 1], finish[at[bare] + 1] = stop[bare], block.ends[bare]
    unit_at = np.append(at, total)[block.word_at]

    keys, first, which = np.unique(block.hashes(begin, finish), return_index=True, return_inverse=True)
    if len(new := np.flatnonzero(memory.missing(keys))):
        if len(memory.keys) + len(new) > MEMORY:
            memory.clear()
            new = np.arange(len(keys))
        text = block.data.tobytes()
        memory.learn(keys[new], (text[a:b].decode() for a, b in
                                 zip(begin[first[new]].tolist(), finish[first[new]].tolist(), strict=True)))
    place = np.searchsorted(memory.keys, keys) if len(keys) else np.zeros(0, np.int64)
    size, start = memory.size[place][which], memory.start[place][which]
    ahead = np.zeros(total + 1, np.int64)
    np.cumsum(size, out=ahead[1:])
    ids = memory.flat[_ragged(start, size)]
    bounds = ahead[unit_at]
    docs = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    for d in odd.tolist():
        text = raw[block.offsets[d] : block.offsets[d + 1]].tobytes().decode()
        docs[d] = np.array(memory.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
    close = np.array([end], np.uint32)
    sizes = np.array([len(d) + 1 for d in docs], np.int64)
    out = np.concatenate([x for d in docs for x in (d, close)]) if docs else np.zeros(0, np.uint32)
    return out, np.append(0, np.cumsum(sizes))
