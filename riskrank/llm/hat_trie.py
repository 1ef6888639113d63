"""A HAT-trie that counts short phrases of numbered words: burstable hash containers under a shallow trie of word ids.

A phrase of two or three words is one 64-bit key: word numbers from the top, 21 bits each, the third one raised by one
so that 0 means none.  A node of the trie has a hash container for the phrases below it and children for those words
that have come to fill it.  A container that outgrows its limit bursts: each word that leads many of its phrases becomes
a child with a container of its own.  The trie is at most two words deep.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np

BITS = 21
#: Words that can be numbered; the third place holds one number more.
MAX_WORDS = (1 << BITS) - 2
_MASK = np.uint64((1 << BITS) - 1)
_SHIFTS = (np.uint64(2 * BITS), np.uint64(BITS))


def pack(first: np.ndarray, second: np.ndarray, third: np.ndarray | None = None) -> np.ndarray:
    """Keys of phrases of two words, or of three."""
    keys = (first.astype(np.uint64) << _SHIFTS[0]) | (second.astype(np.uint64) << _SHIFTS[1])
    return keys if third is None else keys | (third.astype(np.uint64) + np.uint64(1))


def unpack(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First, second and third word numbers; the third is -1 where there is none."""
    first, second = (keys >> _SHIFTS[0]).astype(np.int64), ((keys >> _SHIFTS[1]) & _MASK).astype(np.int64)
    return first, second, (keys & _MASK).astype(np.int64) - 1


class Node:
    """Counts of the phrases that begin with one path of words."""

    def __init__(self, depth: int, limit: int):
        self.depth, self.limit = depth, limit
        self.container: Counter = Counter()
        self.children: dict[int, Node] = {}
        self._ids = np.zeros(0, np.uint64)

    def size(self) -> int:
        return len(self.container) + sum(c.size() for c in self.children.values())

    def add(self, keys: np.ndarray) -> None:
        if self.children:
            words = (keys >> _SHIFTS[self.depth]) & _MASK
            slot = np.searchsorted(self._ids, words)
            slot[self._ids[np.minimum(slot, len(self._ids) - 1)] != words] = len(self._ids)
            order = np.argsort(slot, kind="stable")
            bounds = np.searchsorted(slot[order], np.arange(len(self._ids) + 1)).tolist()
            for word, a, b in zip(self._ids.tolist(), bounds, bounds[1:]):
                if a < b:
                    self.children[word].add(keys[order[a:b]])
            keys = keys[order[bounds[-1]:]]
        self.container.update(keys.tolist())
        self.burst()

    def burst(self) -> None:
        """Give every word that leads a good part of a full container's phrases a child of its own."""
        if len(self.container) <= self.limit or self.depth == len(_SHIFTS):
            return
        keys = np.fromiter(self.container, np.uint64, len(self.container))
        words = (keys >> _SHIFTS[self.depth]) & _MASK
        found, n = np.unique(words, return_counts=True)
        heavy = found[n >= max(2, self.limit // 256)]
        if not len(heavy):
            self.limit *= 2  # many words with few phrases each: the container is the right place for them
            return
        moved = keys[np.isin(words, heavy)]
        for key, word in zip(moved.tolist(), ((moved >> _SHIFTS[self.depth]) & _MASK).tolist()):
            child = self.children.get(word)
            if child is None:
                child = self.children[word] = Node(self.depth + 1, self.limit)
            child.container[key] += self.container.pop(key)
        self._ids = np.array(sorted(self.children), np.uint64)
        for word in heavy.tolist():
            self.children[word].burst()

    def take(self) -> list[Counter]:
        """The containers of the whole subtree, which starts anew with empty ones."""
        taken, self.container = self.container, Counter()
        return [taken, *(c for child in self.children.values() for c in child.take())]


class HatTrie:
    """Counts phrases in bounded memory; whole subtrees are handed out when there are too many."""

    def __init__(self, memory: int, limit: int):
        self.memory, self.limit = memory, limit
        self.root = Node(0, limit)

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.root.add(keys)

    def spill(self, everything: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
        """Keys and counts of the largest subtrees, which leave the trie, if it holds more than its memory allows.

        The nodes stay: words that filled a container once are likely to do so again.
        """
        total = self.root.size()
        if not total or not everything and total <= self.memory:
            return None
        out: list[Counter] = []
        largest = sorted(self.root.children, key=lambda w: self.root.children[w].size(), reverse=True)
        keep = 0 if everything else self.memory // 2
        if total - sum(c.size() for c in self.root.children.values()) > keep:
            total -= len(self.root.container)
            out.append(self.root.container)  # the small subtrees, all at once
            self.root.container = Counter()
        for word in largest:
            if total <= keep:
                break
            subtree = self.root.children[word]
            total -= subtree.size()
            out += subtree.take()
        n = sum(map(len, out))
        keys = np.fromiter(chain.from_iterable(out), np.uint64, n)
        return keys, np.fromiter(chain.from_iterable(c.values() for c in out), np.int64, n)
