"""Language-model scores from a probabilistic suffix tree over words.

The root of the tree holds the distribution of single tokens; a node for a context of up to `depth` words holds that of
the token that follows.  A context is a candidate if it occurs at least `least_count` times, however large the corpus.
It is retained if its divergence from its longest retained suffix, estimated with every occurrence left out of its own
prediction, exceeds `divergence` nats per token.  Distributions are smoothed by absolute discounting: what is taken
off the counts goes to the distribution of the longest retained suffix, and at the root to the unknown token.  A token
is scored in the longest retained state that its preceding words allow.

Counts are taken over all learning documents and looked up for all documents, level by level: chunks of documents ask
hash buckets for the counts of their distinct tokens, then of their distinct continuations of candidate contexts of
one word, of two and so on.  Contexts are 64-bit hashes.  A context's continuations meet in one bucket, which tests the
context and answers whether it is retained.  Only contexts that occur more often than a bucket has tokens on average
are dealt over all buckets; their sums, fewer than there are buckets, and four totals pass through the driver.

Nulls and empty texts are the end token alone.  A missing id counts as an empty one.  Without learning documents
every token is unknown and scores 0.  Repeated rows score alike, extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.llm.chunks import NO_ID, Chunk, by_bucket, chunked, expand, long, short, squeeze
from riskrank.llm.text import distinct, mix, sort_pairs
from riskrank.session import cut_lineage

#: The end token's hash (any number that no word is likely to have).
END = np.uint64(0xE0D0F0E0D0F0E0D1)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
#: Assumed backing-off weight of a context that has not been counted yet, in the test of a longer one.
_WEIGHT = 0.3
#: Gains are summed as whole numbers of this fraction of a nat, in any order alike.
_UNIT = 1e6

_SENT = "bucket long, chunk long, body binary"
_ANSWER = "chunk long, part long, kind int, body binary"


@dataclass(frozen=True)
class Tree:
    """Parameters of the model."""

    least_count: int = 8
    discount: float = 0.75
    divergence: float = 0.01
    depth: int = 2

    def retained(self, n: np.ndarray, kinds: np.ndarray, once: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """The divergence test of contexts: occurrences, distinct continuations, those seen once, sum of `_gains`."""
        n = np.maximum(n, 1)
        # every occurrence of a continuation seen once is left to the suffix, the others gain or lose by their counts
        left = np.log(self.discount * np.maximum(kinds, 1) / n)
        return gain / _UNIT - (n - once) * np.log(n) + once * left > self.divergence * n


@dataclass(frozen=True)
class Totals:
    """Learning tokens, distinct ones, those seen once and twice."""

    tokens: int
    distinct: int
    once: int
    twice: int

    @property
    def discount(self) -> float:
        return self.once / (self.once + 2 * self.twice) if self.once else 0.5

    def root(self, counts: np.ndarray) -> np.ndarray:
        """Probability of tokens with these counts; count 0 is the unknown token."""
        if not self.tokens:
            return np.ones(len(counts))
        unknown = self.discount * self.distinct / self.tokens
        return np.where(counts > 0, (counts - self.discount) / self.tokens, unknown)


@dataclass(frozen=True)
class Frequent:
    """Contexts of one length whose continuations are dealt over all buckets: hashes (sorted), continuations of the
    retained ones, 0 for the others."""

    names: np.ndarray
    kinds: np.ndarray

    def find(self, names: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.zeros(len(names), np.int64)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, self.kinds[at], 0)


class Tokens:
    """The tokens of a chunk in order (each document's words and its end), and its distinct ones, by hash."""

    def __init__(self, chunk: Chunk, learns: Callable[[int | None], bool]):
        parts, sizes = [], []
        for block in chunk.blocks(lower=True):
            hashes = block.split().word_hashes()
            out = np.full(len(hashes) + block.n_docs, END, np.uint64)
            out[np.arange(len(hashes)) + block.word_docs()] = hashes
            parts.append(out)
            sizes.append(np.diff(block.word_at) + 1)
        self.at = np.append(0, np.cumsum(np.concatenate(sizes)))
        self.learns = np.array([learns(None if i == NO_ID else i) for i in chunk.ids.tolist()], bool)
        self.learning = np.repeat(self.learns, np.diff(self.at))
        self.keys, _, self.of = distinct(np.concatenate(parts))
        self.own = np.bincount(self.of[self.learning], minlength=len(self.keys)).astype(np.uint32)


class Walk:
    """The tokens of a chunk on their way down the tree, a level at a time.

    `number` and `seen` are, for each token, the number and the count of the words up to and with it, as many as the
    level (count 0 where there are fewer); `names` has the hash of each number.  `p` is the token's probability so far and
    `guess` that by assumed backing-off weights.
    """

    def __init__(self, tokens: Tokens, counts: np.ndarray, totals: Totals, tree: Tree, bits: int):
        self.tokens, self.tree, self.bits = tokens, tree, bits
        self.limit = totals.tokens >> bits
        self.p = totals.root(counts)[tokens.of]
        self.guess = self.p.copy()
        self.number, self.names = tokens.of, tokens.keys
        self.seen = np.where(tokens.keys == END, 0, counts)[tokens.of]
        self.inside = np.zeros(len(self.p), bool)
        self.ask()

    def ask(self) -> None:
        """The distinct continuations of candidate contexts, in the order of buckets and contexts."""
        ready = np.zeros(len(self.seen), bool)
        ready[1:] = self.seen[:-1] >= self.tree.least_count
        ready[self.tokens.at[:-1]] = False
        self.at = np.flatnonzero(ready)
        before, after = self.number[self.at - 1], self.tokens.of[self.at]
        order, new = sort_pairs(before, after)
        first, of = order[new], np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        before = before[first]  # rises, so each context is one stretch
        stretch = np.flatnonzero(np.diff(before, prepend=-1))
        rank = np.empty(len(stretch), np.int64)
        rank[np.argsort(self.names[before[stretch]])] = np.arange(len(stretch))
        rank = np.repeat(rank, np.diff(np.append(stretch, len(before))))
        context, often = self.names[before], self.seen[self.at - 1][first] > self.limit
        keys = mix(self.tokens.keys[after[first]] + context * _PAIR)
        bucket = (np.where(often, keys, context) >> np.uint64(64 - self.bits)).astype(np.int64)
        order, new = sort_pairs(bucket, rank)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.entry, self.first = place[of], first[order]
        self.keys, self.context, self.often = keys[order], context[order], often[order]
        own = np.bincount(of[self.tokens.learning[self.at]], minlength=len(keys)).astype(np.uint32)
        self.own, self.bucket = own[order], bucket[order]
        self.group, self.begin = np.cumsum(new) - 1, np.flatnonzero(new)

    def questions(self) -> list[tuple[int, bytes]]:
        guess = np.log(self.guess[self.at[self.first]]).astype(np.float32)
        edge = np.flatnonzero(np.r_[True, self.bucket[1:] != self.bucket[:-1]]) if len(self.bucket) else []
        rows = []
        for a, b in zip(edge, np.append(edge[1:], len(self.bucket)), strict=True) if len(edge) else []:
            group = slice(self.group[a], self.group[b - 1] + 1)
            begin = self.begin[group]
            rows.append((int(self.bucket[a]), squeeze(
                short(self.keys[a:b]), self.own[a:b], guess[a:b], self.context[begin],
                np.diff(np.append(begin, b)).astype(np.uint32), self.often[begin].astype(np.uint8))))
        return rows

    def down(self, counts: np.ndarray, kinds: np.ndarray, frequent: Frequent) -> None:
        """Take the counts of the continuations and the states of the contexts, and go on to longer contexts."""
        kinds = kinds[self.group] if len(self.group) else np.zeros(0, np.int64)
        kinds = np.where(self.often, frequent.find(self.context), kinds)[self.entry]
        n, again, discount = self.seen[self.at - 1], counts[self.entry], self.tree.discount
        number, seen = np.zeros(len(self.seen), np.int64), np.zeros(len(self.seen), np.int64)
        number[self.at] = self.entry
        seen[self.at] = np.where(self.tokens.keys[self.tokens.of[self.at]] == END, 0, again)
        held = kinds > 0
        at, n, kinds = self.at[held], n[held], kinds[held]
        part = np.maximum(again[held] - discount, 0) / n
        self.p[at] = part + discount * kinds / n * self.p[at]
        self.guess[at] = part + _WEIGHT * self.guess[at]
        self.inside[at] = True
        self.number, self.names, self.seen = number, self.keys, seen


def _sent(chunk: int, rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int64()),
                     "chunk": pa.array([chunk] * len(rows), pa.int64()),
                     "body": pa.array([b for _, b in rows], pa.binary())})


def _answers(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    chunk, part, kind, body = zip(*rows, strict=True)
    return pa.table({"chunk": pa.array(chunk, pa.int64()), "part": pa.array(part, pa.int64()),
                     "kind": pa.array(kind, pa.int32()), "body": pa.array(body, pa.binary())})


def _ask_tokens(learns, bits: int):
    def ask(key, table):
        tokens = Tokens(Chunk(table.column("docs")), learns)
        return _sent(key[0].as_py(), [(b, squeeze(short(tokens.keys[at]), tokens.own[at]))
                                      for b, at in by_bucket(bits, tokens.keys)])

    return ask


def _count_tokens(key, table):
    """Counts for every chunk (kind 0); the bucket's totals (kind -1)."""
    part, chunks = key[0].as_py(), table.column("chunk").to_pylist()
    parts = [expand(b, "V7", "u4") for b in table.column("body").to_pylist()]
    _, _, of = distinct(long(np.concatenate([p[0] for p in parts])))
    counts = np.bincount(of, np.concatenate([p[1] for p in parts]).astype(float)).astype(np.int64)
    rows = [(c, part, 0, squeeze(x)) for c, x in
            zip(chunks, np.split(counts[of], np.cumsum([len(p[0]) for p in parts])[:-1]), strict=True)]
    totals = np.array([counts.sum(), (counts > 0).sum(), (counts == 1).sum(), (counts == 2).sum()], np.int64)
    return _answers(rows + [(-1, part, -1, squeeze(totals))])


def _totals(answers: DataFrame) -> Totals:
    """The sums over all buckets: one row."""
    def rows(batches):
        for batch in batches:
            for body in batch.column("body").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in expand(body, "i8")[0].tolist()], names=names)

    names = list(Totals.__dataclass_fields__)
    sums = answers.filter("kind = -1").select("body").mapInArrow(rows, ", ".join(f"{c} long" for c in names))
    return Totals(*sums.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in names]).first())


def _walk(docs, answers, learns, bits: int, totals: Totals, tree: Tree,
          frequent: list[Broadcast]) -> tuple[Chunk, np.ndarray, Walk]:
    """A chunk's tokens, their counts, and their walk as far as there are answers."""
    chunk = Chunk(docs.column("docs"))
    tokens = Tokens(chunk, learns)
    kind = answers.column("kind")

    def told(level: int, *kinds: str) -> list[np.ndarray]:
        bodies = answers.filter(pa.compute.equal(kind, level)).sort_by("part").column("body").to_pylist()
        parts = [expand(b, *kinds) for b in bodies]
        return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(len(kinds))]

    counts = told(0, "i8")[0]
    walk = Walk(tokens, counts, totals, tree, bits)
    for level, states in enumerate(frequent, 1):
        walk.down(*told(level, "i8", "i8"), states.value)
        if level < tree.depth:
            walk.ask()
    return chunk, counts, walk


def _ask_continuations(*model):
    def ask(key, docs, answers):
        if not docs.num_rows:
            return _sent(0, [])
        return _sent(key[0].as_py(), _walk(docs, answers, *model)[2].questions())

    return ask


def _gains(counts: np.ndarray, suffix: np.ndarray, discount: float) -> np.ndarray:
    """What a continuation adds to its context's left-out log-likelihood ratio, save for the context's totals."""
    again = np.maximum(counts - 1, 1)
    return np.where(counts >= 2, np.rint(counts * (np.log(again - discount) - suffix) * _UNIT), 0.0)


def _count_continuations(tree: Tree, level: int):
    """Counts of continuations, and of those of retained contexts how many there are, for every chunk (the level as
    kind); sums for the divergence tests of the contexts dealt over all buckets (kind -1)."""
    def count(key, table):
        part, chunks = key[0].as_py(), table.column("chunk").to_pylist()
        parts = [expand(b, "V7", "u4", "f4", "u8", "u4", "u1") for b in table.column("body").to_pylist()]
        sizes, groups = [len(p[0]) for p in parts], [len(p[3]) for p in parts]
        names, first, which = distinct(np.concatenate([p[3] for p in parts]))
        often = np.concatenate([p[5] for p in parts])[first] > 0
        context = np.repeat(which, np.concatenate([p[4] for p in parts]))
        _, first, of = distinct(long(np.concatenate([p[0] for p in parts])) + names[context] * _PAIR)
        n = np.bincount(of, np.concatenate([p[1] for p in parts]).astype(float)).astype(np.int64)
        gain = _gains(n, np.concatenate([p[2] for p in parts])[first].astype(float), tree.discount)
        add = lambda x: np.bincount(context[first], x, minlength=len(names)).astype(np.int64)
        sums = [add(n), add(n > 0), add(n == 1), add(gain)]
        kinds = np.where(~often & tree.retained(*sums), sums[1], 0)
        rows = [(c, part, level, squeeze(x, y)) for c, x, y in
                zip(chunks, np.split(n[of], np.cumsum(sizes)[:-1]), np.split(kinds[which], np.cumsum(groups)[:-1]),
                    strict=True)]
        return _answers(rows + [(-1, part, -1, squeeze(names[often], *(x[often] for x in sums)))])

    return count


def _frequent(answers: DataFrame, tree: Tree) -> Frequent:
    """The test of the contexts that are dealt over all buckets."""
    columns = ["name", "n", "kinds", "once", "gain"]

    def rows(batches):
        for batch in batches:
            for body in batch.column("body").to_pylist():
                arrays = [a.view(np.int64) for a in expand(body, "u8", *["i8"] * 4)]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=columns)

    sums = (answers.filter("kind = -1").select("body").mapInArrow(rows, ", ".join(f"{c} long" for c in columns))
            .groupBy("name").agg(*[F.sum(c).alias(c) for c in columns[1:]]))
    table = np.array([tuple(r) for r in sums.collect()], np.int64).reshape(-1, 5)
    names = table[:, 0].copy().view(np.uint64)
    order = np.argsort(names)
    kinds = np.where(tree.retained(*table[:, 1:].T), table[:, 2], 0)
    return Frequent(names[order], kinds[order])


_OUT = ("id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
        "n_in_context long")


def _score(learns, bits: int, totals: Totals, *model):
    def score(key, docs, answers):
        if not docs.num_rows:
            return pa.table({n: pa.array([], k) for n, k in (
                ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                ("n_in_context", pa.int64()))})
        chunk, counts, walk = _walk(docs, answers, learns, bits, totals, *model)
        tokens = walk.tokens
        c = counts[tokens.of]
        base = np.log10((c + 0.5) / (totals.tokens + 0.5 * (totals.distinct + 1)))
        begin = tokens.at[:-1]
        add = lambda x: np.add.reduceat(x, begin)
        return pa.table({
            "id": chunk.id_array(), "held_out": pa.array(~tokens.learns), "n_tokens": pa.array(np.diff(tokens.at)),
            "n_known": pa.array(add((c > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(begin), totals.tokens)),
            "base_score": pa.array(add(base)), "score": pa.array(add(np.log10(walk.p))),
            "n_in_context": pa.array(add(walk.inside.astype(np.int64)))})

    return score


def score_documents(docs: DataFrame, learns: Callable[[int | None], bool], tree: Tree = Tree(),
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score` (single tokens with
    half a count added), `score` (log10 probability by the tree) and `n_in_context` (tokens scored below the root).

    `learns` tells from an id whether the tree learns from that document.
    """
    chunks, bits, dealt = chunked(docs, doc_id, text)
    own = dealt.by(chunks, "chunk")
    known = cut_lineage(dealt.by(own.applyInArrow(_ask_tokens(learns, bits), _SENT), "bucket").applyInArrow(
        _count_tokens, _ANSWER))
    totals, told, frequent = _totals(known), known.filter("kind >= 0"), []
    for level in range(1, tree.depth + 1):
        model = learns, bits, totals, tree, list(frequent)
        asked = own.cogroup(dealt.by(told, "chunk")).applyInArrow(_ask_continuations(*model), _SENT)
        later = cut_lineage(dealt.by(asked, "bucket").applyInArrow(_count_continuations(tree, level), _ANSWER))
        frequent.append(docs.sparkSession.sparkContext.broadcast(_frequent(later, tree)))
        told = told.unionByName(later.filter("kind >= 0"))
    model = learns, bits, totals, tree, frequent
    return own.cogroup(dealt.by(told, "chunk")).applyInArrow(_score(*model), _OUT)
