"""Phrase collocations by language: phrases that occur more often than their parts suggest.

Words are counted first, by language.  A phrase is frequent only if its words are, so the frequent words are marked in a
bitmap of fixed size, which is broadcast, and words that it rules out end a phrase: a sieve that changes no result, and
that lets more through as its bits fill up.  Then every task counts the phrases of its documents in a HAT-trie
(`hat_trie`).  Where the trie holds too much, its largest subtrees leave as sorted runs, cut by prefix, the words that
lead to a subtree, into prefix partitions: one compressed row per run and partition.  The runs of a partition meet in one
task, which merges them and drops the phrases below the least count.

A prefix is one word.  Where that word is hot it is two words, and three where both are hot: so no prefix has more than
the phrases of a word that is not hot, and the list of hot words is bounded.

A null text counts as empty and a null language as `und`.  Texts without words and empty tables give no phrases.  Every
row counts, also where rows repeat or share an id.  Very long texts are worked as a whole, some megabytes of words at a
time.  Ties in the score go by count, then by phrase.  Columns other than the two named are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrank.llm.chunks import expand, squeeze
from riskrank.llm.frames import shuffle_width, text_bytes
from riskrank.llm.hat_trie import MAX_WORDS, HatTrie, pack, unpack
from riskrank.llm.text import LOWER, column, mix, stretch_hashes
from riskrank.llm.tokens import _ragged
from riskrank.session import cut_lineage

#: A word is hot that is more than one in `HOT` of all words, so at most this many are collected, and occurs more often
#: than `HOT_LEAST`: the phrases of any other fit a few megabytes.
HOT, HOT_LEAST = 1 << 16, 1 << 17
#: Bytes of text whose phrases one prefix partition holds, on average.
PARTITION_BYTES = 2 << 20
#: Prefix partitions that a shuffle partition holds, on average.
TOGETHER = 8
#: Bytes of text that are cut into words at once.
BLOCK_BYTES = 4 << 20
#: Bits of the sieve of frequent words, as a power of two: 16 MB at most.
SIEVE_BITS = 27

# fixed values: bytes that end a piece, and bytes between words
_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _CUT.copy()
_GAP[[0x20, 0x09]] = True


@dataclass(frozen=True)
class Mining:
    """What makes a phrase, and the sizes that a task keeps to."""

    least: int = 10
    share: int = 50
    top: int = 2000
    entries: int = 350_000  # phrases in a task's trie
    container: int = 1 << 15  # phrases in a container before it bursts
    words: int = 1 << 18  # distinct words that a task remembers


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of some lower-cased documents as bytes, and whether each is followed by one of the same piece."""
    n, gap = len(data), _GAP[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    full = np.flatnonzero(np.diff(offsets))
    before[offsets[full]] = True
    after[offsets[full + 1] - 1] = True
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    cuts = np.cumsum(_CUT[data], dtype=np.int32 if n < 1 << 31 else np.int64)
    document = np.searchsorted(offsets, starts, "right")
    joined = np.zeros(len(starts), bool)
    if len(starts):
        joined[:-1] = (cuts[starts[1:]] == cuts[starts[:-1]]) & (document[1:] == document[:-1])
    return _binary(data[~gap], ends - starts), joined


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Stretches of the given sizes, one after another."""
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(
        np.ascontiguousarray(data))])


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Blocks of lower-cased whole documents (bytes, offsets), each of one language."""
    coded = batch.column("lang").dictionary_encode()
    codes = coded.indices.to_numpy()
    for code, lang in enumerate(coded.dictionary.to_pylist()):
        data, offsets = column(batch.column("text").take(pa.array(np.flatnonzero(codes == code))))
        first, n = 0, len(offsets) - 1
        while first < n:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1)
            yield lang, LOWER[data[offsets[first]:offsets[last]]], offsets[first:last + 1] - offsets[first]
            first = last


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


def count_words(texts: DataFrame, memory: int) -> DataFrame:
    """(lang, phrase, f) of every word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[bytes, int]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.keys(), pa.binary()).cast(pa.string()),
                     pa.array(found.values(), pa.int64())], names=["lang", "phrase", "f"])
            counts.clear()

        for batch in batches:
            for lang, data, offsets in _by_language(batch):
                found, known = words_of(data, offsets)[0].value_counts(), counts.setdefault(lang, {})
                for word, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                    known[word] = known.get(word, 0) + n
                if sum(map(len, counts.values())) > memory:
                    yield from out()
        yield from out()

    rows = texts.mapInArrow(count, "lang string, phrase string, f long")
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def sieve(words: DataFrame, least: int) -> np.ndarray:
    """Bits (as bytes) at the hashes of all words that occur often enough: up to 2**SIEVE_BITS of them."""
    place = F.xxhash64("lang", "phrase").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    found = words.filter(F.col("f") >= least).select(place.alias("place")).groupBy(
        F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(1 << SIEVE_BITS >> 6, np.int64)
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return bits.view(np.uint8)


class Runs:
    """One task's numbered words and trie; turns what leaves the trie into sorted runs by subtree."""

    def __init__(self, mining: Mining, hot: frozenset[tuple[str, str]], frequent: np.ndarray, buckets: int):
        self.mining, self.hot, self.frequent, self.buckets = mining, hot, frequent, buckets
        self.trie = HatTrie(mining.entries, mining.container)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, dict[bytes, int]] = {}
        self.rare: dict[str, set[bytes]] = {}
        self.words: list[bytes] = []
        self.langs: list[str] = []
        self.is_hot: list[bool] = []

    def _number_all(self, lang: str, words: list[bytes]) -> Iterator[int]:
        """Numbers of the words, -1 where the sieve rules a word out."""
        known, rare = self.numbers.setdefault(lang, {}), self.rare.setdefault(lang, set())
        seed, mask, frequent = xxhash.xxh64_intdigest(lang, 42), 8 * len(self.frequent) - 1, self.frequent
        for word in words:
            number = known.get(word)
            if number is None:
                number = -1
                if word not in rare:
                    place = xxhash.xxh64_intdigest(word, seed) & mask
                    if frequent[place >> 3] >> (place & 7) & 1:
                        number = known[word] = len(self.words)
                        self.words.append(word)
                        self.langs.append(lang)
                        self.is_hot.append((lang, word.decode()) in self.hot)
                    else:
                        rare.add(word)
            yield number

    def add(self, lang: str, data: np.ndarray, offsets: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, joined = words_of(data, offsets)
        coded = words.dictionary_encode()
        if sum(map(len, self.rare.values())) > self.mining.words:
            self.rare.clear()
        if len(self.words) + len(coded.dictionary) > min(self.mining.words, MAX_WORDS) and self.words:
            yield from self.spill(everything=True)
            self.forget()
        if len(coded.dictionary) > MAX_WORDS:
            raise ValueError(f"{len(coded.dictionary)} distinct words in one block")
        ids = np.fromiter(self._number_all(lang, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        ids = ids[coded.indices.to_numpy()]
        at = np.flatnonzero(joined & (ids >= 0))
        at = at[ids[at + 1] >= 0]
        self.trie.add(pack(ids[at], ids[at + 1]))
        at = at[joined[at + 1]]
        at = at[ids[at + 2] >= 0]
        self.trie.add(pack(ids[at], ids[at + 1], ids[at + 2]))
        yield from self.spill()

    def spill(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        left = self.trie.spill(everything)
        if left is not None:
            yield self.run(*left)

    def run(self, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        """One row per language and prefix partition: its subtrees in the order of their words (see `merge`)."""
        parts = unpack(keys)
        used = np.flatnonzero(np.bincount(np.concatenate([parts[0], parts[1], parts[2][parts[2] >= 0]])))
        words = [self.words[i] for i in used.tolist()]
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        rank = np.full(len(self.words) + 1, -1, np.int64)  # the last entry stands for no third word
        rank[used[order]] = np.arange(len(order))
        words = [words[i] for i in order.tolist()]
        langs, lang = np.unique([self.langs[i] for i in used[order].tolist()], return_inverse=True)
        hot = np.append(np.array([self.is_hot[i] for i in used[order].tolist()], bool), False)
        size = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(size)
        hashes = stretch_hashes(np.frombuffer(b"".join(words), np.uint8), ends - size, ends)

        w1, w2, w3 = (rank[p] for p in parts)
        sort = np.argsort((w1 << 42) | (w2 << 21) | (w3 + 1))
        w1, w2, w3, counts = w1[sort], w2[sort], w3[sort], counts[sort]
        deep = np.where(hot[w1], np.where(hot[w2] & (w3 >= 0), 3, 2), 1)
        prefix = hashes[w1]
        for level, w in ((2, w2), (3, w3)):
            below = deep >= level
            prefix[below] = mix(prefix[below] * np.uint64(3) + hashes[w[below]])
        bucket = lang[w1] * self.buckets + (prefix % np.uint64(self.buckets)).astype(np.int64)
        sort = np.argsort(bucket, kind="stable")
        w1, w2, w3, deep, counts, bucket = (x[sort] for x in (w1, w2, w3, deep, counts, bucket))

        new = np.ones(len(w1), bool)
        new[1:] = ((bucket[1:] != bucket[:-1]) | (w1[1:] != w1[:-1])
                   | ((deep[1:] > 1) & ((deep[1:] != deep[:-1]) | (w2[1:] != w2[:-1])))
                   | ((deep[1:] > 2) & (w3[1:] != w3[:-1])))
        n, at = len(w1), np.flatnonzero(new)
        # every word twice, before a space and before the end of an entry; then the end of an empty entry
        pool = np.frombuffer(b"".join(w + b" " for w in words) + b"".join(w + b"\n" for w in words) + b"\n", np.uint8)
        size = np.append(size + 1, 1)
        begin, total = np.cumsum(size) - size, int(size[:-1].sum())
        none = len(words)

        def text(*units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Entries of some words, all but the last before a space (-1: none); bytes, and where entries end."""
            place = np.stack(units, axis=1)
            last = np.zeros(place.shape, bool)
            last[:, -1] = True
            lengths = np.where(place < 0, 0, size[place])
            starts = np.where(last, total, 0) + begin[place]
            return pool[_ragged(starts.ravel(), lengths.ravel())], np.cumsum(lengths.sum(axis=1))

        d, a1, a2, a3 = deep[at], w1[at], w2[at], w3[at]
        heads, head_ends = text(np.where(d == 3, a1, -1), np.where(d == 3, a2, np.where(d == 2, a1, -1)),
                                np.where(d == 3, a3, np.where(d == 2, a2, a1)))
        tails, tail_ends = text(np.where((deep == 1) & (w3 >= 0), w2, -1),
                                np.where(deep == 1, np.where(w3 >= 0, w3, w2), np.where((deep == 2) & (w3 >= 0), w3, none)))
        entries = np.diff(np.append(at, n)).astype(np.uint32)
        counts, rows = counts.astype(np.uint32), []
        first = np.flatnonzero(np.diff(bucket[at], prepend=-1))
        for i, j in zip(first.tolist(), [*first[1:].tolist(), len(at)]):
            a, b = int(at[i]), int(at[j]) if j < len(at) else n
            rows.append(squeeze(
                heads[head_ends[i - 1] if i else 0:head_ends[j - 1]], tails[tail_ends[a - 1] if a else 0:tail_ends[b - 1]],
                entries[i:j], counts[a:b]))
        owner, number = np.divmod(bucket[at][first], self.buckets)
        return pa.RecordBatch.from_arrays([pa.array(langs[owner].tolist(), pa.string()), pa.array(number), pa.array(rows)],
                                          names=["lang", "bucket", "run"])


def count_runs(texts: DataFrame, mining: Mining, hot: frozenset[tuple[str, str]], frequent: np.ndarray,
               buckets: int) -> DataFrame:
    """(lang, bucket, run): the sorted runs of all tasks by language and prefix partition."""
    sent = texts.sparkSession.sparkContext.broadcast((hot, zlib.compress(frequent.tobytes(), 1)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(mining, sent.value[0], np.frombuffer(zlib.decompress(sent.value[1]), np.uint8), buckets)
        for batch in batches:
            for lang, data, offsets in _by_language(batch):
                yield from runs.add(lang, data, offsets)
        yield from runs.spill(everything=True)

    return texts.mapInArrow(count, "lang string, bucket long, run binary")


def _split(data: np.ndarray, *marks: int) -> tuple[pa.Array, np.ndarray]:
    """Stretches of bytes that end at one of the marks, without it, and which mark ended each."""
    stop = np.flatnonzero(np.isin(data, marks))
    return _binary(np.delete(data, stop), np.diff(stop, prepend=-1) - 1), data[stop]


def _ranked(values: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Places of values among the distinct ones in order, and these."""
    coded = values.dictionary_encode()
    names = coded.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy()], [names[i] for i in order]


def merge(runs: list[bytes], least: int) -> tuple[list[str], np.ndarray]:
    """Phrases of one prefix partition that occur often enough over all its runs, and their counts.

    A run has its prefixes, the rest of each phrase (empty, one or two words), the number of phrases of each prefix,
    and their counts; all in order, so that sorting them together merges the runs.
    """
    heads, tails, entries, counts = (np.concatenate(x) for x in zip(*(expand(r, "u1", "u1", "u4", "u4") for r in runs)))
    prefix, prefixes = _ranked(_split(heads, 0x0A)[0])
    words, stop = _split(tails, 0x20, 0x0A)
    words, names = _ranked(words)
    last = np.flatnonzero(stop == 0x0A)
    lone = np.diff(last, prepend=-1) == 1
    first, second = words[np.where(lone, last, last - 1)], np.where(lone, 0, words[last] + 1)
    owner = np.repeat(prefix, entries)
    if len(names) >= 1 << 21 or len(prefixes) >= 1 << 21:
        sort = np.lexsort((second, first, owner))
    else:
        sort = np.argsort((owner << 42) | (first << 21) | second, kind="stable")
    owner, first, second, counts = owner[sort], first[sort], second[sort], counts[sort].astype(np.int64)
    change = np.ones(len(owner), bool)
    change[1:] = (owner[1:] != owner[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    at = np.flatnonzero(change)
    sums = np.add.reduceat(counts, at)
    kept = np.flatnonzero(sums >= least)
    at = at[kept]
    phrases = [b" ".join(filter(None, (prefixes[o], names[a], names[b - 1] if b else b""))).decode()
               for o, a, b in zip(owner[at].tolist(), first[at].tolist(), second[at].tolist())]
    return phrases, sums[kept]


def merge_runs(runs: DataFrame, buckets: int, least: int) -> DataFrame:
    """(lang, phrase, f) of phrases that occur often enough: the runs of a prefix partition meet in one task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for *row, run in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if row != key and held:
                    yield out(key[0], *merge(held, least))
                    held = []
                key = row
                held.append(run)
        if held:
            yield out(key[0], *merge(held, least))

    def out(lang: str, phrases: list[str], sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.string()),
                                           pa.array(sums)], names=["lang", "phrase", "f"])

    partitions = max(shuffle_width(runs), -(-buckets // TOGETHER))
    met = runs.repartition(partitions, "lang", "bucket").sortWithinPartitions("lang", "bucket")
    return met.mapInArrow(work, "lang string, phrase string, f long")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact: the products have up to 38 digits."""
    a, left, right = (c.cast("decimal(19,0)") for c in (a, left, right))
    top = F.lit(1_000_000).cast("decimal(7,0)") * a * a
    return F.call_function("div", top, left * right)


def _looked_up(rows: DataFrame, part: str, parts: DataFrame, hot: DataFrame, name: str) -> DataFrame:
    """`rows` with the count of one of their parts: hot words by broadcast, all others by a shuffle."""
    common = F.broadcast(hot.select("lang", F.col("phrase").alias(part), F.col("f").alias("_hot")))
    other = parts.select("lang", F.col("phrase").alias("_part"), F.col("f").alias("_f"))
    # a row that is served has a key of its own that meets nothing, so these spread over all partitions
    key = F.when(F.col("_hot").isNull(), F.col(part)).otherwise(F.concat(F.lit("\n"), "phrase"))
    found = rows.join(common, ["lang", part], "left").withColumn("_part", key).join(other, ["lang", "_part"], "left")
    return found.withColumn(name, F.coalesce("_hot", "_f")).drop("_hot", "_f", "_part")


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", mining: Mining | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language."""
    mining = mining or Mining()
    total_bytes = text_bytes(docs, f"`{text}`")[1]
    texts = _texts(docs, text, lang)
    words = cut_lineage(count_words(texts, mining.entries))
    sums = words.groupBy("lang").agg(F.sum("f").alias("n"))
    total = words.agg(F.sum("f").alias("n")).first()["n"] or 0
    hot_rows = words.filter(F.col("f") > max(total // HOT, HOT_LEAST)).collect()  # fewer than HOT rows
    hot = frozenset((r["lang"], r["phrase"]) for r in hot_rows)
    buckets = max(1, -(-total_bytes // PARTITION_BYTES))
    runs = count_runs(texts, mining, hot, sieve(words, mining.least), buckets)
    phrases = cut_lineage(merge_runs(runs, buckets, mining.least))

    size = F.size(F.split("phrase", " "))
    three = phrases.filter(size == 3)
    inner = F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)))
    longest = three.select("lang", inner.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    alone = phrases.join(longest, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < mining.share * F.col("f"))).drop("longer")

    words_in, k = F.split("phrase", " "), F.col("k")
    cuts = alone.select("lang", "phrase", F.col("f").alias("a"), words_in.alias("w"),
                        F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice("w", k + 1, F.size("w") - k), " ").alias("right"))
    spark = docs.sparkSession
    parts = words.filter(F.col("f") >= mining.least).unionByName(phrases.filter(size == 2))
    common = spark.createDataFrame([tuple(r) for r in hot_rows], "lang string, phrase string, f long")
    found = _looked_up(_looked_up(cuts, "left", parts, common, "l"), "right", parts, common, "r")
    scored = found.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    shards = max(64, shuffle_width(docs))
    near = Window.partitionBy("lang", "shard").orderBy(*best)
    some = (lowest.select("lang", "phrase", "cut.*").withColumn("shard", F.pmod(F.xxhash64("phrase"), F.lit(shards)))
            .withColumn("place", F.row_number().over(near)).filter(F.col("place") <= mining.top))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return (ranked.filter(F.col("rank") <= mining.top).join(sums, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
