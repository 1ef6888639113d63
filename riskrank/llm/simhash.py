"""SimHash near-duplicates, verified through pivot distance tables.

A document's fingerprint has bit b set if more than half of its shingles' XXH64 values have it set.  Each distinct
fingerprint gets its Hamming distances to a table of reference fingerprints (pivots).  By the triangle inequality two
fingerprints within k bits differ by at most k in every coordinate, so a pair is discarded by its largest coordinate
difference and only survivors are compared bit by bit.

Random 64-bit fingerprints lie 32 +- 4 bits from any pivot, so one coordinate discards about half of all pairs and
coordinates alone would leave a quadratic scan.  Pairs are therefore looked for inside blocks: with the bits cut into
m groups, k differing bits leave at least m - k groups equal, so some choice of m - k groups is a common key.  The
number of groups follows the number of fingerprints, so that blocks stay small; every choice finds all links.  A
block above `TILE` fingerprints is cut into tiles of pairs of its parts.  Tasks hand on a spanning forest of the
links they find, never the links themselves.

Nulls and texts without a word have fingerprint zero and are linked like any other.  Every row is a document, even if
several share an id.  The component is the smallest id that is not null; a group without any id has a null one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.llm.components import Forest, connected
from riskrank.llm.frames import keyed, located, rows_at, shuffle_width
from riskrank.llm.text import Block, blocks, mix
from riskrank.session import cut_lineage

#: Fingerprints of one block that are compared in one place, and that one call of a task gets on average.
TILE, BUCKET = 8192, 100_000

#: XXH64's primes.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

#: For each byte, its eight bits as eight byte counters.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc, lane):
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many stretches of `data` at once."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))
    halves = np.lib.stride_tricks.as_strided(padded[:4].view(np.uint32), (len(data) + 1,), (1,))
    with np.errstate(over="ignore"):
        return _xxh64(padded, lanes, halves, starts.astype(np.int64), (ends - starts).astype(np.int64), np.uint64(seed))


def _xxh64(padded, lanes, halves, starts, size, s) -> np.ndarray:
    h = np.full(len(starts), s + _P5, np.uint64)
    at, rest = starts.copy(), size.copy()
    long_ = np.flatnonzero(size >= 32)
    if len(long_):
        acc = [np.full(len(long_), x, np.uint64) for x in (s + _P1 + _P2, s + _P2, s, s - _P1)]
        left, live = size[long_] // 32, np.arange(len(long_))
        while len(live):
            p = at[long_[live]]
            for k in range(4):
                acc[k][live] = _round(acc[k][live], lanes[p + 8 * k])
            at[long_[live]] += 32
            left[live] -= 1
            live = live[left[live] > 0]
        v = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for k in range(4):
            v = (v ^ _round(np.uint64(0), acc[k])) * _P1 + _P4
        h[long_] = v
    h += size.astype(np.uint64)
    rest -= at - starts
    live = np.flatnonzero(rest >= 8)
    while len(live):
        h[live] = _rotl(h[live] ^ _round(np.uint64(0), lanes[at[live]]), 27) * _P1 + _P4
        at[live] += 8
        rest[live] -= 8
        live = live[rest[live] >= 8]
    live = np.flatnonzero(rest >= 4)
    h[live] = _rotl(h[live] ^ (halves[at[live]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[live] += 4
    rest[live] -= 4
    live = np.flatnonzero(rest > 0)
    while len(live):
        h[live] = _rotl(h[live] ^ (padded[at[live]].astype(np.uint64) * _P5), 11) * _P1
        at[live] += 1
        rest[live] -= 1
        live = live[rest[live] > 0]
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def block_fingerprints(block: Block, width: int) -> np.ndarray:
    """SimHash of each document of a block, as unsigned 64-bit numbers."""
    block.split()
    size = block.ends - block.starts
    n_words = len(size)
    inside = np.zeros(len(block.data) + 1, np.int8)
    inside[block.starts] += 1
    np.subtract.at(inside, block.ends, 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    joined = np.full(int(size.sum()) + n_words, 0x20, np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(n_words), size)] = block.data[inside]
    begin = np.cumsum(size + 1) - (size + 1)

    counts = np.diff(block.word_at)
    n_shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    first = np.repeat(block.word_at[:-1] - (np.cumsum(n_shingles) - n_shingles), n_shingles)
    first = first + np.arange(len(first))
    last = first + np.repeat(np.minimum(counts, width), n_shingles) - 1
    hashes = xxh64(joined, begin[first], begin[last] + size[last])

    full = np.flatnonzero(n_shingles)
    out = np.zeros(block.n_docs, np.uint64)
    if not len(full):
        return out
    n = n_shingles[full]
    runs = -(-n // 255)  # a byte counter holds 255
    doc_at = np.cumsum(n) - n
    run_at = np.cumsum(runs) - runs
    begins = np.repeat(doc_at, runs) + 255 * (np.arange(int(runs.sum())) - np.repeat(run_at, runs))
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for j in range(8):
        lanes = np.add.reduceat(_SPREAD[octets[:, j]], begins).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(lanes.astype(np.int64), run_at, axis=0)
        bits = (2 * ones > n[:, None]).astype(np.uint64)
        out[full] |= (bits << np.arange(8 * j, 8 * j + 8, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, width: int = 3, text: str = "text") -> DataFrame:
    """`docs` without its text column, and with `fp` (the fingerprint as a signed long)."""
    rest = [c for c in docs.columns if c != text]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(rest))
            for block in blocks(texts, lower=True):
                fps = pa.array(block_fingerprints(block, width).view(np.int64))
                rows = batch.slice(block.first, block.n_docs)
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(rest)], fps], names=[*rest, "fp"])

    docs = docs.select(*rest, F.col(text).cast("string").alias(text))
    return docs.mapInArrow(compute, docs.drop(text).withColumn("fp", F.lit(0).cast("long")).schema)


def pivots(n: int) -> np.ndarray:
    """Reference fingerprints: zero, and well spread others."""
    out = mix(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out[0] = 0
    return out


def distance_table(fps: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint to every reference."""
    return np.bitwise_count(fps[:, None] ^ references[None, :])


def block_masks(n: int, bits: int) -> list[int]:
    """Masks of the bits that form a key: two fingerprints within `bits` bits agree under one of them at least."""
    groups = bits + 1
    while groups < 2 * bits and 64 * (groups - bits) // groups < np.log2(max(n, 2)) - 6:
        groups += 1
    edges = [round(64 * g / groups) for g in range(groups + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, groups - bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link_forest(prints: DataFrame, bits: int, n_pivots: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect whatever `bits` bits connect."""
    n = prints.count()
    masks = block_masks(n, bits)
    keyed = prints.select("fp", F.explode(F.array(
        *[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])).alias("key"))
    parts = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TILE)
             .select("key", F.ceil(F.col("n") / TILE).cast("int").alias("parts")))
    tiled = (keyed.join(parts, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
             .withColumn("part", F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("tile", F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")))
             .select("fp", "tile", "part"))
    buckets = max(shuffle_width(prints), -(-n * len(masks) // BUCKET))
    references = pivots(n_pivots)

    def links(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        tile, part = table.column("tile").to_numpy(), table.column("part").to_numpy()
        distances = distance_table(fp, references)
        order = np.lexsort((distances[:, 0], tile))
        fp, tile, part, distances = fp[order], tile[order], part[order], distances[order]
        starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
        ends = np.r_[starts[1:], len(tile)]
        mixed = np.minimum.reduceat(part, starts) != np.maximum.reduceat(part, starts)
        two = np.repeat(mixed, ends - starts)  # tiles of two parts: only pairs across, each part has its own tile
        forest, near, live, step = Forest(len(fp)), distances.astype(np.int8), np.arange(len(fp)), 0
        while True:
            step += 1
            live = live[live + step < len(fp)]
            other = live + step
            open_ = (tile[live] == tile[other]) & (near[other, 0] - near[live, 0] <= bits)
            live = live[open_]
            if not len(live):
                break
            a, b = live, live + step
            across = ~two[a] | (part[a] != part[b])
            a, b = a[across], b[across]
            for k in range(1, near.shape[1]):
                ok = np.abs(near[a, k] - near[b, k]) <= bits
                a, b = a[ok], b[ok]
            ok = np.bitwise_count(fp[a] ^ fp[b]) <= bits
            forest.link(a[ok], b[ok])
        node = fp.view(np.int64)
        u, v = node, node[forest.root]
        return pa.table({"u": u[u != v], "v": v[u != v]})

    return (tiled.groupBy(F.pmod("tile", F.lit(buckets)).alias("bucket"))
            .applyInArrow(links, "u long, v long"))


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = 3, n_pivots: int = 12, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per input row: `id`, its place (`file`, `row`), `fp`, `component` (smallest id reachable), and `root`,
    a fingerprint that names the group."""
    docs = located(docs)
    rows = keyed(docs, id=F.col(doc_id).cast("long"), text=F.col(text))
    marked = cut_lineage(fingerprints(rows, width))
    prints = cut_lineage(marked.groupBy("fp").agg(F.min("id").alias("rep")))
    stars = connected(link_forest(prints, bits, n_pivots))
    rooted = prints.join(stars.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("v", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    return (marked.join(rooted.join(smallest, "root").select("fp", "root", "component"), "fp")
            .select("id", "file", "row", "fp", "root", "component"))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` with the smallest id of each group, with their columns."""
    docs = located(docs)
    found = near_duplicates(docs, **options)
    stay = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "file", "row")).alias("k"))
    return rows_at(docs, stay.select("k.file", "k.row"))
