"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids and an end id; longer ones than a sequence are cut.  The pieces are dealt out by hash to
demes of a few thousand.  Each deme has several islands, which hold different populations of complete packings of
the deme.  A generation crosses two packings: whole well-filled bins of one are injected into the other, the bins
that hold copies of injected pieces are dissolved, and their other pieces are put back best-fit; a mutation dissolves
the emptiest bins.  Between epochs each island sends its elite to the next one.  A deme's best packing keeps its
well-filled bins; the pieces of the others go up to the next level, where fewer demes pack them again, until one
deme is left.

A null or empty text is a document of the end id alone.  Repeated rows are documents of their own, equal lengths are
broken by place, an empty table gives an empty result, extra columns do not matter.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.llm.frames import keyed, located
from riskrank.llm.text import blocks
from riskrank.llm.tokens import block_ids
from riskrank.session import cut_lineage


@dataclass(frozen=True)
class Evolution:
    """Parameters of the algorithm."""

    capacity: int = 4096
    deme: int = 4000
    islands: int = 3
    population: int = 5
    generations: int = 6
    epochs: int = 2
    filled: float = 0.997
    seed: int = 7


def token_pieces(docs: DataFrame, tokenizer: str, end: int = 1, capacity: int = 4096, keep_ids: bool = False,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, file, row, piece, start, length, crc) of every piece; with `keep_ids` also its `ids`."""
    rows = keyed(located(docs), id=F.col(doc_id), text=F.col(text).cast("string"))
    names = ["id", "file", "row", "piece", "start", "length", "crc", "ids"][: 7 + keep_ids]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                ids, bounds = block_ids(block, tokenizer, end)
                n = -(-np.diff(bounds) // capacity)
                doc = np.repeat(np.arange(block.n_docs), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                begin = bounds[doc] + piece * capacity
                stop = np.minimum(begin + capacity, bounds[doc + 1])
                raw = ids.astype("<u4")
                crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), stop.tolist(), strict=True)),
                                  np.int64, len(doc))
                key = batch.slice(block.first, block.n_docs).take(pa.array(doc))
                columns = [*map(key.column, names[:3]), *map(pa.array, (piece, piece * capacity, stop - begin, crc))]
                if keep_ids:
                    bounds32 = np.append(0, np.cumsum(stop - begin)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(bounds32, pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = f"id {rows.schema['id'].dataType.simpleString()}, file string, row long, piece long, start long, " \
           "length long, crc long" + ", ids array<long>" * keep_ids
    return rows.mapInArrow(pieces, kind)


class Packing:
    """A complete packing of some pieces: the bin of each, and what each bin holds."""

    def __init__(self, sizes: np.ndarray, capacity: int, bins: np.ndarray):
        self.sizes, self.capacity = sizes, capacity
        _, self.bins = np.unique(bins, return_inverse=True)
        self.fill = np.bincount(self.bins, sizes).astype(np.int64)

    @property
    def fitness(self) -> tuple[float, float]:
        """Fewer bins first, then Falkenauer's mean square filling."""
        return -len(self.fill), float(np.square(self.fill / self.capacity).mean()) if len(self.fill) else 0.0


def best_fit(sizes: np.ndarray, capacity: int, bins: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Put the pieces of `order`, one after another, into the fullest bin with room; -1 marks those not in a bin."""
    held = bins >= 0
    n = int(bins.max()) + 1 if held.any() else 0
    room = capacity - np.bincount(bins[held], sizes[held], minlength=n).astype(np.int64)
    free = sorted(zip(room.tolist(), range(n), strict=True))
    bins = bins.copy()
    for item, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        at = bisect_left(free, (size, -1))
        if at < len(free):
            left, b = free.pop(at)
        else:
            left, b, n = capacity, n, n + 1
        bins[item] = b
        if left > size:
            insort(free, (left - size, b))
    return bins


def _displaced(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    out = np.flatnonzero(bins < 0)
    return out[np.argsort(-sizes[out], kind="stable")]


def crossover(a: Packing, b: Packing, filled: float, random: np.random.Generator) -> Packing:
    """Inject whole well-filled bins of `a` into `b`, drop b's copies, and best-fit what they displace."""
    good = np.flatnonzero(a.fill >= filled * a.capacity)
    good = good if len(good) else np.array([int(np.argmax(a.fill))])
    chosen = np.zeros(len(a.fill), bool)
    chosen[random.choice(good, max(1, len(good) // 2), replace=False)] = True
    injected = chosen[a.bins]
    touched = np.zeros(len(b.fill), bool)
    touched[b.bins[injected]] = True
    bins = np.where(touched[b.bins], -1, b.bins)
    bins[injected] = len(b.fill) + a.bins[injected]
    return Packing(a.sizes, a.capacity, best_fit(a.sizes, a.capacity, bins, _displaced(a.sizes, bins)))


def mutate(p: Packing, random: np.random.Generator) -> Packing:
    """Dissolve the emptiest bins and a few others, and best-fit their pieces in a shaken order."""
    n = len(p.fill)
    gone = np.argsort(p.fill)[: max(2, n // 50)]
    gone = np.union1d(gone, random.integers(0, n, max(2, n // 50)))
    bins = np.where(np.isin(p.bins, gone), -1, p.bins)
    order = _displaced(p.sizes, bins)
    order = order[np.argsort(np.arange(len(order)) + random.normal(0, 2, len(order)))]
    return Packing(p.sizes, p.capacity, best_fit(p.sizes, p.capacity, bins, order))


def evolve(sizes: np.ndarray, population: list[np.ndarray], how: Evolution, seed: list[int]) -> list[np.ndarray]:
    """One epoch of one island: its packings (bins per piece), the elite first."""
    random, least = np.random.default_rng(seed), -(-int(sizes.sum()) // how.capacity)
    none = np.full(len(sizes), -1)
    own = [Packing(sizes, how.capacity, p) for p in population]
    while len(own) < how.population:
        shake = random.normal(0, 0.1 * bool(own or seed[-1]), len(sizes))
        order = np.argsort(-sizes * np.exp(shake), kind="stable")
        own.append(Packing(sizes, how.capacity, best_fit(sizes, how.capacity, none, order)))
        if len(own[-1].fill) <= least:
            break
    own.sort(key=lambda p: p.fitness, reverse=True)
    for _ in range(how.generations):
        if len(own[0].fill) <= least:
            break
        a, b = random.permutation(len(own))[:2] if len(own) > 1 else (0, 0)
        child = mutate(crossover(own[a], own[b], how.filled, random), random)
        own = sorted([*own, child], key=lambda p: p.fitness, reverse=True)[: how.population]
    return [p.bins for p in own]


_STATE = "deme long, island int, sizes binary, packings array<binary>"


def _start(items: DataFrame, islands: int) -> DataFrame:
    """One row per deme and island, without a population: the sizes of the deme's pieces in their order."""
    def gather(key, table):
        sizes = _ordered(table).column("length").to_numpy().astype(np.int32).tobytes()
        return pa.table({"deme": [key[0].as_py()] * islands, "island": pa.array(range(islands), pa.int32()),
                         "sizes": [sizes] * islands, "packings": pa.array([[]] * islands, pa.list_(pa.binary()))})

    return items.select("deme", "file", "row", "piece", "length").groupBy("deme").applyInArrow(gather, _STATE)


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("file", "ascending"), ("row", "ascending"), ("piece", "ascending")])


def _epoch(state: DataFrame, how: Evolution, number: int, level: int) -> DataFrame:
    """All islands evolve; then each also holds its neighbour's elite, in one more row to be merged."""
    def run(key, table):
        deme, island = (k.as_py() for k in key)
        sizes = np.frombuffer(table.column("sizes")[0].as_py(), np.int32).astype(np.int64)
        held = [np.frombuffer(p, np.int32) for ps in table.column("packings").to_pylist() for p in ps]
        out = evolve(sizes, held, how, [how.seed, level, number, deme, island])
        packings = [p.astype(np.int32).tobytes() for p in out]
        least = -(-int(sizes.sum()) // how.capacity)
        done = out[0].max(initial=-1) + 1 <= least  # cannot get better: the others need not be kept
        return pa.table({
            "deme": [deme] * 2, "island": pa.array([island, (island + 1) % how.islands], pa.int32()),
            "sizes": [table.column("sizes")[0].as_py()] * 2,
            "packings": pa.array([packings[: 1 if done else None], packings[:1]], pa.list_(pa.binary()))})

    return state.groupBy("deme", "island").applyInArrow(run, _STATE)


def _place(items: DataFrame, state: DataFrame, how: Evolution, level: int, final: bool) -> DataFrame:
    """The deme's best packing: a sequence and offset for each piece, null where the piece goes up a level."""
    def settle(key, pieces, states):
        pieces = _ordered(pieces)
        sizes = pieces.column("length").to_numpy().astype(np.int64)
        packings = [Packing(sizes, how.capacity, np.frombuffer(p, np.int32))
                    for ps in states.column("packings").to_pylist() for p in ps]
        best = max(packings, key=lambda p: p.fitness)
        order = np.argsort(best.bins, kind="stable")
        ahead = np.cumsum(sizes[order]) - sizes[order]
        first = np.r_[True, best.bins[order][1:] != best.bins[order][:-1]]
        offset = np.empty(len(sizes), np.int64)
        offset[order] = ahead - np.repeat(ahead[first], np.diff(np.append(np.flatnonzero(first), len(order))))
        up = np.zeros(len(sizes), bool) if final else (best.fill < how.filled * how.capacity)[best.bins]
        sequence = (level << 56) + (key[0].as_py() << 20) + best.bins
        return (pieces.drop_columns(["deme"]).append_column("sequence", pa.array(sequence, mask=up))
                .append_column("offset", pa.array(offset, mask=up)))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.drop("deme").schema.fields)
    return (items.groupBy("deme").cogroup(state.groupBy("deme"))
            .applyInArrow(settle, schema + ", sequence long, offset long"))


def pack(pieces: DataFrame, how: Evolution = Evolution()) -> DataFrame:
    """`pieces` (file, row, piece, length and any other columns) with `sequence` and `offset`."""
    items, out, level = pieces, None, 0
    left = items.count()
    while True:
        demes = max(1, -(-left // how.deme))
        dealt = items.withColumn("deme", F.pmod(F.xxhash64("file", "row", "piece", F.lit(level)), F.lit(demes)))
        state = _start(dealt, how.islands)
        for number in range(how.epochs):
            state = _epoch(state, how, number, level)
        placed = cut_lineage(_place(dealt, state, how, level, demes == 1))
        done = placed.filter("sequence is not null")
        out = done if out is None else out.unionByName(done)
        if demes == 1:
            return out
        items = placed.filter("sequence is null").drop("sequence", "offset")
        before, left, level = left, items.count(), level + 1
        if not left:
            return out
        if left == before:  # no bin was closed: the demes stand as they are
            return out.unionByName(cut_lineage(_place(dealt, state, how, level, True)))


def pack_documents(docs: DataFrame, tokenizer: str, end: int, how: Evolution = Evolution()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): the pieces of all documents, packed."""
    pieces = cut_lineage(token_pieces(docs, tokenizer, end=end, capacity=how.capacity))
    return pack(pieces, how).select(
        F.col("id").alias("doc_id"), F.col("piece").cast("int").alias("piece"), "start", "length",
        F.col("crc").alias("ids_crc32"), F.col("sequence").alias("sequence_id"), "offset")


def packed_sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """(sequence, ids): the token ids of every sequence, from pieces with their ids and a packing of them."""
    keys = ["file", "row", "piece"]
    both = pieces.select(*keys, "ids").join(packed.select(*keys, "sequence", "offset"), keys)
    return both.groupBy("sequence").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence", F.flatten(F.col("parts.ids")).alias("ids"))
