"""Mix sources to target weights: fixed-length blocks, multinomial shard counts, index permutations.

The words of a source form one stream, document after document in the order of their ids, cut into blocks of
`block_words` words (the last one may be shorter).  Sources weigh 1, 2, 3, repeating, by code point with null last;
a target stops at `cap` times its source's size and the excess is shared again by weight.  A source's slots run
through its blocks pass by pass, each pass in the order of its own pseudorandom permutation of the block indices,
until the target is reached; the last slot is cut there, so what is taken is the target to the word.  Every output
shard draws its source counts from a multinomial over what the sources still have to give.  Slots and blocks meet in
a join on (source, block index).

A pass takes a block once and there are at most `cap` passes, so no document exceeds `cap` times its size.  Nulls and
texts without a word have size zero and are never taken; rows that share an id are documents of their own.  Extra
columns do not matter.  The same table gives the same mix in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskrank.llm.frames import WORD, keyed, located, shuffle_width
from riskrank.llm.text import blocks, mix
from riskrank.session import cut_lineage


@dataclass(frozen=True)
class Recipe:
    """Parameters of a mix."""

    block_words: int = 1024
    cap: int = 3
    weights: tuple[int, ...] = (1, 2, 3)
    shard_slots: int = 1 << 16
    seed: int = 20240229


@dataclass(frozen=True)
class Permutation:
    """A pseudorandom order of 0..n-1: a four-round Feistel network, walked until it lands inside."""

    n: int
    key: int

    @property
    def _half(self) -> np.uint64:
        return np.uint64(max(1, (max(self.n - 1, 1).bit_length() + 1) // 2))

    def _keys(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(np.uint64(self.key) + np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        half = self._half
        mask = (np.uint64(1) << half) - np.uint64(1)
        left, right = x >> half, x & mask
        for key in self._keys()[::-1] if back else self._keys():
            if back:
                left, right = right ^ (mix(left ^ key) & mask), left
            else:
                left, right = right, left ^ (mix(right ^ key) & mask)
        return (left << half) | right

    def __call__(self, x, back: bool = False) -> np.ndarray:
        out = self._once(np.asarray(x, np.uint64), back)
        while len(far := np.flatnonzero(out >= self.n)):
            out[far] = self._once(out[far], back)
        return out.astype(np.int64)


@dataclass(frozen=True)
class Source:
    """What is taken from one source: `slots` slots, the last of them cut to `last` words."""

    number: int
    name: str | None
    size: int
    target: float
    n_blocks: int
    slots: int
    last: int


def share_targets(sizes: list[int], recipe: Recipe = Recipe()) -> list[float]:
    """Targets in words of sources in their order; together they are all words."""
    weights = [recipe.weights[i % len(recipe.weights)] for i in range(len(sizes))]
    targets, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * left / total > recipe.cap * sizes[i]}
        for i in full or open_:
            targets[i] = float(recipe.cap * sizes[i]) if full else weights[i] * left / total
        if not full:
            break
        left -= sum(targets[i] for i in full)
        open_ -= full
    return targets


def _key(recipe: Recipe, number: int, turn: int) -> int:
    return (recipe.seed * 1_000_003 + number * 1_009 + turn) & ((1 << 63) - 1)


def plan_source(number: int, name: str | None, size: int, target: float, recipe: Recipe) -> Source:
    """Number of slots whose words make up the target, and the words of the last one."""
    words, length = min(int(target + 1e-6), recipe.cap * size), recipe.block_words
    n = -(-size // length)
    if not words:
        return Source(number, name, size, target, n, 0, 0)
    turns, rest = divmod(words, size)
    tail = size - (n - 1) * length
    if not rest:
        last_block = int(Permutation(n, _key(recipe, number, turns - 1))(np.array([n - 1]))[0])
        return Source(number, name, size, target, n, turns * n, tail if last_block == n - 1 else length)
    slots = -(-rest // length)
    at = int(Permutation(n, _key(recipe, number, turns))(np.array([n - 1]), back=True)[0])
    if at < slots and rest > slots * length - (length - tail):  # the short block is among them: one more is needed
        slots += 1
    given = (slots - 1) * length - (length - tail if at < slots - 1 else 0)
    return Source(number, name, size, target, n, turns * n + slots, rest - given)


def _shards(sources: list[Source], recipe: Recipe) -> list[tuple[int, int, int, int]]:
    """(shard, source, first slot, slots): multinomial counts over what each source still has to give."""
    left = np.array([s.slots for s in sources], np.int64)
    next_, out, shard = np.zeros(len(sources), np.int64), [], 0
    random = np.random.default_rng(recipe.seed)
    while total := int(left.sum()):
        room, counts = min(recipe.shard_slots, total), np.zeros(len(sources), np.int64)
        while room:
            open_ = left - counts
            drawn = np.minimum(random.multinomial(room, open_ / open_.sum()), open_)
            counts += drawn
            room -= int(drawn.sum())
        out += [(shard, k, int(next_[k]), int(counts[k])) for k in np.flatnonzero(counts).tolist()]
        next_, left, shard = next_ + counts, left - counts, shard + 1
    return out


def _offsets(rows: DataFrame) -> DataFrame:
    """Add `start`: words of the same source before the row, in the order of (id, file, row).

    Rows are dealt out in ranges, so a large source spans many of them; each range adds what lies before it.
    """
    order = ["id", "file", "row"]
    ranged = cut_lineage(rows.repartitionByRange(shuffle_width(rows), "number", *order)
                         .withColumn("range", F.spark_partition_id()))
    sums = ranged.groupBy("number", "range").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("number", "range", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("number", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(sums, ["number", "range"])
            .select("id", "file", "row", "number", "size", (F.col("before") + F.col("within")).alias("start")))


@dataclass(frozen=True)
class Mix:
    """`rows`: (id, file, row, number, size) of every document; `sources`: one `Source` each; `pieces`: (shard, slot,
    number, turn, block, id, file, row, first, words), what each slot takes from which document."""

    rows: DataFrame
    sources: list[Source]
    pieces: DataFrame

    def source_table(self) -> DataFrame:
        return self.rows.sparkSession.createDataFrame(
            [(s.number, s.name, s.size, s.target) for s in self.sources],
            "number int, source string, source_size long, target double")


def mix_sources(docs: DataFrame, recipe: Recipe = Recipe(), doc_id: str = "doc_id", text: str = "text",
                source: str = "source") -> Mix:
    """Decide, to the word, what the mix takes from which document."""
    spark, docs = docs.sparkSession, located(docs)
    rows = cut_lineage(keyed(
        docs, id=F.col(doc_id), source=F.col(source).cast("string"),
        size=F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")))
    sums = rows.groupBy("source").agg(F.sum("size").alias("size")).collect()
    totals = sorted(((r["source"], r["size"]) for r in sums), key=lambda x: (x[0] is None, x[0] or ""))
    sources = [plan_source(i, name, size, target, recipe) for i, ((name, size), target) in
               enumerate(zip(totals, share_targets([s for _, s in totals], recipe), strict=True))]
    names = spark.createDataFrame([(s.number, s.name) for s in sources], "number int, name string")
    rows = (rows.join(names, rows["source"].eqNullSafe(names["name"]))
            .select("id", "file", "row", "number", "size"))

    length = recipe.block_words
    placed = _offsets(rows).filter("size > 0")
    stretches = (placed.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("size") - 1) / length))))
        .withColumn("first", F.greatest(F.lit(0).cast("long"), F.col("block") * length - F.col("start")))
        .withColumn("in_block", F.col("start") + F.col("first") - F.col("block") * length)
        .withColumn("words", F.least(F.col("size") - F.col("first"), length - F.col("in_block"))))

    n_blocks = np.array([s.n_blocks for s in sources], np.int64)
    last_slot = np.array([s.slots - 1 for s in sources], np.int64)
    last_words = np.array([s.last for s in sources], np.int64)

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, slot = batch.column("number").to_numpy(), batch.column("slot").to_numpy()
            turn = slot // n_blocks[k]
            block = np.empty(len(k), np.int64)
            kinds, which = np.unique(np.stack([k.astype(np.int64), turn]), axis=1, return_inverse=True)
            for i, (number, t) in enumerate(kinds.T.tolist()):
                at = np.flatnonzero(which.ravel() == i)
                block[at] = Permutation(int(n_blocks[number]), _key(recipe, number, t))(
                    slot[at] % n_blocks[number])
            most = np.where(slot == last_slot[k], last_words[k], length)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, (turn, block, most))],
                                             names=["shard", "number", "slot", "turn", "block", "most"])

    counts = spark.createDataFrame(_shards(sources, recipe), "shard long, number int, begin long, n long")
    slots = (counts.repartition(shuffle_width(rows), "shard", "number")
             .select("shard", "number", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("n") - 1))
                     .alias("slot"))
             .mapInArrow(permute, "shard long, number int, slot long, turn long, block long, most long"))
    # without the hint slots would be broadcast: the planner sees the few rows they are unfolded from
    pieces = (stretches.join(slots.hint("merge"), ["number", "block"])
              .withColumn("words", F.least("words", F.col("most") - F.col("in_block"))).filter("words > 0")
              .select("shard", "slot", "number", "turn", "block", "id", "file", "row", "first", "words"))
    return Mix(rows, sources, pieces)


def taken_words(mixture: Mix) -> DataFrame:
    """One row per document: `id`, `size`, `source_size`, `target` and `taken` (words, repeats counted)."""
    taken = mixture.pieces.groupBy("file", "row").agg(F.sum("words").alias("taken"))
    return (mixture.rows.join(mixture.source_table(), "number").join(taken, ["file", "row"], "left")
            .select("id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, recipe: Recipe = Recipe(), text: str = "text", n_chars: str = "n_chars",
                    **columns) -> DataFrame:
    """The mix as rows with the columns of `docs`: a document once per pass that takes words from it.

    The text is cut to the words taken, in their order; runs of blocks that follow each other stay as they were,
    others are joined by a line break.  `n_chars` is set anew where there is such a column.
    """
    docs = located(docs)
    mixture = mix_sources(docs, recipe, text=text, **columns)
    spans = (mixture.pieces.groupBy("file", "row", "turn")
             .agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("spans")))
    names = list(docs.columns)
    placed = keyed(docs, **{f"c{i}": docs[f"`{c}`"] for i, c in enumerate(names)})
    whole = placed.join(spans, ["file", "row"]).select(*[f"c{i}" for i in range(len(names))], "spans")
    at = names.index(text)
    chars = names.index(n_chars) if n_chars in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = batch.column(len(names)).to_pylist(), []
            for block in blocks(batch.column(at)):
                block.split()
                for d in range(block.n_docs):
                    texts.append(_cut(block, d, spans[block.first + d]))
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, columns[at].type)
            if chars is not None:
                columns[chars] = pa.array([len(t) for t in texts], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[: len(names)])

    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    return whole.mapInArrow(cut, schema).toDF(*names)


def _cut(block, d: int, spans: list[dict]) -> str:
    base, stop = int(block.word_at[d]), int(block.word_at[d + 1])
    runs: list[list[int]] = []
    for span in spans:
        if runs and runs[-1][1] == span["first"]:
            runs[-1][1] += span["words"]
        else:
            runs.append([span["first"], span["first"] + span["words"]])
    if runs == [[0, stop - base]]:
        return block.data[block.offsets[d] : block.offsets[d + 1]].tobytes().decode()
    return "\n".join(block.data[block.starts[base + a] : block.ends[base + b - 1]].tobytes().decode() for a, b in runs)
