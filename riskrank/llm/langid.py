"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are all strings of 3 and of 5 bytes of the lower-cased text, with white space as a blank.  Each is hashed to
a row of an embedding table; a document is the mean of its rows, and a linear softmax names its language.  Embeddings
and softmax are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows.  A part of
the sample is held back to fit the temperature of the probabilities, and the threshold below which an answer is
rejected as uncertain.

The trained model is one table of class scores per subword (embedding times softmax weights), so every byte of every
whole text is scored by lookups.  Null texts and texts without a letter are `und` with score 0; so is everything if
there are no labelled rows.  Rows are judged one by one, so repeated rows get equal answers; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskrank.llm.frames import free_name
from riskrank.llm.text import LOWER, SPACE, blocks

UNKNOWN = "und"

VERDICT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                        T.StructField("rejected", T.BooleanType())])
_FIELDS = [pa.field("lang", pa.string()), pa.field("score", pa.float64()), pa.field("rejected", pa.bool_())]

_PLAIN = np.where(SPACE, 0x20, LOWER).astype(np.uint8)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


@dataclass(frozen=True)
class Training:
    """Parameters; the sample holds about `docs_per_language` rows of a language, `segments` stretches of each."""

    docs_per_language: int = 600
    segments: int = 3
    segment_chars: int = 300
    log_buckets: int = 16
    dimensions: int = 16
    epochs: int = 3
    batch: int = 128
    rate: float = 0.5
    held_back: float = 0.2
    rejected_share: float = 0.002
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """Class scores of every subword (one row more, of zeros, for none), bias, temperature and threshold."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    log_buckets: int


def subwords(data: np.ndarray, offsets: np.ndarray, log_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the subwords of each text, and where each text's begin.  A text has a blank at either end."""
    n = len(offsets) - 1
    size = np.diff(offsets) + 2
    begin = np.cumsum(size) - size
    padded = np.full(int(size.sum()) + 4, 0x20, np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(n) * 2 + 1, size - 2)] = _PLAIN[data]
    b = [padded[k : len(padded) - 4 + k].astype(np.uint64) for k in range(5)]
    three = b[0] | b[1] << np.uint64(8) | b[2] << np.uint64(16)
    five = three | b[3] << np.uint64(24) | b[4] << np.uint64(32)
    shift, half = np.uint64(64 - log_buckets), np.int64(1 << log_buckets)
    out = np.full((len(three), 2), 2 * half, np.int64)
    for k, (code, length) in enumerate(((three, 3), (five, 5))):
        ok = np.ones(len(code), bool)
        for back in range(1, length):
            ends = begin + size - back
            ok[ends[ends >= begin]] = False
        rows = ((code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64) + k * half
        out[ok, k] = rows[ok]
    return out.ravel(), 2 * np.append(begin, int(size.sum()))


def _mean_rows(table: np.ndarray, rows: np.ndarray, at: np.ndarray, none: int) -> np.ndarray:
    """Mean of the table rows of each text (every text has subwords); one column at a time."""
    count = np.maximum(np.add.reduceat((rows != none).astype(np.int64), at[:-1]), 1)
    return np.stack([np.add.reduceat(column[rows], at[:-1]) for column in table.T], 1) / count[:, None]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def labelled_sample(docs: DataFrame, how: Training) -> tuple[list[str], list[str]]:
    """Bounded sample of (lang, stretch of text), the same in every run: a hash of the id and text picks the rows."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    scale = 1 << 30
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(scale, how.docs_per_language * scale // n))).otherwise(share)
    picked = (labelled.withColumn("h", F.xxhash64("doc_id", "text", F.lit(how.seed)))
              .filter(F.pmod("h", F.lit(scale)) < share))
    stretch = (F.length("text") / how.segments).cast("int")
    parts = picked.select("lang", "h", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.substring(F.col("text"), F.lit(1) + stretch * i, F.lit(how.segment_chars))
                 .alias("part")) for i in range(how.segments)])).alias("s")).select("lang", "h", "s.i", "s.part")
    found = parts.filter(F.col("part").rlike(r"\p{L}")).distinct().collect()
    found.sort(key=lambda r: (r["h"], r["i"], r["lang"]))
    return [r["lang"] for r in found], [r["part"] for r in found]


def train(langs: list[str], texts: list[str], how: Training = Training()) -> Model:
    """Embeddings and softmax by mini-batch gradient descent, then temperature and rejection threshold."""
    names = sorted(set(langs))
    none = 2 << how.log_buckets
    random = np.random.default_rng(how.seed)
    embedding = random.normal(0, 1 / how.dimensions, (none + 1, how.dimensions))
    embedding[none] = 0
    weights, bias = np.zeros((how.dimensions, len(names))), np.zeros(len(names))
    if not names:
        return Model([], np.zeros((none + 1, 0)), bias, 1.0, 0.0, how.log_buckets)
    label = np.array([names.index(x) for x in langs])
    raw = [t.encode() for t in texts]
    order = random.permutation(len(raw))
    n_held = int(how.held_back * len(raw))
    held, own = order[:n_held], order[n_held:]

    def rows_of(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = [raw[i] for i in which.tolist()]
        return subwords(np.frombuffer(b"".join(part), np.uint8), np.append(0, np.cumsum([len(p) for p in part])),
                        how.log_buckets)

    steps = how.epochs * -(-len(own) // how.batch)
    for step in range(steps):
        if step % -(-len(own) // how.batch) == 0:
            own, at_doc = random.permutation(own), 0
        batch = own[at_doc : at_doc + how.batch]
        at_doc += how.batch
        rows, at = rows_of(batch)
        count = np.maximum(np.add.reduceat((rows != none).astype(np.int64), at[:-1]), 1)
        mean = np.add.reduceat(embedding[rows], at[:-1], axis=0) / count[:, None]
        error = _softmax(mean @ weights + bias)
        error[np.arange(len(batch)), label[batch]] -= 1
        rate = how.rate * (1 - step / steps)
        back = error @ weights.T / count[:, None]
        weights -= rate * mean.T @ error
        bias -= rate / len(batch) * error.sum(0)
        pull = np.repeat(back, np.diff(at), axis=0)
        for d in range(how.dimensions):
            embedding[:, d] -= rate * np.bincount(rows, pull[:, d], none + 1)
        embedding[none] = 0
    table = embedding @ weights
    model = Model(names, table, bias, 1.0, 0.0, how.log_buckets)
    if not n_held:
        return model
    rows, at = rows_of(held)
    logits = _mean_rows(table, rows, at, none) + bias
    target = label[held]

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), target], 1e-300)).mean()

    temperature = min(np.geomspace(0.05, 20, 60).tolist(), key=loss)
    chance = _softmax(logits / temperature)
    right = chance.max(1)[chance.argmax(1) == target]
    threshold = float(np.quantile(right, how.rejected_share)) if len(right) else 0.0
    return Model(names, table, bias, temperature, threshold, how.log_buckets)


def identify(docs: DataFrame, model: Model, into: str = "language", text: str = "text") -> DataFrame:
    """All rows and columns of `docs` with a struct of lang, score and rejected as one more, last column.

    The struct is called `into`, or so with underscores in front if that name is taken.  The model has a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        columns = np.ascontiguousarray(m.table.T)
        for batch in batches:
            for block in blocks(batch.column(at).cast(pa.string()), limit=1 << 20):
                best = np.full(block.n_docs, UNKNOWN, object)
                score, rejected = np.zeros(block.n_docs), np.ones(block.n_docs, bool)
                known = _with_letter(block.data, block.offsets) if m.languages else np.zeros(block.n_docs, bool)
                if known.any():
                    rows, starts = subwords(block.data, block.offsets, m.log_buckets)
                    chance = _softmax((_mean_rows(columns.T, rows, starts, m.table.shape[0] - 1) + m.bias)
                                      / m.temperature)
                    top = chance.argmax(1)
                    best[known] = np.array(m.languages, object)[top[known]]
                    score[known] = chance.max(1)[known]
                    rejected[known] = score[known] < m.threshold
                struct = pa.StructArray.from_arrays(
                    [pa.array(best, pa.string()), pa.array(score), pa.array(rejected)], fields=_FIELDS)
                own = batch.slice(block.first, block.n_docs)
                yield pa.RecordBatch.from_arrays([*own.columns, struct], names=[*batch.schema.names, name])

    name = free_name(docs, into)
    return docs.mapInArrow(judge, T.StructType([*docs.schema.fields, T.StructField(name, VERDICT)]))


def _with_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts that have a letter of any script."""
    ascii_ = np.append(0, np.cumsum(_LETTER[data]))[offsets]
    out = np.diff(ascii_) > 0
    for d in np.flatnonzero(~out & (np.diff(offsets) > 0)).tolist():
        part = data[offsets[d] : offsets[d + 1]]
        out[d] = bool((part >= 0x80).any()) and any(c.isalpha() for c in part.tobytes().decode())
    return out
