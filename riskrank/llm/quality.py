"""Quality rules: divergence of a document's character classes and common words from language references.

A document is described by two histograms: its code points by character class, and its words by common function
word (one more cell for all other words).  A language's reference is the mean histogram over the distinct texts of
that language, computed by Spark over the whole table.  A document passes if some language has both Jensen-Shannon
distances within their limits.  Each histogram has its own minimum length, characters or words, below which it means
nothing and its distance is null; a document below both is judged by the base counts only.

Nulls and empty texts have no words, so the base rule fails them.  A null language gives no reference; without any
reference the divergence rule passes everything.  Repeated rows are judged alike, extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskrank.llm.frames import free_name
from riskrank.llm.text import Block, blocks, window_hashes, windows_inside
from riskrank.session import cut_lineage

#: Function words of the reference languages.
COMMON_WORDS: dict[str, Sequence[str]] = {
    "en": "the of and to in is was for by that be it as with an on this are or from at a".split(),
    "de": "der die und das in zu von mit ist ein für auf den im des nicht sich auch es an als".split(),
    "fr": "de la le et les des en du un une que qui dans pour par sur au est pas il ce".split(),
    "es": "de la que el en y los del se las por un para con no una su al lo como es".split(),
}

#: Bytes of the classes; what is listed nowhere is a symbol, a lead byte of UTF-8 belongs to the class of its range.
_RANGES = [
    (0x61, 0x7A), (0x41, 0x5A), (0x30, 0x39), (0x20, 0x20), (0x0A, 0x0A), (0x2C, 0x2C), (0x2E, 0x2E), (0x21, 0x21),
    (0x3F, 0x3F), (0x27, 0x27), (0x2D, 0x2D), (0x7C, 0x7C), (0xC2, 0xC3), (0xC4, 0xCC), (0xCD, 0xD4), (0xD5, 0xDF),
    (0xE0, 0xE2), (0xE3, 0xED), (0xEE, 0xF7),
]
N_CLASSES = len(_RANGES) + 2
_CLASS = np.full(256, len(_RANGES), np.uint8)
for _i, (_a, _b) in enumerate(_RANGES):
    _CLASS[_a : _b + 1] = _i
_CLASS[0x80:0xC0] = N_CLASSES - 1  # continuation bytes are no characters
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

#: Histograms enter the references in whole millionths, so that their sums do not depend on the order of rows.
_UNIT = 1_000_000

VERDICT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()), T.StructField("nearest", T.StringType()),
    T.StructField("char_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType()),
])
_VERDICT_ARROW = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                            ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                            ("kept", pa.bool_()), ("nearest", pa.string()), ("char_distance", pa.float64()),
                            ("word_distance", pa.float64())])


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules; a distance is the root of the Jensen-Shannon divergence in bits (0 to 1)."""

    char_distance: float = 0.2
    word_distance: float = 0.45
    trim_char: float = 0.2
    trim_word: float = 0.45
    min_chars: int = 400
    min_words: int = 60
    base_words: int = 20
    repeat_percent: int = 30
    window: int = 8


def vocabulary(common: Mapping[str, Sequence[str]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes of the ways a common word is written, and the histogram cell of each."""
    words = sorted({w for ws in common.values() for w in ws})
    forms = {f + end: i for i, w in enumerate(words) for f in (w, w[:1].upper() + w[1:]) for end in ("", ",", ".")}
    block = next(iter(blocks(pa.array(list(forms))))).split()
    hashes = block.word_hashes()
    order = np.argsort(hashes)
    return hashes[order], np.array(list(forms.values()))[order], len(words) + 1


def _histograms(block: Block, hashes: np.ndarray, vocab) -> tuple[np.ndarray, np.ndarray]:
    """Counts per document: code points by class, words by common word."""
    keys, cells, width = vocab
    classes = _CLASS[block.data]
    chars = np.zeros((block.n_docs, N_CLASSES), np.int64)
    for d, (a, b) in enumerate(zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True)):
        chars[d] = np.bincount(classes[a:b], minlength=N_CLASSES)
    words = np.zeros((block.n_docs, width), np.int64)
    words[:, -1] = np.diff(block.word_at)
    if len(keys) and len(hashes):
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == hashes)
        counts = np.bincount(block.word_docs()[hit] * (width - 1) + cells[at[hit]],
                             minlength=block.n_docs * (width - 1)).reshape(block.n_docs, width - 1)
        words[:, :-1] = counts
        words[:, -1] -= counts.sum(1)
    return chars[:, :-1], words


def _repeats(docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which entries occur more than once in their document."""
    order = np.lexsort((hashes, docs)) if len(hashes) else np.zeros(0, np.int64)
    d, h = docs[order], hashes[order]
    same = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    out = np.zeros(len(hashes), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _base(block: Block, hashes: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    n_words = np.diff(block.word_at)
    lead = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=lead[1:])
    length = np.zeros(len(hashes) + 1, np.int64)
    np.cumsum(lead[block.ends] - lead[block.starts], out=length[1:])
    symbols = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(_SYMBOL[block.data], out=symbols[1:])

    breaks = np.flatnonzero(block.data == 10)
    begin = np.sort(np.concatenate([block.offsets[:-1], breaks + 1]))
    end = np.sort(np.concatenate([block.offsets[1:], breaks]))
    full = np.searchsorted(block.starts, end) > np.searchsorted(block.starts, begin)
    begin, end = begin[full], end[full]
    line_doc = np.searchsorted(block.offsets, begin, "right") - 1
    line_hash = block.hashes(begin, end)
    lines = np.bincount(line_doc, minlength=block.n_docs)
    distinct = np.unique(np.stack([line_doc.astype(np.uint64), line_hash]), axis=1)[0].astype(np.int64)
    duplicate = lines - np.bincount(distinct, minlength=block.n_docs)

    windows = windows_inside(block.word_at, limits.window)
    docs = block.word_docs()
    repeated = windows[_repeats(docs[windows], window_hashes(hashes, limits.window)[windows])]
    cover = np.zeros(len(hashes) + limits.window + 1, np.int64)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + limits.window, -1)
    covered = np.zeros(len(hashes) + 1, np.int64)
    np.cumsum(np.cumsum(cover)[: len(hashes)] > 0, out=covered[1:])
    n_repeat = np.diff(covered[block.word_at])
    return {
        "n_words": n_words, "word_chars": np.diff(length[block.word_at]),
        "n_symbols": np.diff(symbols[block.offsets]), "n_dup_lines": duplicate, "n_repeat_words": n_repeat,
        "base_failed": (n_words < limits.base_words) | (100 * n_repeat > limits.repeat_percent * n_words),
    }


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance in bits of every row of `p` from every row of `q`."""
    p, q = p[:, None, :], q[None, :, :]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(2)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(2)
    return np.sqrt(np.maximum((left + right) / 2, 0))


def language_references(docs: DataFrame, limits: Limits = Limits(), common=COMMON_WORDS) -> dict:
    """Mean histograms of each language over its distinct long enough texts: one row per language.

    Copies count once, so that a widely copied page cannot pull its language's reference towards itself.  The mean
    is then taken again over the texts that lie near the first one, so that a minority of junk does not blur it.
    """
    vocab = vocabulary(common)
    width = N_CLASSES - 1 + vocab[2]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                hashes = block.split().word_hashes()
                chars, words = _histograms(block, hashes, vocab)
                ok = (chars.sum(1) >= limits.min_chars) & (words.sum(1) >= limits.min_words)
                cells = np.round(np.hstack([_shares(chars), _shares(words)])[ok] * _UNIT).astype(np.int64)
                texts = block.hashes(block.offsets[:-1], block.offsets[1:])[ok].view(np.int64)
                lang = batch.column("lang").slice(block.first, block.n_docs).filter(pa.array(ok))
                yield pa.RecordBatch.from_arrays(
                    [lang, pa.array(texts), pa.ListArray.from_arrays(np.arange(0, cells.size + 1, width, np.int32),
                                                                     pa.array(cells.ravel()))],
                    names=["lang", "h", "cells"])

    rows = cut_lineage(
        docs.filter(F.col("lang").isNotNull())
        .select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
        .mapInArrow(profile, "lang string, h long, cells array<long>")
        .groupBy("lang", "h").agg(F.first("cells").alias("cells")))
    first = _means(rows, width)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.asarray(batch.column("cells").flatten(), float).reshape(-1, width) / _UNIT
            keep = np.zeros(len(cells), bool)
            lang = np.array(batch.column("lang").to_pylist(), object)
            for name in set(lang):
                at, (char_ref, word_ref) = np.flatnonzero(lang == name), first[name]
                keep[at] = ((js_distance(cells[at, : N_CLASSES - 1], char_ref[None])[:, 0] <= limits.trim_char)
                            & (js_distance(cells[at, N_CLASSES - 1 :], word_ref[None])[:, 0] <= limits.trim_word))
            yield batch.filter(pa.array(keep))

    return first | _means(rows.mapInArrow(near, rows.schema), width)


def _means(rows: DataFrame, width: int) -> dict:
    sums = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"),
                                    *[F.sum(F.col("cells")[i]).alias(f"c{i}") for i in range(width)])
    out = {}
    for row in sorted(sums.collect(), key=lambda r: r["lang"]):
        cells = np.array([row[f"c{i}"] for i in range(width)], float) / (_UNIT * row["n"])
        out[row["lang"]] = (cells[: N_CLASSES - 1], cells[N_CLASSES - 1 :])
    return out


def judge_quality(docs: DataFrame, references: dict | None = None, limits: Limits = Limits(), common=COMMON_WORDS,
                  into: str = "quality") -> DataFrame:
    """All rows and columns of `docs` with a struct (see `VERDICT`) as one more, last column.

    The struct is called `into`, or so with underscores in front if that name is taken.
    """
    refs = language_references(docs, limits, common) if references is None else references
    vocab = vocabulary(common)
    names = list(refs)
    char_ref = np.array([refs[k][0] for k in names]).reshape(len(names), N_CLASSES - 1)
    word_ref = np.array([refs[k][1] for k in names]).reshape(len(names), vocab[2])
    text_at = docs.columns.index("text")

    def verdicts(block: Block) -> pa.Array:
        hashes = block.split().word_hashes()
        base = _base(block, hashes, limits)
        chars, words = _histograms(block, hashes, vocab)
        by_char, by_word = chars.sum(1) >= limits.min_chars, words.sum(1) >= limits.min_words
        nearest = np.full(block.n_docs, None, object)
        cd, wd = np.full(block.n_docs, np.nan), np.full(block.n_docs, np.nan)
        at = np.flatnonzero(by_char | by_word)
        if len(at) and names:
            a = np.where(by_char[at, None], js_distance(_shares(chars[at]), char_ref), np.nan)
            b = np.where(by_word[at, None], js_distance(_shares(words[at]), word_ref), np.nan)
            best = np.argmin(np.fmax(a / limits.char_distance, b / limits.word_distance), 1)
            row = np.arange(len(at))
            cd[at], wd[at] = a[row, best], b[row, best]
            nearest[at] = np.array(names, object)[best]
        far = (cd > limits.char_distance) | (wd > limits.word_distance)
        return pa.StructArray.from_arrays(
            [pa.array(base[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            + [pa.array(base["base_failed"]), pa.array(~base["base_failed"] & ~far), pa.array(nearest, pa.string()),
               pa.array(cd, mask=np.isnan(cd)), pa.array(wd, mask=np.isnan(wd))],
            fields=list(_VERDICT_ARROW))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(text_at).cast(pa.string())):
                rows = batch.slice(block.first, block.n_docs)
                yield pa.RecordBatch.from_arrays([*rows.columns, verdicts(block)], names=[*batch.schema.names, name])

    name = free_name(docs, into)
    return docs.mapInArrow(judge, T.StructType([*docs.schema.fields, T.StructField(name, VERDICT)]))
