"""Substring deduplication: Rabin-Karp hashes of every fixed-length token window, counted over all documents.

A window is `width` consecutive words of one document.  Every window whose words also start earlier (in a document
with a smaller id, or earlier in the same one) is repeated; repeated windows merge into maximal removal intervals.
Windows that a chunk holds twice are settled inside it, so a bucket gets each window at most once per chunk: a
passage that a third of all documents share reaches it as one entry per chunk.

Equality is judged by 64-bit hashes.  With n windows the chance of any wrong pair is about n * n / 2**65: one in two
thousand for 10**8 windows; above 10**10 windows a few in the whole corpus must be expected.

Null and empty texts have no words.  A document without an id counts as the first; documents that share an id are
ordered by their text.  An empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskrank.llm.chunks import Chunk, by_bucket, chunked, covered, expand, long, runs, short, squeeze, steps
from riskrank.llm.text import Block, window_hashes, windows_inside

_SENT = "bucket long, chunk long, kind int, body binary"


def _windows(chunk: Chunk, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word (number within the chunk) and document of every window."""
    hashes, starts, docs, words = [], [], [], 0
    for block in chunk.blocks():
        own = block.split().word_hashes()
        at = windows_inside(block.word_at, width)
        hashes.append(window_hashes(own, width)[at])
        starts.append(at + words)
        docs.append(block.word_docs()[at] + block.first)
        words += len(own)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(docs)


def _first_of_each(hashes: np.ndarray) -> np.ndarray:
    """Entries that are the first with their hash."""
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    out = np.zeros(len(hashes), bool)
    out[order[np.r_[True, sorted_[1:] != sorted_[:-1]][: len(order)]]] = True
    return out


def _ask(width: int, bits: int):
    """A chunk sends its distinct windows to the buckets, and the repeats among its own to itself (kind 1)."""
    def ask(key, table):
        chunk = Chunk(table.column("docs"))
        hashes, starts, docs = _windows(chunk, width)
        first = _first_of_each(hashes)
        number = key[0].as_py()
        rows = [(number % (1 << bits), 1, squeeze(steps(starts[~first])))]
        hashes, starts, docs = hashes[first], starts[first], docs[first]
        for bucket, at in by_bucket(bits, hashes):
            own, count = np.unique(docs[at], return_counts=True)
            rows.append((bucket, 0, squeeze(short(hashes[at]), steps(starts[at]),
                                            np.diff(chunk.ids[own], prepend=0), count.astype(np.uint32))))
        buckets, kinds, bodies = zip(*rows, strict=True)
        return pa.table({"bucket": pa.array(buckets, pa.int64()), "chunk": pa.array([number] * len(rows), pa.int64()),
                         "kind": pa.array(kinds, pa.int32()), "body": pa.array(bodies, pa.binary())})

    return ask


def _count(key, table):
    """A bucket finds the windows that several chunks hold, and tells all but the earliest that they are repeated."""
    kind = table.column("kind").to_numpy()
    chunk, body = table.column("chunk").to_numpy(), table.column("body").to_pylist()
    own = np.flatnonzero(kind == 1).tolist()
    answers = [(int(chunk[i]), body[i]) for i in own]
    asked = np.flatnonzero(kind == 0).tolist()
    if asked:
        parts = [expand(body[i], "V7", "u4", "i8", "u4") for i in asked]
        sizes = [len(p[0]) for p in parts]
        hashes = long(np.concatenate([p[0] for p in parts]))
        home = np.repeat(chunk[asked], sizes)
        start = np.concatenate([np.cumsum(p[1], dtype=np.int64) for p in parts])
        doc = np.concatenate([np.repeat(np.cumsum(p[2]), p[3]) for p in parts])
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        many = order[np.r_[False, same] | np.r_[same, False]]
        many = many[np.lexsort((home[many], doc[many], hashes[many]))]
        later = many[np.r_[False, hashes[many][1:] == hashes[many][:-1]][: len(many)]]
        later = later[np.lexsort((start[later], home[later]))]
        cut = np.flatnonzero(home[later][1:] != home[later][:-1]) + 1
        answers += [(int(home[rows[0]]), squeeze(steps(start[rows]))) for rows in np.split(later, cut) if len(rows)]
    return pa.table({"chunk": pa.array([a for a, _ in answers], pa.int64()),
                     "body": pa.array([b for _, b in answers], pa.binary())})


def joined(block: Block, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words, each followed by a space, and where each document's begin."""
    size = np.where(keep, block.ends - block.starts, 0)
    kept = np.flatnonzero(keep)
    n = size[kept]
    out = np.full(int(n.sum()) + len(kept), 0x20, np.uint8)
    inside = np.zeros(len(block.data) + 1, np.int8)
    inside[block.starts[kept]] += 1
    np.subtract.at(inside, block.ends[kept], 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    out[np.arange(int(n.sum())) + np.repeat(np.arange(len(kept)), n)] = block.data[inside]
    ahead = np.append(0, np.cumsum(np.where(keep, size + 1, 0)))
    return out, ahead[block.word_at]


def _remove(width: int, with_text: bool):
    def remove(key, docs, answers):
        if not docs.num_rows:
            return _empty(with_text)
        chunk = Chunk(docs.column("docs"))
        repeated = [np.cumsum(expand(b, "u4")[0], dtype=np.int64) for b in answers.column("body").to_pylist()]
        repeated = np.concatenate(repeated) if repeated else np.zeros(0, np.int64)
        words, parts = 0, []
        repeated.sort()
        for block in chunk.blocks():
            n = len(block.split().starts)
            mine = repeated[np.searchsorted(repeated, words) : np.searchsorted(repeated, words + n)] - words
            gone = covered(mine, width, n)
            words += n
            total = np.append(0, np.cumsum(gone))[block.word_at]
            start, end = runs(gone, block.word_at)
            doc = np.searchsorted(block.word_at, start, "right") - 1
            base = block.word_at[doc]
            spans = pa.ListArray.from_arrays(
                np.searchsorted(doc, np.arange(block.n_docs + 1)).astype(np.int32),
                pa.StructArray.from_arrays([pa.array(start - base), pa.array(end - base)], names=["start", "end"]))
            body, at = joined(block, ~gone)
            body, at = body.tobytes(), at.tolist()
            texts = [body[a : max(a, b - 1)] for a, b in zip(at, at[1:], strict=False)]
            columns = [chunk.id_array()[block.rows], pa.array(np.diff(block.word_at)), pa.array(np.diff(total)), spans,
                       pa.array([hashlib.sha256(t).hexdigest() for t in texts])]
            parts.append(pa.table(columns + [pa.array(texts, pa.binary()).cast(pa.string())] * with_text,
                                  names=_names(with_text)))
        return pa.concat_tables(parts)

    return remove


def _names(with_text: bool) -> list[str]:
    return ["id", "n_words", "n_removed", "spans", "kept_sha256"] + ["kept_text"] * with_text


def _empty(with_text: bool) -> pa.Table:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), span, pa.string()] + [pa.string()] * with_text
    return pa.schema(list(zip(_names(with_text), kinds, strict=True))).empty_table()


def remove_repeats(docs: DataFrame, width: int = 20, with_text: bool = False, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """One row per document: `id`, `n_words`, `n_removed`, `spans` (removed words, [start, end)), `kept_sha256` (of
    the kept words joined by one space) and, if asked for, `kept_text`."""
    chunks, bits, dealt = chunked(docs, doc_id, text)
    own = dealt.by(chunks, "chunk")
    answers = dealt.by(own.applyInArrow(_ask(width, bits), _SENT), "bucket").applyInArrow(
        _count, "chunk long, body binary")
    out = "id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"
    return own.cogroup(dealt.by(answers, "chunk")).applyInArrow(
        _remove(width, with_text), out + ", kept_text string" * with_text)
