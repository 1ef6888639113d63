"""Chunks of whole documents that question other tasks about their positions and get answers back.

Documents are dealt by hash to chunks of a few megabytes, compressed; a chunk always holds the same documents in the
same order, whichever task or attempt builds it.  Positions are numbers within the chunk.  A chunk sends compact
arrays of (hash, position) to hash buckets, a bucket counts hashes over all chunks, and answers with positions.  The
arrays cost a few bytes per position where a row per position would cost dozens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from riskrank.llm.frames import shuffle_width, text_bytes
from riskrank.llm.text import Block, column

#: Bytes of text in a chunk, and of text whose positions go to one bucket, on average.
CHUNK_BYTES = BUCKET_BYTES = 8 << 20
#: Bytes of text whose chunks or buckets lie in one shuffle partition, at most on average.
PARTITION_BYTES = 64 << 20
#: Buckets are the top bits of a hash: this many bits at least, which then need not be sent.
LEAST_BITS = 8

NO_ID = np.iinfo(np.int64).min


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed piece; each array's bytes are transposed, so that high bytes lie together."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T) for a in arrays]
    head = np.array([x for a in arrays for x in (len(a), a.dtype.itemsize)], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(p.tobytes() for p in planes))


def expand(blob: bytes, *kinds: str) -> list[np.ndarray]:
    """The arrays of `squeeze`, in the given types."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    head, at, out = raw[: 16 * len(kinds)].view(np.int64).reshape(-1, 2), 16 * len(kinds), []
    for (n, size), kind in zip(head.tolist(), kinds, strict=True):
        part = np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T)
        out.append(part.ravel().view(kind) if n else np.zeros(0, kind))
        at += n * size
    return out


def steps(positions: np.ndarray) -> np.ndarray:
    """Rising positions as differences; `np.cumsum` is the way back."""
    return np.diff(positions, prepend=0).astype(np.uint32)


def short(hashes: np.ndarray, octets: int = 8 - LEAST_BITS // 8) -> np.ndarray:
    """The low bytes of hashes: what remains to be sent when the bucket gives the top bits."""
    kept = hashes.view(np.uint8).reshape(-1, 8)[:, :octets]
    return np.ascontiguousarray(kept).view(f"V{octets}").ravel()


def long(kept: np.ndarray) -> np.ndarray:
    """Low bytes as unsigned numbers again."""
    octets = kept.dtype.itemsize
    out = np.zeros((len(kept), 8), np.uint8)
    out[:, :octets] = kept.view(np.uint8).reshape(-1, octets)
    return out.view(np.uint64).ravel()


class Dealt:
    """How many shuffle partitions chunks and buckets are dealt to: as many as the input asks for, not the session."""

    def __init__(self, partitions: int):
        self.partitions = partitions

    def by(self, df: DataFrame, key: str) -> GroupedData:
        return df.repartition(self.partitions, key).groupBy(key)


def chunked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int, Dealt]:
    """(chunk, docs): compressed documents by chunk, to be grouped by `chunk`; the bits of a bucket number; and how
    both are grouped.

    Rows of one id share a chunk; those without an id are dealt by text.
    """
    n, total = text_bytes(docs, text)
    chunks = max(1, min(n, max(shuffle_width(docs), -(-total // chunk_bytes))))
    number, body = F.col(doc_id).cast("long"), F.col(text).cast("string")
    key = F.when(number.isNotNull(), F.xxhash64(number)).otherwise(F.xxhash64(body))
    rows = docs.select(F.pmod(key, F.lit(chunks)).alias("chunk"), number.alias("id"), body.alias("text"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            ids = batch.column("id").fill_null(NO_ID).to_numpy()
            data, offsets = column(batch.column("text"))
            order = np.argsort(chunk, kind="stable")
            first = np.flatnonzero(np.r_[True, chunk[order][1:] != chunk[order][:-1]]) if len(order) else []
            blobs = []
            for rows in np.split(order, first[1:]) if len(order) else []:
                sizes = (offsets[rows + 1] - offsets[rows]).astype(np.int64)
                body = b"".join(data[offsets[r] : offsets[r + 1]].tobytes() for r in rows.tolist())
                head = np.concatenate([[len(rows)], ids[rows], sizes]).astype(np.int64).tobytes()
                blobs.append(zstandard.ZstdCompressor(level=3).compress(head + body))
            owner = pa.array(chunk[order][first], pa.int64())
            yield pa.RecordBatch.from_arrays([owner, pa.array(blobs, pa.binary())], names=["chunk", "docs"])

    bits = max(LEAST_BITS, (max(total, 1) // BUCKET_BYTES).bit_length())
    dealt = Dealt(max(shuffle_width(docs), -(-total // PARTITION_BYTES)))
    return rows.mapInArrow(bundle, "chunk long, docs binary"), bits, dealt


class Chunk:
    """The documents of a chunk in the order of their ids (then of their bytes)."""

    def __init__(self, blobs):
        ids, sizes, bodies = [], [], []
        for blob in blobs.to_pylist():
            raw = zstandard.ZstdDecompressor().decompress(blob)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            head = np.frombuffer(raw, np.int64, 2 * n, 8)
            ids.append(head[:n])
            sizes.append(head[n:])
            bodies.append(np.frombuffer(raw, np.uint8, offset=8 + 16 * n))
        ids, sizes, data = np.concatenate(ids), np.concatenate(sizes), np.concatenate(bodies)
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(ids, kind="stable")
        if (ids[order][1:] == ids[order][:-1]).any():
            order = np.array(sorted(range(len(ids)), key=lambda i: (
                ids[i], data[starts[i] : starts[i] + sizes[i]].tobytes())), np.int64)
        self.ids, sizes = ids[order], sizes[order]
        self.offsets = np.append(0, np.cumsum(sizes))
        places = zip(starts[order].tolist(), sizes.tolist(), strict=True)
        self.data = np.concatenate([data[a : a + n] for a, n in places])

    def blocks(self, lower: bool = False, limit: int = 1 << 20) -> Iterator[Block]:
        """Blocks of whole documents, in order."""
        first, n = 0, len(self.ids)
        while first < n:
            last = max(first + 1, int(np.searchsorted(self.offsets, self.offsets[first] + limit, "right")) - 1)
            a, b = self.offsets[first], self.offsets[last]
            yield Block(self.data[a:b], self.offsets[first : last + 1] - a, first, lower)
            first = last

    def id_array(self) -> pa.Array:
        return pa.array(self.ids, mask=self.ids == NO_ID)


def by_bucket(bits: int, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket and the entries (in their order) whose hash lies in it."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    at = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1]]) if len(order) else np.zeros(0, int)
    for rows in np.split(order, at[1:]) if len(order) else []:
        yield int(bucket[rows[0]]), rows


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n positions lie in a stretch of `width` from one of `starts`."""
    change = np.zeros(n + width + 1, np.int32)
    change[starts] += 1
    change[starts + width] -= 1
    return np.cumsum(change)[:n] > 0


def runs(mask: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of set positions [start, end); none crosses a cut."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[cuts] = True
    before = np.r_[False, mask[:-1]]
    after = np.r_[mask[1:], False] if len(mask) else mask
    start = np.flatnonzero(mask & (~before | edge[:-1]))
    end = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return start, end
