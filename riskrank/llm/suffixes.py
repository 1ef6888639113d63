"""Suffix deduplication of bytes by bucket-pointer refinement.

Every byte covered by a string of `width` bytes that also starts anywhere else is removed.  Sorting all suffixes of
the corpus would move each of them; here only sampled suffixes enter the buckets, chosen so that equal strings
always choose alike: of the q-grams inside a string, the one with the smallest hash is its anchor.  Neighbouring
strings mostly share their anchor and form one run.

1. Runs fall into initial buckets by their anchor's q-gram.  A bucket with a single run in the whole corpus is
   settled: nothing in it repeats.
2. Buckets are refined by what lies at earlier and later offsets: the bytes of the whole run.  Runs that agree are
   settled: all their strings repeat.
3. What is left - runs that share an anchor but not all their bytes - is refined string by string and pass by pass.  A
   position's bucket pointer for `gram` bytes is the identifier of its q-gram; a pass makes the pointer for twice the bytes
   (at most `width`) out of two pointers that the pass before made, at the position and as far behind it as those reach.
   Buckets are counted over the corpus after each pass.  Positions alone in their bucket are settled and never
   looked at again, so a pass reads and moves only what the one before left open.  What shares a bucket after the last
   pass, for all `width` bytes, repeats.

A chunk that holds more than `MANY` different runs of one anchor sends that fact alone and leaves those runs to step
3, where strings are spread by hash, so a common line does not gather its surroundings anywhere.  Pointers are
64-bit hashes (48 bits more within a bucket in step 2); see `substrings` for the chance of a wrong pair.

Null and empty texts have no bytes.  Matches never cross documents.  Repeated rows repeat each other.  An empty
table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from riskrank.llm.chunks import Chunk, by_bucket, chunked, expand, long, runs, short, squeeze, steps
from riskrank.llm.text import _BYTE, _BYTE_BASE, _POW, MAX_WINDOW, between, distinct, mix, prefix

#: Different runs of one anchor that a chunk names one by one.
MANY = 8
#: Bytes whose q-grams are hashed at once.
PIECE = 1 << 20

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_SENT = "bucket long, chunk long, kind int, body binary"
_ANSWER = "chunk long, part long, kind int, body binary"


class Runs:
    """The runs of a chunk: strings from `first` to `last` (byte positions), their anchor's hash and own hash."""

    def __init__(self, chunk: Chunk, width: int, gram: int, ask=None, level: int = 0):
        valid = np.zeros(max(0, len(chunk.data) - width + 1), bool)
        for a, b in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist(), strict=True):
            valid[a : max(a, b - width + 1)] = True
        parts = []
        for a in range(0, len(valid), PIECE):
            b = min(len(valid), a + PIECE)
            piece = chunk.data[a : b + width - 1]
            sums = prefix(_BYTE[piece], _BYTE_BASE)
            ids = mix((sums[gram:] - sums[:-gram]) * _POW[_BYTE_BASE][1].upto(len(sums) - gram) + np.uint64(gram))
            starts = np.flatnonzero(valid[a:b])
            if not len(starts):
                continue
            anchor = _least(ids, width - gram + 1)[starts]
            new = np.r_[True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]
            first, last = starts[new], starts[np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]]
            at = anchor[new]
            own = between(sums, first, last + width, _BYTE_BASE)
            own = mix(own + (at - first).astype(np.uint64) * _C[0])
            parts.append((first + a, last + a, ids[at], own, _pointers(ids, first, last, width, gram, a, ask, level)))
        columns = list(zip(*parts, strict=True)) if parts else [[np.zeros(0, k)] for k in "qqQQ"] + [[None]]
        self.first, self.last, self.anchor, self.own = (np.concatenate(c) for c in columns[:4])
        self.strings = [s for s in columns[4] if s is not None]


def passes(width: int, gram: int) -> list[tuple[int, int]]:
    """Bytes behind the pointers of each pass, and how far apart the two are of which it makes them."""
    out, have = [], gram
    while have < width:
        apart = min(have, width - have)
        have += apart
        out.append((have, apart))
    return out


def _pointers(ids, first, last, width, gram, base, ask, level):
    """Pointers after a pass and starts of the strings that `ask` picks, from the pieces' q-gram identifiers.

    `ask` gets the starts of all strings of the piece.
    """
    if ask is None:
        return None
    n = last - first + 1
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    at = at[ask(at + base)]
    if len(at):
        for _, apart in passes(width, gram)[:level]:
            ids = mix(ids[:-apart] * _C[0] + ids[apart:] * _C[1])
    return ids[at] if len(at) else np.zeros(0, np.uint64), at + base


def _least(ids: np.ndarray, span: int) -> np.ndarray:
    """Position of the smallest of every `span` consecutive identifiers (of equal ones, the first)."""
    bits = np.uint64(max(1, len(ids).bit_length()))
    least, have = ((ids >> bits) << bits) | np.arange(len(ids), dtype=np.uint64), 1
    while 2 * have <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if span > have:
        least = np.minimum(least[: have - span], least[span - have :])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


class Entries:
    """What a chunk says about its runs: one entry per different run, or one for an anchor with too many.

    Entries are in the order of anchors, so an answer needs no keys.  `of` is the entry of each run, `flag` 1 for a
    run the chunk holds twice and 2 for an anchor with too many different ones.
    """

    def __init__(self, found: Runs):
        order = np.lexsort((found.own, found.anchor))
        anchor, own = found.anchor[order], found.own[order]
        same_anchor = np.r_[False, anchor[1:] == anchor[:-1]][: len(order)]
        new = ~(same_anchor & np.r_[False, own[1:] == own[:-1]][: len(order)])
        group = np.cumsum(~same_anchor) - 1
        many = (np.bincount(group, new) > MANY)[group] if len(order) else new
        new = np.where(many, ~same_anchor, new)
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(order)))
        self.anchor = anchor[at]
        self.flag = np.where(many[at], 2, count > 1).astype(np.uint8)
        self.own = np.where(self.flag == 2, np.uint64(0), own[at])
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.first = order[at]


def _name(width: int, gram: int, bits: int):
    def name(key, table):
        entries = Entries(Runs(Chunk(table.column("docs")), width, gram))
        rows = [(b, squeeze(short(entries.anchor[at]), short(entries.own[at], 6), entries.flag[at]))
                for b, at in by_bucket(bits, entries.anchor)]
        return _sent(key[0].as_py(), [(b, 0, body) for b, body in rows])

    return name


def _sent(chunk: int, rows: list[tuple[int, int, bytes]]) -> pa.Table:
    buckets, kinds, bodies = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"bucket": pa.array(buckets, pa.int64()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
                     "kind": pa.array(kinds, pa.int32()), "body": pa.array(bodies, pa.binary())})


def _refine(key, table):
    """Answer each entry: bit 0 if its run occurs elsewhere, bit 1 if its strings have to be told apart."""
    chunk = table.column("chunk").to_numpy()
    parts = [expand(b, "V7", "V6", "u1") for b in table.column("body").to_pylist()]
    sizes = [len(p[0]) for p in parts]
    anchor, own = long(np.concatenate([p[0] for p in parts])), long(np.concatenate([p[1] for p in parts]))
    flag, home = np.concatenate([p[2] for p in parts]), np.repeat(chunk, sizes)
    order = np.lexsort((home, own, flag == 2, anchor))
    a, o, f = anchor[order], own[order], flag[order]
    bucket = np.cumsum(np.r_[True, a[1:] != a[:-1]]) - 1
    kind = np.cumsum(np.r_[True, (a[1:] != a[:-1]) | (o[1:] != o[:-1]) | ((f[1:] == 2) != (f[:-1] == 2))]) - 1
    first = np.r_[True, kind[1:] != kind[:-1]]
    again = ((np.bincount(kind) > 1) | (np.bincount(kind, f == 1) > 0))[kind] & (f != 2)
    open_ = ~again  # alone with its bytes, or too many to say
    kinds = np.bincount(bucket, first)
    mixed = ((np.bincount(bucket, open_) > 0) & ((kinds > 1) | (np.bincount(bucket, f == 2) > 0)))[bucket]
    code = again.astype(np.uint8) | ((mixed & (open_ | first)).astype(np.uint8) << 1)
    out = np.empty(len(order), np.uint8)
    out[order] = code
    codes = [squeeze(c) for c in np.split(out, np.cumsum(sizes)[:-1])]
    return _answers(chunk.tolist(), key[0].as_py(), [0] * len(codes), codes)


class Open:
    """A chunk between passes: settled runs (first and last starts), and the strings still open.

    Strings are numbered by their pointer; a pointer's number is its place among the chunk's distinct ones in order, so
    the answers of all buckets, one after another, say of each whether it is alone.
    """

    def __init__(self, first: np.ndarray, last: np.ndarray, live: np.ndarray):
        self.first, self.last, self.live = first, last, live

    @classmethod
    def start(cls, chunk: Chunk, answers: pa.Table, width: int, gram: int) -> Open:
        """From the answers about runs."""
        code = _told(answers)
        found = Runs(chunk, width, gram)
        entries = Entries(found)
        settled = ((entries.flag == 1) | (code & 1 > 0))[entries.of]
        # a run that the chunk holds twice is looked into once
        spoken = np.zeros(len(found.first), bool)
        spoken[entries.first] = True
        spoken |= (entries.flag == 2)[entries.of]
        spoken &= (code & 2 > 0)[entries.of]
        n = (found.last - found.first + 1)[spoken]
        live = np.repeat(found.first[spoken] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return cls(found.first[settled], found.last[settled], np.sort(live))

    @classmethod
    def after(cls, answers: pa.Table) -> Open:
        """What a pass left open, from the chunk's own message to itself and the answers about its pointers."""
        own = answers.filter(pc.equal(answers.column("kind"), 1)).column("body").to_pylist()
        first, more, live, of = expand(own[0], *["u4"] * 4)
        first = np.cumsum(first, dtype=np.int64)
        return cls(first, first + more, np.cumsum(live, dtype=np.int64)[_told(answers)[of] > 0])

    def ask(self, chunk: Chunk, number: int, width: int, gram: int, level: int, bits: int) -> pa.Table:
        """The pointers of a pass for the buckets, with those the chunk has twice marked, and the state for the chunk."""
        open_ = np.zeros(len(chunk.data) + 1, bool)
        open_[self.live] = True
        found = Runs(chunk, width, gram, ask=open_.__getitem__, level=level).strings if len(self.live) else []
        pointers, _, of = distinct(np.concatenate([p for p, _ in found]) if found else np.zeros(0, np.uint64))
        twice = (np.bincount(of, minlength=len(pointers)) > 1).astype(np.uint8)
        order = np.argsort(self.first, kind="stable")
        own = squeeze(steps(self.first[order]), (self.last - self.first)[order].astype(np.uint32), steps(self.live),
                      of.astype(np.uint32))
        return _sent(number, [(number % (1 << bits), 1, own)] + [
            (b, 0, squeeze(short(pointers[at]), twice[at])) for b, at in by_bucket(bits, pointers)])


def _told(answers: pa.Table) -> np.ndarray:
    """The answers of all buckets, in the order of the questions."""
    bodies = answers.filter(pc.equal(answers.column("kind"), 0)).sort_by("part").column("body").to_pylist()
    return np.concatenate([expand(b, "u1")[0] for b in bodies]) if bodies else np.zeros(0, np.uint8)


def _ask_pointers(width: int, gram: int, bits: int, level: int):
    def ask(key, docs, answers):
        if not docs.num_rows:
            return _sent(0, [])
        chunk = Chunk(docs.column("docs"))
        now = Open.start(chunk, answers, width, gram) if level == 1 else Open.after(answers)
        return now.ask(chunk, key[0].as_py(), width, gram, level, bits)

    return ask


def _count_pointers(key, table):
    """Tell each chunk which of its pointers are not alone; what a chunk tells itself comes through as it is."""
    kind, chunk, body = (table.column(c).to_pylist() for c in ("kind", "chunk", "body"))
    asked = [i for i, k in enumerate(kind) if k == 0]
    codes = []
    if asked:
        parts = [expand(body[i], "V7", "u1") for i in asked]
        _, _, of = distinct(long(np.concatenate([p[0] for p in parts])))
        shared = np.bincount(of, 1 + np.concatenate([p[1] for p in parts]).astype(float)) > 1
        codes = np.split(shared[of].astype(np.uint8), np.cumsum([len(p[0]) for p in parts])[:-1])
    own = [i for i, k in enumerate(kind) if k == 1]
    return _answers([chunk[i] for i in [*asked, *own]], key[0].as_py(), [0] * len(asked) + [1] * len(own),
                    [squeeze(c) for c in codes] + [body[i] for i in own])


def _answers(chunks: list[int], part: int, kinds: list[int], bodies: list[bytes]) -> pa.Table:
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "part": pa.array([part] * len(bodies), pa.int64()),
                     "kind": pa.array(kinds, pa.int32()), "body": pa.array(bodies, pa.binary())})


def _cut(width: int, gram: int, with_bytes: bool):
    def cut(key, docs, answers):
        if not docs.num_rows:
            return _empty(with_bytes)
        chunk = Chunk(docs.column("docs"))
        now = Open.after(answers) if width > gram else Open.start(chunk, answers, width, gram)
        change = np.zeros(len(chunk.data) + width + 1, np.int32)
        for first, last in ((now.first, now.last), (now.live, now.live)):
            np.add.at(change, first, 1)
            np.subtract.at(change, last + width, 1)
        gone = np.cumsum(change)[: len(chunk.data)] > 0
        start, end = runs(gone, chunk.offsets)
        doc = np.searchsorted(chunk.offsets, start, "right") - 1
        base = chunk.offsets[doc]
        bounds = np.searchsorted(doc, np.arange(len(chunk.ids) + 1))
        spans = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.StructArray.from_arrays(
            [pa.array(start - base), pa.array(end - base)], names=["start", "end"]))
        total = np.append(0, np.cumsum(gone))[chunk.offsets]
        body = chunk.data[~gone].tobytes()
        at = (chunk.offsets - total).tolist()
        kept = [body[a:b] for a, b in zip(at, at[1:], strict=False)]
        numbers = [pa.array(np.diff(x)) for x in (chunk.offsets, total, bounds)]
        columns = [chunk.id_array(), *numbers, spans, pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
        return pa.table(columns + [pa.array(kept, pa.binary())] * with_bytes, names=_names(with_bytes))

    return cut


def _names(with_bytes: bool) -> list[str]:
    return ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"] + ["kept"] * with_bytes


def _empty(with_bytes: bool) -> pa.Table:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64()] * 4 + [span, pa.string()] + [pa.binary()] * with_bytes
    return pa.schema(list(zip(_names(with_bytes), kinds, strict=True))).empty_table()


def remove_repeated_bytes(docs: DataFrame, width: int = 200, gram: int = 96, with_bytes: bool = False,
                          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `id`, `n_bytes`, `n_removed`, `n_spans`, `spans` (removed bytes, [start, end)),
    `kept_sha256` and, if asked for, the `kept` bytes."""
    if not 0 < gram <= width:
        raise ValueError("a string must hold a q-gram")
    if 2 * width - gram > MAX_WINDOW:
        raise ValueError(f"strings of {width} bytes, whose runs may be longer than {MAX_WINDOW}")
    chunks, bits, dealt = chunked(docs, doc_id, text)
    own = dealt.by(chunks, "chunk")
    told = dealt.by(own.applyInArrow(_name(width, gram, bits), _SENT), "bucket").applyInArrow(_refine, _ANSWER)
    for level in range(1, len(passes(width, gram)) + 1):
        asked = own.cogroup(dealt.by(told, "chunk")).applyInArrow(_ask_pointers(width, gram, bits, level), _SENT)
        told = dealt.by(asked, "bucket").applyInArrow(_count_pointers, _ANSWER)
    out = ("id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, "
           "kept_sha256 string")
    return own.cogroup(dealt.by(told, "chunk")).applyInArrow(_cut(width, gram, with_bytes), out + ", kept binary" * with_bytes)
