"""Token counts of whole texts by a byte-level BPE, with a shortcut for strings that are one token.

A byte-level BPE cuts a text into pre-tokens by one pattern and merges each pre-token by itself.  So a vocabulary string
that the merges turn into its own token counts one wherever it is a whole pre-token, and needs no merging.  `prove` finds
these strings once, before any document is read, by running the merges on every string of the vocabulary.  Pre-tokens
outside the proven set are merged by the tokenizer's model, each distinct one once as long as a task remembers it.

Nulls count as empty texts: 0 bytes, 0 tokens.  An empty table gives an empty result.  Rows that share an id, repeated
rows and rows without an id are counted row by row.  Columns of the input other than the two named are not read, whatever
they are called.  Very long texts are worked in slices of about `SLICE` characters, cut before an ASCII space after a
printable ASCII character, where no pre-token can go on; a single word beyond that is one slice.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskrank.llm.tokens import _BYTE_CHAR

#: Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a text that are cut into pre-tokens at once.
SLICE = 1 << 20
#: Merged pre-tokens that a task remembers.
MEMORY = 500_000
#: The proven strings are broadcast: a vocabulary beyond this is refused.
MAX_VOCABULARY = 1_000_000

_PIECES = regex.compile(PATTERN)
_CUT = regex.compile(r"(?<=[!-~])(?= )")
_CHAR_BYTE = {c: b for b, c in _BYTE_CHAR.items()}


class Proven:
    """What `prove` found: strings that are one token, characters on which the two engines differ, special strings."""

    def __init__(self, whole: frozenset[str], odd: frozenset[str], special: tuple[str, ...]):
        self.whole, self.odd, self.special = whole, odd, special


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    """The tokenizer without truncation and padding, if it is of the kind this module knows."""
    shape = json.loads(Path(path).read_text())
    model, pre = shape["model"], shape["pre_tokenizer"] or {}
    plain = (shape["normalizer"] is None and model["type"] == "BPE" and pre.get("type") == "ByteLevel"
             and not pre["add_prefix_space"] and pre.get("use_regex", True) and not model.get("dropout")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
             and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]
                         for t in shape["added_tokens"]))
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_tokens(path: str) -> frozenset[str]:
    """Texts that the vocabulary holds and the merges leave as that one token."""
    tokenizer, out = _tokenizer(path), set()
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    if len(vocabulary) > MAX_VOCABULARY:
        raise ValueError(f"{len(vocabulary)} vocabulary strings, at most {MAX_VOCABULARY} are broadcast")
    for string, number in vocabulary.items():
        if any(ord(c) not in _CHAR_BYTE for c in string):
            continue
        if [t.id for t in tokenizer.model.tokenize(string)] != [number]:
            continue
        try:
            out.add(bytes(_CHAR_BYTE[ord(c)] for c in string).decode())
        except UnicodeDecodeError:  # a part of a character is never a whole pre-token
            continue
    return frozenset(out)


def odd_characters(path: str, first: int, last: int) -> Iterator[int]:
    """Code points of [first, last) that the pattern's engine and the library put into different classes."""
    cut = _tokenizer(path).pre_tokenizer.pre_tokenize_str
    for code in range(first, last):
        if 0xD800 <= code < 0xE000:
            continue
        probe = f"a{chr(code)}!1{chr(code)}\n"
        if [b - a for _, (a, b) in cut(probe)] != [len(p) for p in _PIECES.findall(probe)]:
            yield code


def prove(spark: SparkSession, path: str) -> Proven:
    """Run the merges on the vocabulary, and both engines on every character, before any document is read."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("id").to_numpy()
            if len(codes):
                found = list(odd_characters(path, int(codes[0]), int(codes[-1]) + 1))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["id"])

    odd = spark.range(0, 0x110000, numPartitions=16).mapInArrow(probe, "id long").collect()  # at most every character
    special = tuple(t.content for t in _tokenizer(path).get_added_tokens_decoder().values())
    return Proven(whole_tokens(path), frozenset(chr(r["id"]) for r in odd), special)


class Costs(dict):
    """Tokens of pre-tokens that had to be merged."""

    def __init__(self, path: str, memory: int = MEMORY):
        super().__init__()
        self.model, self.memory = _tokenizer(path).model, memory

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.memory:
            self.clear()
        encoded = piece if piece.isascii() and piece.isalpha() else (
            piece.encode().decode("latin-1").translate(_BYTE_CHAR))
        n = self[piece] = len(self.model.tokenize(encoded))
        return n


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """A text in parts that end where a pre-token does."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class Counter:
    """Counts the tokens of texts; what it remembers stays from text to text."""

    def __init__(self, path: str, proven: Proven):
        self.proven, self.costs, self.path = proven, Costs(path), path
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(proven.special, key=len, reverse=True))
                                     or r"(?!)")
        first = min(proven.odd, default=chr(0x10FFFF))
        self.beyond = re.compile(f"[{re.escape(first)}-{chr(0x10FFFF)}]")

    def _plain(self, text: str) -> tuple[int, int]:
        """Tokens of a stretch without special strings, and how many of its pre-tokens are proven ones."""
        if self.beyond.search(text) and not self.proven.odd.isdisjoint(text):
            return len(_tokenizer(self.path).encode(text, add_special_tokens=False).ids), 0
        pieces, whole = _PIECES.findall(text), self.proven.whole
        rest = [p for p in pieces if p not in whole]
        direct = len(pieces) - len(rest)
        return direct + sum(map(self.costs.__getitem__, rest)), direct

    def count(self, text: str) -> tuple[int, int]:
        """Tokens of a whole text, and how many of its pre-tokens the shortcut counted."""
        tokens = direct = 0
        for part in slices(text):
            stretches = self.special.split(part)
            tokens += len(stretches) - 1
            for stretch in stretches:
                n, d = self._plain(stretch)
                tokens, direct = tokens + n, direct + d
        return tokens, direct


@lru_cache(maxsize=1)
def _counter(path: str, proven: Broadcast) -> Counter:
    """One memory per worker process and job."""
    return Counter(path, proven.value)


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, n_whole) of every row; `n_whole` pre-tokens were counted by the shortcut.

    `path` is the tokenizer's file, at the same place on every machine.
    """
    spark = docs.sparkSession
    proven = spark.sparkContext.broadcast(prove(spark, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, proven)
        for batch in batches:
            found = np.array([counter.count(t.as_py() or "") for t in batch.column("text")], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(found[:, 0]), pa.array(found[:, 0] > limit),
                 pa.array(found[:, 1])], names=["id", "n_bytes", "n_tokens", "over_limit", "n_whole"])

    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"),
                       F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"), body.alias("text"))
    return rows.mapInArrow(count, "id long, n_bytes long, n_tokens long, over_limit boolean, n_whole long")
