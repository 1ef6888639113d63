"""op11: token counts against the tokenizer library, whole texts at a time."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskrank.llm import token_counts
from riskrank.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len((text or "").encode()), len(ids), len(ids) > LIMIT


def odd_texts():
    rng = random.Random(3)
    alphabet = "ab Z09'stre.,!\n\t\r     　\x1c\x1f\x85éñßüçÀ½²٣অกÅé中文字😀🏽‍՘࢏\x00<|>"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    return out + [
        None, "", " ", "\n\n", "  a", "a  ", "it's they'll I'd WE'RE 'tis", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>",
        "<|endoftext", " <|endoftext|>\n", "x" * 3000, "ab " * 5000, "՘" * 9, "the " * 600, "﻿the", "a\x00b",
        "".join(map(chr, range(1, 0x700)))]


def test_any_text_counts_as_in_the_library(spark, library):
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in
             token_counts.count_tokens(docs, PATH, limit=LIMIT).collect()}
    assert found == {i: plain(library, t) for i, t in enumerate(texts)}


def test_slices_end_where_pre_tokens_do(library, monkeypatch):
    proven = token_counts.Proven(token_counts.whole_tokens(PATH), frozenset(), ("<|endoftext|>",))
    counter = token_counts.Counter(PATH, proven)
    rng = random.Random(4)
    text = "".join(rng.choice(["the ", "  of", "\n", " a.", "é ", "'s", "<|endoftext|>", " x", "12 "]) for _ in range(5000))
    monkeypatch.setattr(token_counts.slices, "__defaults__", (37,))
    parts = list(token_counts.slices(text))
    assert len(parts) > 100 and "".join(parts) == text
    assert counter.count(text)[0] == len(library.encode(text, add_special_tokens=False).ids)


def test_a_text_of_megabytes(spark, library):
    text = "whole tokens and oddwordsxq, again\n" * 120_000
    row = token_counts.count_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).first()
    assert row["n_bytes"] == len(text) > 4_000_000
    assert row["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)


def test_every_proven_string_is_one_token(library):
    whole = token_counts.whole_tokens(PATH)
    assert len(whole) > 45_000 and all(len(e.ids) == 1 for e, s in zip(
        library.encode_batch(sorted(whole), add_special_tokens=False), sorted(whole)) if token_counts._PIECES.findall(s) == [s])


def test_a_forgetful_task_counts_the_same(library):
    proven = token_counts.Proven(frozenset(), frozenset(), ())
    counter = token_counts.Counter(PATH, proven)
    counter.costs.memory = 3
    text = "one two three four five one two six"
    assert counter.count(text) == (len(library.encode(text, add_special_tokens=False).ids), 0)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.whole_tokens(public_tokenizers.path("word_bpe_49k.json"))


def test_clashing_names_repeated_rows_and_empty_tables(spark, library):
    rows = [(1, "a b", 7, "x", True), (1, "a b", 7, "x", True), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_tokens int, id string, over_limit boolean")
    found = sorted((tuple(r) for r in token_counts.count_tokens(docs, PATH).collect()), key=repr)
    assert found == [(1, 3, 2, False, 2), (1, 3, 2, False, 2), (None, 0, 0, False, 0)]
    assert token_counts.count_tokens(docs.limit(0), PATH).collect() == []


def test_query_over_the_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in
             QUERIES["op11_token_counts"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert found == {r["doc_id"]: plain(library, r["text"]) for r in docs}
