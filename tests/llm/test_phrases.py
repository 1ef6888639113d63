"""op13: collocations against a plain version, with the sizes of the trie turned down, and exact arithmetic."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

import duckdb
from riskrank.llm import phrases
from riskrank.llm.hat_trie import HatTrie, pack, unpack
from riskrank.llm.oracle import ORACLE
from riskrank.llm.queries import QUERIES

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def plain(rows, least=10, share=50, top=2000):
    """All counts and scores by dictionaries and Python's own numbers."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    gone = {q for p, a in found.items() if len(p) == 4 for q in (p[:3], (p[0], *p[2:])) if 100 * a >= share * found[q]}
    out = []
    for p, a in found.items():
        if p in gone:
            continue
        cuts = []
        for k in range(1, len(p) - 1):
            left, right = f[p[:k + 1]], f[(p[0], *p[k + 1:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((p[0], -score, -a, " ".join(p[1:]).encode(), left, right))
    out.sort()
    ranked, place = [], Counter()
    for lang, score, a, phrase, left, right in out:
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


def found(docs, **options):
    return sorted(tuple(r) for r in phrases.mine_phrases(docs, mining=phrases.Mining(**options)).collect())


def texts(seed, rows=300):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "b", "éa", "x\x01", "\x1f", "中", "New", "york", "city", "it's", " ", " "]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\x0b", "!?", " of the ", " New york city "]
    out = []
    for _ in range(rows):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(30)))
        out.append((text, rng.choice(["en", "de", None, ""])))
    return [*out, (None, "en"), ("", None), (" \t\n.", "fr"), *out[:40], ("of the " * 4000, "en")]


@pytest.mark.parametrize("options", [
    {}, {"entries": 40, "container": 8}, {"words": 6, "entries": 100, "container": 16}, {"least": 3, "share": 90, "top": 7},
])
@pytest.mark.parametrize("hot", [1 << 16, 12])
def test_against_the_plain_version(spark, monkeypatch, options, hot):
    monkeypatch.setattr(phrases, "HOT", hot)
    monkeypatch.setattr(phrases, "HOT_LEAST", 0)
    monkeypatch.setattr(phrases, "PARTITION_BYTES", 3000)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 500)
    rows = texts(len(options))
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    rules = {k: v for k, v in options.items() if k in ("least", "share", "top")}
    want = plain(rows, **rules)
    assert len(want) > 50 or options.get("top")
    assert found(docs, **options) == sorted(want)


def test_trie_counts_and_spills_whole_subtrees():
    rng = np.random.default_rng(5)
    trie, want, seen, spills = HatTrie(memory=300, limit=20), Counter(), Counter(), 0
    for _ in range(200):
        w = np.minimum(rng.zipf(1.4, size=(3, 50)), 900)
        keys = np.concatenate([pack(w[0], w[1]), pack(*w)])
        want.update(keys.tolist())
        trie.add(keys)
        while (left := trie.spill()) is not None:
            spills += 1
            seen.update(dict(zip(left[0].tolist(), left[1].tolist())))
            gone = set(unpack(left[0])[0].tolist()) & set(trie.root.children)
            assert not any(trie.root.children[w].depth != 1 for w in gone)
    assert spills > 5 and trie.root.size() <= 300
    left = trie.spill(everything=True)
    seen.update(dict(zip(left[0].tolist(), left[1].tolist())))
    assert seen == want and trie.spill(everything=True) is None


def test_containers_burst_two_words_deep():
    trie = HatTrie(memory=10**6, limit=16)
    n = np.arange(2000)
    trie.add(pack(np.full(2000, 7), np.full(2000, 9), n))
    deep = trie.root.children[7].children[9]
    assert deep.depth == 2 and len(deep.container) == 2000 and not deep.children


def test_hot_words_bound_every_prefix(spark, monkeypatch):
    """With two hot words, no prefix holds more than the phrases of one cold word."""
    monkeypatch.setattr(phrases, "HOT", 10)
    rows = [(" ".join(f"hot very w{i * 7 + j}" for j in range(7)), "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    hot = frozenset({("en", "hot"), ("en", "very")})
    everything = np.full(1 << phrases.SIEVE_BITS >> 3, 255, np.uint8)
    runs = phrases.count_runs(phrases._texts(docs, "text", "lang"), phrases.Mining(), hot, everything, 1).collect()
    heads, _, sizes, _ = phrases.expand(bytes(runs[0]["run"]), "u1", "u1", "u4", "u4")
    entries = dict(zip(heads.tobytes().decode().split("\n"), sizes.tolist()))
    assert len(runs) == 1 and {"hot very", "hot very w3", "very w0", "w1"} <= set(entries)
    assert not {"hot", "very"} & set(entries) and max(entries.values()) <= 2


def test_runs_fall_into_prefix_partitions(spark):
    """A phrase's partition depends on its prefix alone, and partitions share the work."""
    docs = spark.createDataFrame(texts(2), "text string, lang string").repartition(4)
    everything = np.full(1 << phrases.SIEVE_BITS >> 3, 255, np.uint8)
    where = {}
    for r in phrases.count_runs(phrases._texts(docs, "text", "lang"), phrases.Mining(), frozenset(), everything, 5).collect():
        heads = phrases.expand(bytes(r["run"]), "u1", "u1", "u4", "u4")[0].tobytes().decode().split("\n")[:-1]
        assert heads == sorted(heads, key=str.encode)
        for head in heads:
            assert where.setdefault((r["lang"], head), r["bucket"]) == r["bucket"]
    assert set(where.values()) == set(range(5))


@pytest.mark.parametrize("bits", [6, 9, 27])
def test_a_full_sieve_changes_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(phrases, "SIEVE_BITS", bits)
    rows = texts(8) + [(f"the rare{i} of rarer{i}", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    words = phrases.count_words(phrases._texts(docs, "text", "lang"), 50)
    bitmap = phrases.sieve(words, 10)
    share = np.unpackbits(bitmap).mean()
    assert share > 0.2 if bits == 6 else 0 < share < 0.5
    assert found(docs) == sorted(plain(rows))


def test_exact_scores(spark):
    from pyspark.sql import functions as F
    rows = [(10**15, 10**15 + 7, 10**15 + 9), (3 * 10**9, 4 * 10**9 + 1, 5 * 10**9 + 3), (1, 1, 1), (999_999_999_999,) * 3]
    got = spark.createDataFrame(rows, "a long, l long, r long").select(
        "a", phrases.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r["s"] for r in got] == [10**6 * a * a // (x * y) for a, x, y in rows]


def test_empty_tables_and_clashing_names(spark):
    rows = [("a b. " * 12, "en", 1, "x", 2)]
    docs = spark.createDataFrame(rows, "text string, lang string, f int, phrase string, score int")
    assert found(docs) == [("en", 1, "a b", 12, 12, 12, 24, 1_000_000)]
    assert found(docs.limit(0)) == []
    assert found(docs.withColumn("text", phrases.F.lit(None).cast("string"))) == []


def test_query_against_its_statement(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.sql(ORACLE["op13_phrase_collocations"])
    got = QUERIES["op13_phrase_collocations"](spark, sf)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall())
