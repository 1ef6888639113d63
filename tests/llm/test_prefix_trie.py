"""op12: the prefix trie against a plain version, list ranking on its own, and the query against its SQL."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from riskrank.llm import euler_tour, prefix_trie
from riskrank.llm.oracle import ORACLE
from riskrank.llm.queries import QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        whole = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        kids = [below[k] for k in children[node]]
        below[node] = (sum(k[0] for k in kids) or 1, saved + sum(k[1] for k in kids))
        text = ",".join(map(str, sorted(ends[node])))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                    len(children[node]), *below[node], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def found(conversations, **options):
    got = prefix_trie.prefix_trie(conversations, **options)
    return sorted(tuple(r) for r in got.select(COLUMNS).collect())


def talk(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 200), convs):
        start = rng.choice([[], [("user", "hi")], [("user", "hi"), ("bot", "hello é")]])
        turns = start + [(rng.choice(["user", "bot", None, ""]), rng.choice(["a", "b", "", None, "long " * 30]))
                         for _ in range(rng.randrange(14))]
        for i, (role, text) in enumerate(turns):
            rows.append((c, rng.choice([i, i, i, None, 3]), role, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("base, hot, ranges", [(1 << 15, 1024, 8), (8, 1024, 3), (30, 3, 40)])
def test_against_the_plain_version(spark, monkeypatch, base, hot, ranges):
    monkeypatch.setattr(prefix_trie, "HOT", hot)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 2 if hot == 3 else 12)
    monkeypatch.setattr(prefix_trie, "shuffle_width", lambda df: ranges)
    rows = talk(base)
    assert found(spark.createDataFrame(rows, SCHEMA), base=base) == plain(rows)


def test_one_conversation_fills_many_ranges(spark, monkeypatch):
    """A third of all rows are one conversation, which others take the start of, and its neighbours are copies of it."""
    monkeypatch.setattr(prefix_trie, "shuffle_width", lambda df: 12)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 4)
    rows = [(c, i, "user", f"t{i % 7}") for c in (10, 11, 12) for i in range(700)]
    rows += [(c, i, "bot", "same") for c in range(100, 400) for i in range(2)]
    conversations = spark.createDataFrame(rows, SCHEMA)
    assert found(conversations, base=100) == plain(rows)
    named = conversations.withColumnRenamed("conv_id", "conv")
    placed = prefix_trie.turn_sums(named, 12).filter("conv = 11").orderBy("p").collect()
    assert [r["p"] for r in placed] == list(range(1, 701))
    assert [r["s1"] for r in placed][1:] == [r["t1"] for r in placed][:-1]


def test_nulls_repeated_rows_and_clashing_names(spark):
    rows = [(None, 1, "user", "lost"), (5, None, None, None), (5, None, "user", "a"), (5, 0, "user", "a"),
            (5, 0, "user", "a"), (6, 0, "", ""), (7, 9, "user", "x" * 300_000), (-3, 1, None, "é")]
    conversations = spark.createDataFrame(rows, SCHEMA).select(
        "*", F.lit(1).alias("depth"), F.lit("x").alias("k1"), F.lit(2).alias("conv"), F.lit(3).alias("bytes"))
    assert found(conversations) == plain(rows)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)) == []


def test_a_lone_turnless_conversation_ends_at_the_root(spark):
    turnless = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(turnless, 0, "user", "only")]
    root = (turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows) == [root]


@pytest.mark.parametrize("base", [1, 5, 40, 10_000])
def test_list_ranking(spark, base):
    rng = random.Random(base)
    names = [(rng.randrange(50), i) for i in range(500)]
    rng.shuffle(names)
    values = [(rng.randrange(9), rng.randrange(-5, 5)) for _ in names]
    rows = [(*n, *after, *v) for n, after, v in zip(names, [*names[1:], (None, None)], values)]
    links = spark.createDataFrame(rows, "a long, b long, na long, nb long, u long, v long").repartition(7)
    got = {(r["a"], r["b"]): (r["u"], r["v"]) for r in euler_tour.rank_list(links, ["u", "v"], base).collect()}
    sums, want = (0, 0), {}
    for n, v in zip(names, values):
        want[n] = sums
        sums = (sums[0] + v[0], sums[1] + v[1])
    assert got == want


def test_links_that_are_no_list_are_refused(spark):
    links = spark.createDataFrame([(1, 1, 2, 2, 1), (2, 2, 1, 1, 1)], "a long, b long, na long, nb long, v long")
    with pytest.raises(Exception, match="not one list"):
        euler_tour.rank_list(links, ["v"]).collect()


def test_arcs_are_numbered_without_gaps(spark):
    rows = talk(9)
    arcs = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), base=16).select("enter_arc", "exit_arc").collect()
    assert sorted(x for r in arcs for x in r) == list(range(2 * len(arcs)))
    assert all(r["enter_arc"] < r["exit_arc"] for r in arcs)


def test_query_against_its_statement(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    got = QUERIES["op12_conversation_trie"](spark, sf).select(COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.sql(ORACLE["op12_conversation_trie"]).fetchall()))
