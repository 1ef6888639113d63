"""The registered queries against their SQL, and the pipeline's stages."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash

import corpus_pipeline
from check import TABLES, compare
from riskrank.llm.oracle import ORACLE
from riskrank.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_operators import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    note, ok = compare(spark, con, name, SF)
    assert ok, note


def test_contract():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "exact dedup", "near dedup", "mixing", "packing"]
    assert set(ORACLE) <= set(QUERIES) and {n.split("_")[0] for n in QUERIES} == {
        *(f"op{i}" for i in range(1, 14)), "pipeline"}


def stages(spark, docs):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        out.append(docs)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality, exact, near, mixed, packed = stages(spark, docs)
    for kept in (quality, exact, near, mixed):
        assert kept.columns == docs.columns and kept.schema == docs.schema
    all_rows = {r["doc_id"]: r for r in docs.collect()}
    first = {r["doc_id"]: r for r in quality.collect()}
    assert all(all_rows[i] == r for i, r in first.items()) and len(first) < len(all_rows)
    assert not any(brute.base_counts(r["text"])[-1] for r in first.values())
    groups = defaultdict(list)
    for i, r in first.items():
        groups[r["text"].translate(brute.FOLD)].append(i)
    second = {r["doc_id"]: r for r in exact.collect()}
    assert set(second) == {max(g) for g in groups.values()}
    ids = sorted(second)
    roots = brute.components([brute.fingerprint(second[i]["text"], xxhash.xxh64_intdigest) for i in ids], 3)
    third = {r["doc_id"]: r for r in near.collect()}
    assert set(third) == {ids[r] for r in roots}
    sizes = {i: len(brute.words(r["text"])) for i, r in third.items()}
    taken = Counter()
    for r in mixed.collect():
        taken[r["doc_id"]] += len(brute.words(r["text"]))
    assert all(n <= 3 * sizes[i] for i, n in taken.items()) and abs(sum(taken.values()) - sum(sizes.values())) < 30
    check_packing([dict(r.asDict(), sequence=r["sequence_id"]) for r in packed.collect()], 4096)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(taken)


def test_run(spark):
    one, two = (sorted(map(tuple, corpus_pipeline.run(spark, SF).select(
        "doc_id", "piece", "start", "length", "ids_crc32").collect())) for _ in range(2))
    assert one == two


@pytest.mark.parametrize("make", [brute.edge, brute.empty])
def test_awkward_tables(spark, make):
    table = make(spark)
    *kept, packed = stages(spark, table)
    assert all(k.columns == table.columns for k in kept)
    check_packing([dict(r.asDict(), sequence=r["sequence_id"]) for r in packed.collect()], 4096)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, table, SF)
        assert i == 4 or out.columns == table.columns
        out.count()
