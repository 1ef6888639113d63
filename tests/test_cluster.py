"""Queries that keep a table in the shared folder, on a master of several machines."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter

from __spark_entry__ import queries
from riskrank import session
from riskrank.session import cut_lineage, shared_dir, try_shared

#: Each needs the shared folder.
QUERIES = [
    "asof_timestamps",
    "base_rate_series",
    "baseline_models",
    "crosstab",
    "deep_tree_chain",
    "densify",
    "densify_many_values",
    "entity_ids",
    "event_ids",
    "fairness_disparity_tpr",
    "fairness_disparity",
    "feature_importance",
    "fit_grid",
    "fit_grid_many",
    "forest_order",
    "geo_demographics",
    "importance_matrix",
    "load_zip_density",
    "logistic_model",
    "metrics_at_k",
    "pr_curve",
    "pr_curve_int",
    "rank_baseline",
    "rank_baseline_asc",
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A few rows of every table these queries read."""
    folder, first = tmp_path_factory.mktemp("tables"), datetime(2024, 1, 1)
    kinds, statuses = ["view", "click", "purchase", "error", "signup"], ["F", "O", "P"]
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    texts = ["\n".join(["some words here"] * (1 + 7 * i % 120)) for i in range(40)]
    made = {
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"N{i}", i % 5) for i in range(5)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"C{i}", i % 5, 37.5 * i, segments[i % 5]) for i in range(1, 31)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
                     [(i, f"S{i}", i % 5, 10.0 * i) for i in range(1, 11)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
                   " o_orderpriority string",
                   [(i, 1 + i % 30, statuses[i % 3], 100.0 + i, datetime(1995, 1, 1) + timedelta(days=i), f"{i % 5}-X")
                    for i in range(90)]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp",
                     [(i % 90, i // 90, 1.0 + i % 9, "ANR"[i % 3], datetime(1995, 2, 1) + timedelta(days=i % 900))
                      for i in range(180)]),
        "events": ("event_id long, ts timestamp, user_id long, event_type string, value double",
                   [(i, first + timedelta(hours=3 * i), 1 + i * 7 % 29, kinds[i % 5], float(i % 101)) for i in range(400)]),
        "documents": ("doc_id long, text string, n_chars long", [(i, t, len(t)) for i, t in enumerate(texts)]),
        "labels": ("doc_id long, quality int", [(i, int(i % 3 == 0)) for i in range(30)]),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session, as one whose executors run on other machines."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    return spark


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_a_cluster_with_a_shared_mount(cluster, tables, name):
    assert shared_dir(cluster).startswith("file:")
    assert queries()[name](cluster, tables).count() > 0


def test_warehouse_where_no_checkpoint_folder_is_named(cluster, monkeypatch):
    context, named = cluster.sparkContext, []
    before, warehouse = context.getCheckpointDir(), cluster.conf.get("spark.sql.warehouse.dir")
    get = type(cluster.conf).get
    monkeypatch.setattr(type(cluster.conf), "get", lambda self, key, *default: (
        None if key == "spark.checkpoint.dir" else get(self, key, *default)))
    monkeypatch.setattr(context, "getCheckpointDir", lambda: named[-1] if named else None)
    monkeypatch.setattr(context, "setCheckpointDir", lambda folder: named.append(folder))
    try:
        assert cut_lineage(cluster.range(3)).count() == 3
        assert named == [f"{warehouse}/riskrank-scratch"]
    finally:
        monkeypatch.undo()
    assert context.getCheckpointDir() == before


def test_files_left_on_an_executor_are_no_shared_folder(cluster, monkeypatch, tmp_path):
    write = DataFrameWriter.parquet

    def lossy(self, path, *args, **options):
        write(self, path, *args, **options)
        min(Path(path.removeprefix("file:")).glob("part-*")).unlink()

    monkeypatch.setattr(DataFrameWriter, "parquet", lossy)
    with pytest.raises(RuntimeError, match="folder of one machine"):
        try_shared(cluster, f"file:{tmp_path}")


def test_shared_folder_is_tried_once(cluster, monkeypatch):
    tried = []
    monkeypatch.setattr(session, "_SHARED", set())
    monkeypatch.setattr(session, "try_shared", lambda spark, folder: tried.append(folder))
    assert [shared_dir(cluster), shared_dir(cluster)] == tried * 2
