"""Session settings, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "riskrank", **settings: str) -> SparkSession:
    """A session with adaptive execution on; `settings` override (dots as `__`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    wanted = dict(_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()})
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SCOPE: ContextVar[str | None] = ContextVar("scratch scope", default=None)


#: Folders of one machine's file system that were seen to be shared.
_SHARED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names, or else one in its warehouse: the driver and all executors share both.

    A mount that every machine has is a `file:` path too, so on a cluster such a folder
    is not refused but tried out.  A local master that names none (as in tests) gets a
    temporary folder.
    """
    sc = spark.sparkContext
    local = re.fullmatch(r"local(\[.*\])?", sc.master) is not None  # local-cluster[...] has executors of its own
    current = sc.getCheckpointDir()
    if not current:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and local:
            named = Path(tempfile.mkdtemp(prefix="riskrank-")).as_uri()
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/riskrank-scratch")
        current = sc.getCheckpointDir()
    if current.startswith("file:") and not local and current not in _SHARED:
        try_shared(spark, current)
        _SHARED.add(current)
    return current


def try_shared(spark: SparkSession, folder: str) -> None:
    """Raise unless what tasks write to the folder is there for the driver and for other tasks.

    Without this, files that executors left on disks of their own would only be missing from a table.
    """
    path, tasks = f"{folder}/probe-{uuid.uuid4().hex}", max(spark.sparkContext.defaultParallelism, 2)
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    found = spark.read.schema("id long").parquet(path).count()
    if found != tasks:
        raise RuntimeError(f"{folder} is a folder of one machine: {tasks - found} of {tasks} files of the executors are not"
                           " there; set spark.checkpoint.dir to a folder that all of them can reach")
    delete_path(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a table written and read once."""
    return f"{_SCOPE.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession):
    """A folder for the scratch tables made inside, deleted at the end: nothing that outlives it may read them."""
    folder = f"{shared_dir(spark)}/scope-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        delete_path(spark, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of a file system that Spark can reach, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it from there.

    Later stages and executors that replace lost ones reread the files, so values
    that need not repeat exactly (sampled range bounds, row positions) stay fixed.
    Columnar files let each reader fetch only its columns.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete what this session wrote to the shared folder, once its results are no longer read."""
    delete_path(spark, shared_dir(spark))


@contextmanager
def entity_partitioning(spark: SparkSession):
    """Let joins on (entity, split) reuse a partitioning by entity, for the actions inside.

    Cohorts, feature blocks and labels end up partitioned by entity, with at most one
    row per entity and split, so no partition can grow hot and the joins need no
    further shuffle.  The setting is put back, because elsewhere it could favour a
    partitioning by a skewed subset of the join keys.
    """
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def join_large(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join two sides that both grow with the entities: always sort-merge.

    Size estimates do not see the fan-out over splits, so without the hint Catalyst
    could broadcast a side many times larger than it believes.
    """
    return left.join(right.hint("merge"), list(keys), how)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast only when `rows * row_bytes` fits the session's threshold.

    `rows` must be an upper bound known before execution (for example the number
    of time splits).  Beyond the threshold there is no hint and Catalyst shuffles.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(df) if rows * row_bytes <= limit else df
