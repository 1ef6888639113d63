"""Exact deduplication as a stateful stream.

Rows enter a stream as (digest, stable identifier, content locator).  A streaming aggregation keeps one state per
digest, on disk in RocksDB and without expiry: the identifier and locator of the row that stays, and the number of
rows seen.  Each map task first combines its rows of a digest, so a text that a third of all rows share reaches the
state as one row per task.  A hit is a digest seen before; the full bytes of all rows with one digest are compared,
equal ones being combined in the map tasks before any text is shuffled.  Digests that turn out to stand for several
texts (none for SHA-256, in practice) are split by the texts themselves.

Texts are equal if they are so after lower-casing A-Z; a null counts as empty.  Of equal texts the row with the
largest identifier stays; of rows that share that as well, the one whose locator (file and row) is last.  A null
identifier counts as the smallest.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskrank.llm.frames import keyed, located, rows_at
from riskrank.llm.text import LOWER, column
from riskrank.session import cut_lineage, scratch_path

#: State on disk.  Without preallocation a store takes the space of its rows, not 4 MB per partition at least.
_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(content: bytes) -> bytes:
    return hashlib.sha256(content).digest()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the start of a query, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _contents(texts) -> Iterator[bytes]:
    data, offsets = column(texts)
    raw, ends = LOWER[data].tobytes(), offsets.tolist()
    return (raw[a:b] for a, b in zip(ends, ends[1:], strict=False))


def _entries(rows: DataFrame, digest: Callable[[bytes], bytes]) -> DataFrame:
    """(id, file, row, digest) of every row, written once: what the stream reads."""
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([digest(c) for c in _contents(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("id", "file", "row")), keys],
                                             names=["id", "file", "row", "digest"])

    schema = T.StructType([rows.schema["id"], T.StructField("file", T.StringType()),
                           T.StructField("row", T.LongType()), T.StructField("digest", T.BinaryType())])
    return rows.mapInArrow(digests, schema)


def _drain(spark: SparkSession, feed: str, schema: T.StructType, files_per_batch: int) -> DataFrame:
    """Run the stream over all of `feed`; its final state, one row per digest."""
    state = scratch_path(spark, "state")
    kept = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(feed)
            .groupBy("digest").agg(F.max(F.struct("id", "file", "row")), F.count(F.lit(1))))
    with _settings(spark, _STATE_STORE):
        query = (kept.writeStream.outputMode("update").format("noop").trigger(availableNow=True)
                 .option("checkpointLocation", state).start())
        query.awaitTermination()
        final = spark.read.format("statestore").load(state)
        keeper, seen = [f"value.`{f.name}`" for f in final.schema["value"].dataType.fields][-2:]
        return cut_lineage(final.select(F.col("key.digest"), F.col(keeper).alias("keeper"), F.col(seen).alias("seen")))


def _ambiguous(rows: DataFrame, digest: Callable[[bytes], bytes]) -> DataFrame:
    """Digests that stand for more than one text, found by comparing full bytes."""
    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {(digest(c), c) for c in _contents(batch.column("text"))}
            keys, texts = zip(*seen, strict=True) if seen else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.binary())],
                                             names=["digest", "content"])

    return (rows.select("text").mapInArrow(contents, "digest binary, content binary")
            .groupBy("digest", "content").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest"))


def _split(rows: DataFrame, entries: DataFrame, digests: DataFrame) -> DataFrame:
    """Keepers and sizes of the rows with an ambiguous digest, by their full text."""
    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = pa.array(list(_contents(batch.column("text"))), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("row"), content],
                                             names=["file", "row", "content"])

    texts = (rows.select("file", "row", "text").mapInArrow(normal, "file string, row long, content binary")
             .join(entries.join(digests, "digest", "left_semi"), ["file", "row"]))
    keepers = texts.groupBy("digest", "content").agg(F.max(F.struct("id", "file", "row")).alias("keeper"),
                                                     F.count(F.lit(1)).alias("seen"))
    return texts.join(keepers, ["digest", "content"]).select("id", "file", "row", "digest", "keeper", "seen")


def dedup_exact(docs: DataFrame, digest: Callable[[bytes], bytes] = sha256, doc_id: str = "doc_id",
                text: str = "text", files_per_batch: int = 10_000) -> DataFrame:
    """One row per input row: `id`, its locator (`file`, `row`), `digest`, `keep_id`, `group_size` and `kept`.

    `digest` makes the state's key from the normalised bytes.  It may be weak: only full bytes decide.
    """
    docs = located(docs)
    spark = docs.sparkSession
    rows = keyed(docs, id=F.col(doc_id), text=F.col(text).cast("string"))
    feed = scratch_path(spark, "feed")
    _entries(rows, digest).write.parquet(feed)
    schema = _entries(rows, digest).schema
    entries = spark.read.schema(schema).parquet(feed)
    if entries.isEmpty():
        final = entries.select("digest", F.struct("id", "file", "row").alias("keeper"), F.lit(0).alias("seen"))
    else:
        final = _drain(spark, feed, schema, files_per_batch)
    judged = entries.join(final, "digest").select("id", "file", "row", "digest", "keeper", "seen")
    ambiguous = cut_lineage(_ambiguous(rows, digest))
    if not ambiguous.isEmpty():
        judged = (judged.join(ambiguous, "digest", "left_anti")
                  .unionByName(_split(rows, entries, ambiguous)))
    return judged.select("id", "file", "row", "digest", F.col("keeper.id").alias("keep_id"),
                         F.col("seen").cast("long").alias("group_size"),
                         (F.struct("file", "row") == F.struct("keeper.file", "keeper.row")).alias("kept"))


def drop_exact_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    docs = located(docs)
    return rows_at(docs, dedup_exact(docs, **options).filter("kept"))
