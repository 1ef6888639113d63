"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.session import cut_lineage

#: What the contracts call a word.
WORD = r"[^\x20\x09-\x0D]+"


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the decimal text of an id, modulo `divisor` (a null id: of the empty text)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % divisor


def text_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Number of rows and bytes of text: two numbers, by one aggregation."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text))).alias("b")).first()
    return row["n"], row["b"] or 0


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def record(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    """A batch of plain numpy or Python columns in the given schema."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type, from_pandas=False)
                                       for c, f in zip(columns, schema, strict=True)], schema=schema)


def place(docs: DataFrame) -> tuple[Column, Column]:
    """Where a row of scanned files lies: the file, and its number in it (whatever the columns are called)."""
    meta = docs.metadataColumn("_metadata")
    return meta["file_path"], meta["row_index"]


def located(docs: DataFrame) -> DataFrame:
    """`docs` as a scan of files, whose rows have a lasting place; anything else is written once first."""
    try:
        docs.select(*place(docs))
        return docs
    except AnalysisException:
        return cut_lineage(docs)


def keyed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The given columns of located `docs`, and the place of each row as `file` and `row`."""
    file, row = place(docs)
    return docs.select(*[c.alias(n) for n, c in columns.items()], file.alias("file"), row.alias("row"))


def rows_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of located `docs` at the given places (`file`, `row`), with all their columns."""
    names = docs.columns
    file, row = place(docs)
    placed = docs.select(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(names)], file.alias("file"),
                         row.alias("row"))
    kept = placed.join(places.select("file", "row"), ["file", "row"], "left_semi")
    return kept.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
