"""From raw documents to packed training sequences: each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.llm import exact_dedup, mixing, packing, quality, simhash
from riskrank.llm.frames import free_name
from riskrank.llm.shipping import ship
from riskrank.session import delete_path, scratch_path, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the divergence rule, against references from all documents."""
    ship(spark)
    verdict = free_name(docs, "quality")
    return quality.judge_quality(docs).filter(F.col(verdict)["kept"]).drop(verdict)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    ship(spark)
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints within three bits connect: the one with the smallest id."""
    ship(spark)
    return simhash.drop_near_copies(docs, width=3, bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row per document and pass, so ids may repeat from here on."""
    ship(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the rows with their places in sequences of 4096 tokens."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: The mix draws pseudorandom permutations and the packing is a search: neither can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written to the shared folder before the next begins.

    A stage's own scratch tables go when its result is written, and its result when the next one's is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            delete_path(spark, before)
        before = path
    return docs
