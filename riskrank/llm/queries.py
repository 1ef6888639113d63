"""The queries of this subpackage over the supplied tables: `op<N>_<name>`, and `pipeline`."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import wraps

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.llm import (exact_dedup, langid, mixing, packing, phrases, prefix_trie, quality, simhash, substrings,
                          suffix_tree, suffixes, token_counts, url_filter)
from riskrank.llm.frames import remainder
from riskrank.llm.shipping import ship

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/")]


def _table(name: str) -> Callable:
    """Make a query of (spark, sf_dir) from a function of one table."""
    def wrap(query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        return run

    return wrap


@_table("documents")
def quality_rules(docs: DataFrame) -> DataFrame:
    references = quality.language_references(docs)
    judged = quality.judge_quality(docs.select("doc_id", "text"), references)
    return judged.select("doc_id", "quality.*")


@_table("documents")
def repeats(docs: DataFrame) -> DataFrame:
    return (substrings.remove_repeats(docs, width=20).withColumnRenamed("id", "doc_id")
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


@_table("documents")
def near(docs: DataFrame) -> DataFrame:
    found = simhash.near_duplicates(docs, width=3, bits=3)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


@_table("documents")
def tree_scores(docs: DataFrame) -> DataFrame:
    def learns(doc_id: int | None) -> bool:
        return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 != 1

    return suffix_tree.score_documents(docs, learns).withColumnRenamed("id", "doc_id")


@_table("documents")
def exact(docs: DataFrame) -> DataFrame:
    return exact_dedup.dedup_exact(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@_table("documents")
def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)


@_table("documents")
def mixed(docs: DataFrame) -> DataFrame:
    return mixing.taken_words(mixing.mix_sources(docs)).withColumnRenamed("id", "doc_id")


@_table("documents")
def repeated_bytes(docs: DataFrame) -> DataFrame:
    return (suffixes.remove_repeated_bytes(docs, width=200).withColumnRenamed("id", "doc_id")
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


@_table("documents")
def language(docs: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 4) == 2
    training = langid.Training()
    model = langid.train(*langid.labelled_sample(docs.filter(~held_out).select("doc_id", "text", "lang"), training),
                         training)
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select(
        "doc_id", "held_out", F.col("language.lang").alias("lang_pred"), "language.score", "language.rejected")


@_table("pages")
def url_rules(pages: DataFrame) -> DataFrame:
    return url_filter.filter_urls(pages.select("page_id", "url"), URL_RULES).select("page_id", "url_verdict.*")


@_table("documents")
def token_numbers(docs: DataFrame) -> DataFrame:
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)
    return counted.withColumnRenamed("id", "doc_id")


@_table("conversations")
def conversation_nodes(conversations: DataFrame) -> DataFrame:
    return prefix_trie.prefix_trie(conversations).drop("enter_arc", "exit_arc")


@_table("documents")
def collocations(docs: DataFrame) -> DataFrame:
    return phrases.mine_phrases(docs)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_divergence": quality_rules,
    "op2_window_dedup": repeats,
    "op3_simhash_pivots": near,
    "op4_suffix_tree": tree_scores,
    "op5_streaming_exact_dedup": exact,
    "op6_genetic_packing": packed,
    "op7_source_mixing": mixed,
    "op8_bucket_pointer_dedup": repeated_bytes,
    "op9_language_id": language,
    "op10_url_trie": url_rules,
    "op11_token_counts": token_numbers,
    "op12_conversation_trie": conversation_nodes,
    "op13_phrase_collocations": collocations,
    "pipeline": corpus_pipeline.run,
}
