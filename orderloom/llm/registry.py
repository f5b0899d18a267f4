"""The corpus operators as registered queries over the given tables, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from orderloom.llm import (
    conversation_trie, decontamination, exact_dedup, html_extract, merkle, ngram_join, packing, phrase_dedup, pii, quality, sharding, simhash,
    suffix_dedup,
)
from orderloom.llm.oracle import CORPUS_ORACLE  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"))


def op2_phrase_dedup(spark, sf_dir):
    return phrase_dedup.remove_repeated_phrases(table(spark, sf_dir, "documents"))


def op3_html_extract(spark, sf_dir):
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op4_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), corpus_pipeline.tokenizer_path())


def op6_pii(spark, sf_dir):
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark, sf_dir):
    return decontamination.benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_conversation_trie(spark, sf_dir):
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest_proofs(table(spark, sf_dir, "documents"))


def op13_simhash(spark, sf_dir):
    return simhash.simhash_duplicates(table(spark, sf_dir, "documents"))


CORPUS_QUERIES = {
    build.__name__: build
    for build in (
        op1_suffix_dedup, op2_phrase_dedup, op3_html_extract, op4_ngram_join, op5_packing, op6_pii, op7_exact_dedup,
        op8_sharding, op9_quality, op10_decontamination, op11_conversation_trie, op12_merkle_manifest, op13_simhash,
    )
} | {"pipeline": corpus_pipeline.run}
