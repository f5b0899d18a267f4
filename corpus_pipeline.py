"""From raw documents to packed training windows.

Each stage takes (spark, docs, sf_dir) and returns the rows that the next one reads: the documents that the quality
classifier keeps, one document of each group of equal texts, one of each group of near copies, those without
benchmark items, and at last the packed token pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import decontamination, exact_dedup, ngram_join, packing, quality
from orderloom.session import stage

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("packing", pack),
]

# a trained classifier and a tokenizer are no SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``; every stage is written and read again.

    Documents without an identifier pass every filter. Null texts count as empty, and of equal ones a single document goes on.
    Rows that repeat an identifier with the same text are kept or dropped together. Stages up to the last return the columns of
    documents, whatever else stands in them. No documents give no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), f"corpus-{name}")
    return docs
