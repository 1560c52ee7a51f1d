"""The training-data pipeline: quality, exact copies, near copies, mixing, packing.

Every stage works on all rows its predecessor kept, written as Parquet and read
again. The first four keep the columns of ``documents``; the mixing stage repeats
a document as often as the mix takes it. The last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmill.llm import exact_dedup, mixing, packing, quality, simhash
from feedmill.llm.queries import tokenizer_file
from feedmill.session import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of quality 1, learned from the labelled rows of ``docs``."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by SimHash."""
    return simhash.keep_one(docs, words=4, radius=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# the classifier and the tokenizer cannot be written in SQL; tests/llm checks the stages by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
