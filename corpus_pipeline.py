"""The training-data pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is written as
Parquet and read again before the next one. All but the last return the columns of the documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trendloom.llm.exact_dedup import drop_exact_copies  # noqa: E402
from trendloom.llm.jaccard_join import one_of_each_component  # noqa: E402
from trendloom.llm.language import keep_identified  # noqa: E402
from trendloom.llm.mixing import mix_documents  # noqa: E402
from trendloom.llm.packing import pack_documents, packing_digest  # noqa: E402
from trendloom.llm.shared import written  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts the one with the smallest id stays."""
    return one_of_each_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them."""
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing_digest(pack_documents(docs))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]

# SQL has no word for the language model and the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
