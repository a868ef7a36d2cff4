"""From raw documents to packed token sequences: the training-data operators as a chain of stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; its rows are written as Parquet into the shared folder and read again
as the next stage's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cytogrid.llm import host_rules, line_dedup, mixing, packing, simhash
from cytogrid.llm.common import shared_folder, table
from cytogrid.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and come from a host that does."""
    return host_rules.passing_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without passages of lines that stand elsewhere before; n_chars follows the text."""
    return line_dedup.dedup_lines(docs, length_col="n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.distinct_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in packed sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Token ids cannot be had in SQL; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
