"""A corpus made ready for training: language, near copies, benchmark passages, mixture, token ids.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs of the
next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import binary_records, decontamination, language_id, mixing, near_dedup
from threadloom.llm.common import cut
from threadloom.llm.queries import tokenizer

#: Stages learn from data and hash, so SQL cannot say their rows; tests hold them against plain versions.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches; null, letterless and far-off texts go."""
    return language_id.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return near_dedup.deduplicated(docs, width=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    return decontamination.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary shards; the rows tell what was read back from them."""
    return binary_records.read_records(binary_records.write_records(docs, tokenizer("word_bpe_49k.json"), end_id=1))


STAGES = [("language", language), ("near_copies", near_copies), ("benchmark_passages", benchmark_passages), ("mixture", mixture), ("token_ids", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if i == len(STAGES) - 1 else cut(docs, name)
    return docs
