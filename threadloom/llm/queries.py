"""The queries of this package, by name: (spark, folder of the tables) -> DataFrame; and their SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import dealt_out


def tokenizer(name: str) -> str:
    """Where a vocabulary file is; THREADLOOM_TOKENIZERS names another folder than that of the installed files."""
    if folder := os.environ.get("THREADLOOM_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return dealt_out(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import license_scan

    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import decontamination

    return decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10).drop("spans")


def op4_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .line_templates import deduplicated_lines

    found = deduplicated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.length("clean_text").cast("long").alias("n_chars_kept"), F.sha2("clean_text", 256).alias("clean_sha256"))


def op5_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .binary_records import read_records, write_records

    return read_records(write_records(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_dedup

    return near_dedup(table(spark, sf_dir, "documents"), width=3, percent=85)


def op10_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lz_fingerprint import lz_fingerprints

    return lz_fingerprints(table(spark, sf_dir, "documents"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import summarised, without_repeats

    return summarised(without_repeats(table(spark, sf_dir, "documents"), length=200))


def op12_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .importance import importance_sample

    return importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import looped, periodic_runs, summarised

    return summarised(periodic_runs(table(spark, sf_dir, "documents"), edit=looped))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL)
