"""A corpus from raw documents to token files: rules, near-dedup, decontamination, mix, ids.

Every stage takes what its predecessor kept, whole. All but the last keep the columns of
``documents``. SQL can state neither the learned rules nor the tokenizer, so there is no
oracle; the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import decontaminate, mixing, neardup, quality, tokens
from shelfcast.session import stage

TOKENIZER = "word_bpe_49k.json"
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base counts and the rules learned from ``labels``."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.deduplicate(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of ``benchmark``; those that are nothing else go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens meet the target shares."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in plane files; what is read back from them, one row per document."""
    path = tokens.fresh_folder(spark)
    tokens.write(docs, path, public_tokenizers.path(TOKENIZER))
    return tokens.digests(tokens.read(spark, path))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token planes", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
