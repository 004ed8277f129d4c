"""The corpus pipeline: stages over documents, each calling one operator of roadlake.llm.

Every stage takes what its predecessor kept, as it was written and read again, and returns the columns of documents;
the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadlake.llm import common, mixing, packing, quality_model, quality_rules, simhash


def labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What models learn from: all documents, whatever earlier stages kept, and their labels."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that score below 0.7 go."""
    return quality_model.keep_good(docs, quality_model.train(*labelled(spark, sf_dir)), 0.7)


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or meet a learned rule go."""
    return quality_rules.keep_good(docs, quality_rules.train(*labelled(spark, sf_dir)))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup over five-word shingles at a similarity of 0.8: the first document of each group stays."""
    return simhash.first_of_groups(docs, **simhash.SIMILAR)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: each document as often as the curriculum takes it, in training order."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 2048 tokens; one row per piece."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_classifier", classified), ("quality_rules", ruled), ("simhash_near_dedup", deduplicated), ("mixing", mixed), ("best_fit_packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else common.staged(docs), sf_dir)
    return docs


#: Models, XXH64 and a tokenizer can't be written in SQL.
ORACLE_SQL = None
