"""Documents to training sequences: quality, line rules, near duplicates, personal data, packing.

Every stage takes what the one before kept, reread from the table it wrote.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm import byte_bpe, line_rules, near_dedup, packing, pii, quality_fm
from tallyroll.llm.batches import kept_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the classifier accepts, fitted on the labels of these documents."""
    return quality_fm.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the rules keep, without the lines that fail."""
    return line_rules.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.without_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii.without_personal_data(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens, with their ids and a checksum of them."""
    tokenizer = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.packed(docs, tokenizer, window=packing.WINDOW).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", pack),
]

# A fitted model, minimum hashes and merges have no SQL form; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; a stage's table in the shared folder is the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
