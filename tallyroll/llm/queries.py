"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyroll.llm import byte_bpe, licenses, line_rules, merkle, oracle_sql as sql, packing, pii, secret_scan
from tallyroll.llm.near_dedup import near_duplicates
from tallyroll.llm.prefix_trie import prefix_trie
from tallyroll.llm.quality_fm import quality_scores
from tallyroll.llm.resampling import resampled
from tallyroll.llm.token_counts import token_counts
from tallyroll.llm.warc import page_records


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.personal_data(_documents(spark, sf_dir)))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(byte_bpe.decoded(byte_bpe.encoded(_documents(spark, sf_dir), ranks), ranks))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_report(_documents(spark, sf_dir))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.checksums(packing.packed(_documents(spark, sf_dir), tokenizer, window=packing.WINDOW))


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_quality(_documents(spark, sf_dir))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = byte_bpe.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts(_documents(spark, sf_dir), model)


def op10_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(secret_scan.secrets(_documents(spark, sf_dir)))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("n_words")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": sql.PAGE_RECORDS,
        "op7_line_rules": sql.line_quality(line_rules.BOILERPLATE.pattern, line_rules.MOST_LOST),
        "op8_licenses": licenses.oracle_sql(),
        "op11_prefix_trie": sql.PREFIX_TRIE,
        "op12_secrets": sql.SECRETS,
        "op13_resampling": sql.RESAMPLING,
    }
