"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chunk_dedup, decontam, hmm, html_text, license_scan, prefix_trie, quality, secret_scan, sharding,
               simhash, suffix_dedup, turn_repair)
from .common import table
from .oracle import ORACLE as ORACLE

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=2)
    return found.select("doc_id", simhash.hex_digits(found.fp).alias("fingerprint"), "component_id")


@register
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@register
def op4_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


@register
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@register
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@register
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages))


@register
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@register
def op9_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), sharding.SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@register
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                          public_tokenizers.PATTERN)


@register
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.report(turn_repair.damage(table(spark, sf_dir, "conversations")))


@register
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.spliced(prefix_trie.marked(table(spark, sf_dir, "conversations"))))


@register
def op13_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.dedup(table(spark, sf_dir, "documents"))
