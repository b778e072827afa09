"""Documents to token ids in five stages, each calling one operator.

Every stage takes all rows that its predecessor kept and returns the columns of
``documents``; the last returns token ids.  ``run`` writes each stage as a
Parquet table of the shared folder and reads it back for the next one, so a
lost executor never brings back an earlier stage.

1. quality_rules: rows that fail the counting rules or the classifier go.
2. simhash_near_dedup: of each class of near copies the row with the smallest
   doc_id stays (3-word shingles, at most 2 differing bits; rows without a
   doc_id come last).  Rows that repeat one doc_id and fingerprint are one
   document.
3. benchmark_decontamination: rows that hold a benchmark passage go.
4. secret_scans: reported spans are replaced by a mark, n_chars follows.
5. byte_level_bpe: token ids, and digests of the ids and of the bytes that they
   decode to.

Defined results: null texts fail stage 1; an empty table stays empty; columns
beyond those of ``documents`` pass through stages 1 to 4 unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayflow.llm import bpe, decontam, quality, secret_scan, simhash
from stayflow.llm.common import store, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.verdict("text", model))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, words=3, max_bits=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("byte_level_bpe", byte_level_bpe),
]

# SQL can express neither the trained classifier nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
