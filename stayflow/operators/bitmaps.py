"""Exact distinct counts that can be stored and rolled up.

A rate per (year, state, sex) cannot be summed to a rate per state: a claim that
falls in two of the groups would count twice.  Here each group keeps the set of
its claims as bitmaps, so any coarser grouping is a union (``bitmap_or_agg``) and a
count of bits, exact, without the claims being read again.

Claims get numbers first.  They are numbered in the order of a group they fall in, so a
group's numbers lie together: its bitmaps are dense, and few.  A bitmap
covers 32,768 numbers (4 KB) at most.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

NUMBER, BUCKET = "claim_no", "bucket"
SEEN, HIT = "claims_bitmap", "flagged_bitmap"


def number_claims(pairs: DataFrame, claim: str, keys: Sequence[str]) -> DataFrame:
    """A number from 0 up for each known claim of ``pairs``: claim, claim_no.

    Range partitions of (least group, claim), numbered within each partition;
    a partition's numbers follow each other, partitions lie 2^33 apart.  Stored, so
    that the numbers stay what they are.
    """
    first = pairs.where(F.col(claim).isNotNull()).groupBy(claim).agg(*[F.min(k).alias(k) for k in keys])
    order = [*(F.col(k).asc_nulls_last() for k in keys), F.col(claim)]
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = first.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return materialize(placed.select(claim, F.monotonically_increasing_id().alias(NUMBER)), "claim-numbers")


def claim_bitmaps(pairs: DataFrame, numbers: DataFrame, claim: str, keys: Sequence[str], hit: Column | str) -> DataFrame:
    """keys, bucket, the bitmap of the group's claims and that of those for
    which ``hit`` is true.  Claims without a number only make their group exist
    (bucket NULL).

    The rows move once, to the task of their (group, bucket), at most 32,768
    of them to each; built before the shuffle, a bitmap with one bit would weigh as
    much as a full one.
    """
    hit = F.col(hit) if isinstance(hit, str) else hit
    at = F.bitmap_bit_position(F.col(NUMBER))
    numbered = (pairs.join(numbers, claim, "left")
                     .select(*keys, F.bitmap_bucket_number(F.col(NUMBER)).alias(BUCKET), at.alias("__at"),
                             F.when(hit, at).alias("__hit")))
    placed = numbered.repartition(*keys, BUCKET)
    return placed.groupBy(*keys, BUCKET).agg(F.bitmap_construct_agg("__at").alias(SEEN),
                                             F.bitmap_construct_agg("__hit").alias(HIT))


def rolled_up(bitmaps: DataFrame, by: Sequence[str], n: str = "total_admissions", hits: str = "readmissions") -> DataFrame:
    """Distinct claims and flagged claims per ``by`` (any of the keys, or
    none for the whole): a union of each bucket's bitmaps, then a count of bits."""
    merged = bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(SEEN).alias(SEEN), F.bitmap_or_agg(HIT).alias(HIT))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count(HIT)).alias(hits), F.sum(F.bitmap_count(SEEN)).alias(n))


def settled(pairs: DataFrame, keys: Sequence[str], claim: str) -> DataFrame:
    """The (claim, group) pairs that ``rates.counted`` counts, from the stored
    output of ``rates.claim_pairs``: without planned claims, by the rules of NOT
    IN (read off the stored pairs)."""
    null = F.col(claim).isNull()
    facts = pairs.agg(F.struct(F.count_if(F.col("__p")).alias("n"),
                               F.count_if(F.col("__p") & null).alias("n_null"))).scalar()
    kept = F.col("__in") & ~F.col("__p") & (facts.getField("n_null") == 0) & (~null | (facts.getField("n") == 0))
    return pairs.where(kept).select(claim, *keys, "__f")


def rate_bitmaps(pairs: DataFrame, keys: Sequence[str], claim: str) -> DataFrame:
    """The stored form of a rate: bitmaps of the pairs of ``rates.episode_pairs``."""
    stored = settled(materialize(pairs, "claim-pairs"), keys, claim)
    return materialize(claim_bitmaps(stored, number_claims(stored, claim, keys), claim, keys, "__f"), "rate-bitmaps")


