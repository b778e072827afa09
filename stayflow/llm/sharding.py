"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

The unit is a group of equal texts.  A group stays in one shard unless it is
larger than a shard's share in some dimension; then it is dealt into pieces by
doc_id.  Groups that hold more than a ``1 / HEAVY`` share of any total are
packed as they are (at most ``3 * HEAVY`` of them); the many others are summed
by a hash of their text into ``CELLS`` cells, which are packed like groups.
So the list that the driver packs is bounded whatever the input, and no cell
is more than a small fraction of a shard.

Packing goes from the largest vector down; each is placed in the shard where
the dot product with the residual capacity is highest, among the shards where
it still fits (all shards if it fits nowhere).

Defined results: a null text counts as the empty text (size 1).  Repeated rows
each take a slot.  Null doc_ids are one doc_id that sorts first.  An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, store

SHARDS = 16
HEAVY = 1024
CELLS = 16384
# Rows of one task when slots are numbered.
SLOT_ROWS = 100_000
DIMENSIONS = ("bytes", "tokens", "rows")


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each vector (rows are shares of the totals)."""
    capacity = np.full((shards, vectors.shape[1]), 1.0 / shards)
    place = np.zeros(len(vectors), np.int64)
    # Largest first; equal ones in their given order.
    for k in np.argsort(-vectors.max(axis=1), kind="stable"):
        v = vectors[k]
        score = capacity @ v
        fits = (capacity >= v).all(axis=1)
        if fits.any():
            score = np.where(fits, score, -np.inf)
        place[k] = int(score.argmax())
        capacity[place[k]] -= v
    return place


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row for each document: size and token count of its text, its
    checksum and a digest that stands for the text."""
    text = F.coalesce("text", F.lit(""))
    return id_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key"))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    spark = docs.sparkSession
    rows, _ = store(measured(docs, id_col, text_col), "measured")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    groups = rows.groupBy("key").agg(*sums)
    total = rows.agg(*sums).first()
    whole = [max(1, total[d] or 0) for d in DIMENSIONS]
    share = F.greatest(*(F.col(d) / F.lit(float(t)) for d, t in zip(DIMENSIONS, whole, strict=True)))
    # At most HEAVY groups for each dimension can hold that share of it.
    heavy = (groups.withColumn("share", share).where(F.col("share") > 1.0 / HEAVY)
             .select("key", F.when(F.col("share") > 1.0 / shards, F.ceil(F.col("share") * 2 * shards))
                     .otherwise(1).cast("int").alias("pieces")))
    cell = F.pmod(F.xxhash64("key"), F.lit(CELLS)).cast("string")
    item = F.when(F.col("pieces").isNull(), cell).otherwise(
        F.concat_ws("/", F.hex("key"), F.pmod(F.xxhash64("doc_id"), F.greatest("pieces", F.lit(1)))))
    named, _ = store(rows.join(F.broadcast(heavy), "key", "left").withColumn("item", item).drop("pieces"), "items")
    items = named.groupBy("item").agg(*sums).orderBy("item").collect()
    vectors = np.array([[r[d] / t for d, t in zip(DIMENSIONS, whole, strict=True)] for r in items]).reshape(-1, 3)
    place = pack(vectors, shards)
    where = spark.createDataFrame([(r["item"], int(p)) for r, p in zip(items, place, strict=True)],
                                  "item string, shard int")
    return slots(named.join(F.broadcast(where), "item"), shards, total["rows"])


def slots(placed: DataFrame, shards: int, rows: int) -> DataFrame:
    """Gapless numbers from 0 in each shard: a shard's rows are split by hash
    into parts of bounded size, numbered in each, and shifted by the rows of
    the parts before."""
    parts = max(1, -(-rows // (shards * SLOT_ROWS)))
    split = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "key"), F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = split.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "key")
    numbered = split.withColumn("n", F.row_number().over(within) - 1)
    return numbered.join(shift, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("n") + F.col("shift")).alias("slot"))
