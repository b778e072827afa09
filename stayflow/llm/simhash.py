"""SimHash near-dedup by segment popcounts.

A fingerprint is embedded as the vector of set bits in each of its segments.
One differing bit moves one count by one, so the Manhattan distance of two
vectors is at most the bit distance of the fingerprints: a lower bound that
loses no pair.  Two vectors at distance 2 or less share a grid point at
distance 1 or less from each; every distinct fingerprint is therefore put on
its own grid point and the neighbouring ones, and fingerprints that meet on a
point are verified by their exact bit distance.

The grid has 16 segments of 4 bits (33 points for a fingerprint).  Points with
a few fingerprints compare them directly.  Fingerprints on a crowded point are
put on the finest grid, of 64 one-bit segments (65 points), where sharing a
point already proves a distance of 2 or less: there each is linked to the
point's smallest fingerprint, which joins the same components without making
all pairs.  No link is lost either way, and work grows with the number of
fingerprints whatever their crowding.

Defined results: null text or a text without words has fingerprint zero and is
linked like any other.  Repeated rows share a fingerprint.  A null doc_id takes
its class's smallest doc_id (null if the class has none).
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, map_rows, store
from .components import components

SEED = 42
MAX_BITS = 2
# Fingerprints on one grid point that are still compared pair by pair.
CROWDED = 64
FREQUENT = 1024
_BLOCK = 1 << 15

_ONES = 0x1111111111111111


def fingerprint(text: str, words: int = 3) -> int:
    """64-bit SimHash of the word shingles, as a signed integer."""
    found = text.encode().lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    last = ends[words - 1:] or [ends[-1]]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(last), _BLOCK):
        h = np.array([digest(line[s:e - 1], SEED) for s, e in
                      zip(starts[at:at + _BLOCK], last[at:at + _BLOCK], strict=False)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(last), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long) of every row."""
    def make():
        return lambda doc, text: (doc, fingerprint(text or "", words))
    return map_rows(id_text(docs, id_col, text_col), make, "doc_id long, fp long")


def segment_counts(fp: Column) -> Column:
    """Set bits of each 4-bit segment plus one, packed into 16 nibbles (the
    one keeps neighbours of an empty segment from borrowing)."""
    ones = F.lit(_ONES)
    planes = [F.shiftrightunsigned(fp, k).bitwiseAND(ones) for k in range(4)]
    return planes[0] + planes[1] + planes[2] + planes[3] + ones


def grid_points(fp: Column) -> Column:
    """The grid point of a fingerprint and its 32 neighbours."""
    point = segment_counts(fp)
    steps = [1 << (4 * k) for k in range(16)]
    return F.array(point, *(point + F.lit(s) for s in steps), *(point - F.lit(s) for s in steps))


def bit_points(fp: Column) -> Column:
    """The finest grid: the fingerprint and those at one bit from it."""
    flips = [F.lit(1 << k if k < 63 else -(1 << 63)) for k in range(64)]
    return F.array(fp, *(fp.bitwiseXOR(b) for b in flips))


def bit_distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` at ``max_bits`` or
    fewer differing bits: all of them, except that fingerprints of crowded
    points may be linked through a third one."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the grid links fingerprints at 0 to 2 differing bits")
    near = bit_distance(F.col("a"), F.col("b")) <= max_bits
    points = distinct.select("fp", F.explode(grid_points(F.col("fp"))).alias("point"))
    shared = points.groupBy("point").agg(F.count("*").alias("n"), F.min("fp").alias("a"),
                                         F.max("fp").alias("b")).where("n > 1")
    two = shared.where("n = 2").select("a", "b").where(near)
    met, _ = store(points.join(shared.where("n > 2").select("point", "n"), "point"), "points")
    few = met.where(F.col("n") <= crowded).select("point", "fp")
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "point")
             .where((F.col("a") < F.col("b")) & near).select("a", "b"))
    many = met.where(F.col("n") > crowded).select("fp").distinct()
    if max_bits == 2:
        fine = many.select("fp", F.explode(bit_points(F.col("fp"))).alias("point"))
        hubs = fine.groupBy("point").agg(F.count("*").alias("n"), F.min("fp").alias("a")).where("n > 1")
        stars = (fine.join(hubs.select("point", "a"), "point").select("a", F.col("fp").alias("b"))
                 .where("a != b"))
    else:
        # One bit at most: each fingerprint probes its one-bit neighbours.
        fine = many.select(F.col("fp").alias("a"), F.explode(bit_points(F.col("fp"))).alias("b"))
        stars = fine.join(many.withColumnRenamed("fp", "b"), "b").select("a", "b").where((F.col("a") < F.col("b")) & near)
    return two.union(pairs).union(stars).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text", crowded: int = CROWDED) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links) and
    root (the smallest fingerprint reachable)."""
    prints, _ = store(fingerprints(docs, words, id_col, text_col), "fingerprints")
    first, _ = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "first")
    of = components(links(first.select("fp"), max_bits, crowded))
    linked = first.join(of.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("smallest"))
    named = linked.join(smallest, "root").select("fp", "smallest", "root")
    classes, _ = store(first.join(named, "fp", "left").select(
        "fp", "n", F.coalesce("smallest", "first").alias("component_id"), F.coalesce("root", "fp").alias("root")), "classes")
    # Fingerprints with more than 1 / FREQUENT of all rows (fewer than FREQUENT
    # of them) are joined by broadcast, so that none fills one task.
    frequent = F.col("n") * FREQUENT > F.lit(prints.count())
    columns = ["doc_id", "fp", "component_id", "root"]
    common = classes.where(frequent)
    rest = prints.join(F.broadcast(common.select("fp")), "fp", "left_anti")
    return (rest.join(classes.where(~frequent), "fp").select(*columns)
            .union(prints.join(F.broadcast(common), "fp").select(*columns)))


def one_of_each(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id (rows
    without one come last, then by fingerprint; of rows that agree in both, the
    smallest text)."""
    found = near_duplicates(docs, words, max_bits, id_col, text_col)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("fp"))
    best = found.groupBy("root").agg(F.min(rank).alias("best")).select("best.doc_id", "best.fp")
    name = lambda doc, fp: F.concat_ws("/", F.coalesce(doc.cast("string"), F.lit("")), fp.cast("string"))
    keep = best.select(name(F.col("doc_id"), F.col("fp")).alias("row"))
    fp = F.pandas_udf(lambda s: s.map(lambda t: fingerprint(t or "", words)), "long")
    # The whole row travels as one struct: its column names cannot clash.
    mine = docs.select(F.struct("*").alias("doc"), F.col(text_col).cast("string").alias("text"),
                       name(F.col(id_col).cast("long"), fp(F.col(text_col))).alias("row"))
    first = Window.partitionBy("row").orderBy("text")
    return (mine.join(keep.hint("merge"), "row", "left_semi").withColumn("place", F.row_number().over(first))
            .where("place = 1").select("doc.*"))


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
