"""Exact dedup by recipes of content-defined chunks.

Every text is cut where a rolling hash of its last bytes says so, so equal texts
are cut alike.  A chunk's identifier is its 64-bit hash; a text's recipe is the
ordered list of its chunks' identifiers.  Identifiers are verified: the chunks'
bytes are deduplicated once by (identifier, bytes), and where one identifier
stands for several byte strings, recipes that hold it also name which of them
stands where.  Texts are equal exactly when their recipes are, so from then on
only recipes move (some bytes for each kB of text), never a long text again.

The cut texts are written once as a table of the shared folder.  From it, chunk
bytes are shuffled once, with equal chunks combined before the shuffle; recipes
are grouped with partial aggregation.  Groups that hold more than 1 / FREQUENT of
all rows are joined back by broadcast: there are fewer than FREQUENT, and as each
has that many rows, their recipes together are no longer than FREQUENT times the
mean recipe.

Defined results: a null text counts as empty (the empty recipe).  Of equal texts
the row with the largest doc_id stays, null doc_ids coming last; of rows that
repeat that doc_id one stays.  keep_id is null if no row of the group has a doc_id.
Very long texts are cut like others; a chunk has at most MOST bytes.  An empty table
gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROWS, id_text, sha256, store

# Bytes that the rolling hash sees; a cut follows on average each 2 ** BITS
# bytes.  No chunk but a text's last is shorter than LEAST, so the bytes before
# a text in its batch never reach a hash that decides.
WINDOW, BITS, LEAST, MOST = 32, 11, 512, 1 << 16
# Bytes hashed at a time, and bytes of one output batch.
STEP, BATCH = 1 << 20, 1 << 24
FREQUENT = 1024


def byte_values() -> np.ndarray:
    """A fixed 32-bit number for each byte, by a mixing rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


VALUES = byte_values()


def borders(data: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions after which the content asks for a cut: the rolling hash of
    the last WINDOW bytes (newest byte unshifted) begins with zeros.  Windows
    double in length, so a byte costs log2(WINDOW) additions."""
    found = [np.zeros(0, np.int64)]
    for at in range(0, len(data), STEP):
        lead = min(at, WINDOW - 1)
        h = VALUES[data[at - lead:at + STEP]]
        w = 1
        while w < min(WINDOW, len(h)):
            h[w:] += h[:-w] << np.uint32(w)
            w *= 2
        found.append(np.flatnonzero(h[lead:] >> np.uint32(32 - bits) == 0) + at)
    return np.concatenate(found)


def ends(cuts: list[int], start: int, end: int, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of one text: the first asked-for cut at least
    ``least`` bytes after the last one, at most ``most`` bytes after it."""
    out, at = [], start
    k = bisect_left(cuts, start + least - 1)
    while end - at > least:
        while k < len(cuts) and cuts[k] + 1 < at + least:
            k += 1
        at = min(cuts[k] + 1 if k < len(cuts) else end, at + most, end)
        out.append(at)
    if at < end:
        out.append(end)
    return out


CUT = "doc_id long, text_sha256 string, ids array<long>, chunks array<binary>"
ARROW = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("ids", pa.list_(pa.int64())),
                   ("chunks", pa.list_(pa.binary()))])


def identifier(chunk: bytes) -> int:
    x = xxhash.xxh64_intdigest(chunk)
    return x - 2 ** 64 if x >> 63 else x


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, least: int = LEAST,
        most: int = MOST, name: Callable[[bytes], int] = identifier) -> DataFrame:
    """doc_id, text_sha256, ids and chunks of every row."""
    if least < WINDOW:
        raise ValueError(f"least must be at least {WINDOW}")

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*rows, strict=True), ARROW,
                                                                                      strict=True)], schema=ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if not rb.num_rows:
                continue
            docs_, texts = rb.column(0).to_pylist(), rb.column(1)
            _, offsets, values = texts.buffers()
            at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].tolist()
            whole = memoryview(values or b"")[at[0]:at[-1]]
            asked = (borders(np.frombuffer(whole, np.uint8), bits) + at[0]).tolist()
            rows, held = [], 0
            for k, doc in enumerate(docs_):
                text = bytes(whole[at[k] - at[0]:at[k + 1] - at[0]])
                parts, last = [], at[k]
                for e in ends(asked, at[k], at[k + 1], least, most):
                    parts.append(text[last - at[k]:e - at[k]])
                    last = e
                rows.append((doc, sha256(text), [name(p) for p in parts], parts))
                held += len(text)
                if len(rows) >= ROWS or held >= BATCH:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return id_text(docs, id_col, text_col).select("doc_id", text.alias("text")).mapInArrow(run, CUT)


def pieces(cut_texts: DataFrame, *with_: str) -> DataFrame:
    """One row for each chunk of each text: pos, id, data."""
    return (cut_texts.select(*with_, F.posexplode(F.arrays_zip("ids", "chunks")).alias("pos", "c"))
            .select(*with_, "pos", F.col("c.ids").alias("id"), F.col("c.chunks").alias("data")))


def chunk_table(cut_texts: DataFrame) -> DataFrame:
    """The distinct chunks: id, data."""
    return pieces(cut_texts).select("id", "data").distinct()


def verified(cut_texts: DataFrame) -> DataFrame:
    """uid, doc_id, text_sha256, ids, which: the recipes.  ``which`` is null, or
    names the byte string of each chunk whose identifier several share."""
    recipes = cut_texts.select("uid", "doc_id", "text_sha256", "ids")
    shared, _ = store(chunk_table(cut_texts).groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"),
                      "shared-ids")
    kind = "array<struct<pos:int,no:int>>"
    if shared.isEmpty():
        return recipes.withColumn("which", F.lit(None).cast(kind))
    one = Window.partitionBy("id").orderBy("data")
    numbered, _ = store(chunk_table(cut_texts).join(shared, "id").withColumn("no", F.row_number().over(one)),
                        "shared-chunks")
    held = (pieces(cut_texts, "uid").join(numbered, ["id", "data"]).groupBy("uid")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "no"))).alias("which")))
    return recipes.join(held.withColumn("which", F.col("which").cast(kind)), "uid", "left")


def same(names: list[str], a: DataFrame, b: DataFrame) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & a[n].eqNullSafe(b[n])
    return on


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.  ``how``:
    see ``cut``."""
    cut_texts, _ = store(cut(docs, id_col, text_col, **how).withColumn("uid", F.monotonically_increasing_id()), "cut")
    recipes = verified(cut_texts)
    key = ["ids", "which"]
    # Of structs the larger is that with the larger doc_id, null being least.
    groups, _ = store(recipes.groupBy(*key).agg(F.count("*").alias("group_size"),
                                                F.max(F.struct("doc_id", "uid")).alias("best")), "groups")
    frequent = F.col("group_size") * FREQUENT > F.lit(cut_texts.count())
    some = groups.where(frequent)
    left = recipes.alias("r").join(F.broadcast(some), same(key, recipes, some), "left_anti").select("r.*")
    many = groups.where(~frequent)
    found = ["doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("uid") == F.col("best.uid")).alias("kept"),
             "text_sha256"]
    cols = [recipes[c] for c in ("uid", "doc_id", "text_sha256")] + ["group_size", "best"]
    rest = [left[c] for c in ("uid", "doc_id", "text_sha256")] + ["group_size", "best"]
    return (left.join(many, same(key, left, many)).select(*rest).select(*found)
            .union(recipes.join(F.broadcast(some), same(key, recipes, some)).select(*cols).select(*found)))
