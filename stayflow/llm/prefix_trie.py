"""The trie of conversation prefixes by truncation peeling.

A node is a distinct sequence of first turns; its members are the conversations
that begin with it.  The deepest conversations come first: at each depth those that
end there are merged with the nodes that survive from below, the last turn is
stripped and what is left is regrouped by the remaining sequence, so that a node is
discovered, counted and given to its parent in one pass.

A turn moves as the digest of its role and text; a prefix is named by the chained
digest of its turns, which one task computes for each conversation by streaming its
sorted turns, and stores in bands of BAND depths.  Equal conversations become one
element (their ids, in order, are streamed into a digest); only elements are
peeled.  Bands are peeled from the deepest up.  In a band, subtrees of at most LIMIT
stored keys are peeled each within one task, and what stands above them level by level,
as grouped sums that combine before their shuffle: a first turn that all
conversations share meets no single task.  Rounds number the deepest conversation's
turns / BAND, and the depth at which the last subtree falls under LIMIT.

Defined results: turns are in order of turn, null first; ties by digest.  A null role
or text is empty.  A null conv_id is one conversation; it counts, is no smallest
member where there is another, and stands first, as empty text, among the ends.
Repeated rows are turns of their own.  Very long texts are read once, for their digest.
An empty table has no nodes; columns beside the four are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, runs, sha256, store

# Depths whose keys a row holds; stored keys that one task peels at most.
BAND, LIMIT = 4096, 200_000
FREQUENT = 1024
ROOT = bytes(16)
NO_ENDS = sha256(b"")

CHAIN = "conv_id long, band long, base binary, keys array<binary>, bytes array<long>, depth long, last boolean"
CHAIN_ARROW = pa.schema([("conv_id", pa.int64()), ("band", pa.int64()), ("base", pa.binary()), ("keys", pa.list_(pa.binary())),
                         ("bytes", pa.list_(pa.int64())), ("depth", pa.int64()), ("last", pa.bool_())])
ENDS = "key binary, depth long, band long, n long, conv_id long, ends string"
ENDS_ARROW = pa.schema([("key", pa.binary()), ("depth", pa.int64()), ("band", pa.int64()), ("n", pa.int64()),
                        ("conv_id", pa.int64()), ("ends", pa.string())])
# Found nodes, and (``up``) what a peeled subtree gives to the node above it.
FOUND = ("up boolean, key binary, parent binary, depth long, conv_id long, parent_conv_id long, known boolean, n long, "
         "children long, leaves long, saved long, ends string, base binary, keys array<binary>, bytes array<long>")
FOUND_ARROW = pa.schema([
    ("up", pa.bool_()), ("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("known", pa.bool_()), ("n", pa.int64()), ("children", pa.int64()),
    ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()), ("base", pa.binary()),
    ("keys", pa.list_(pa.binary())), ("bytes", pa.list_(pa.int64()))])


def marked(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, said (digest of role and text), bytes (of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role), role, text), 256))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.substring(digest, 1, 16).alias("said"), F.octet_length(text).cast("long").alias("bytes"))


def smallest(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def chains(turns: DataFrame, ids: DataFrame, band: int = BAND) -> DataFrame:
    """Prefix keys of every conversation of ``ids``, in bands."""
    rows = ids.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                      F.lit(None).cast("binary").alias("said"), F.lit(0).cast("long").alias("bytes")).unionByName(
        turns.select("conv_id", F.lit(1).alias("kind"), "turn", "said", "bytes"))

    def chained(conv: int | None, mine: Iterable[tuple]) -> Iterator[tuple]:
        key = base = ROOT
        keys, sizes, depth, k = [], [], 0, 0
        for _, kind, _, said, size in mine:
            if not kind:
                continue
            if len(keys) == band:
                yield conv, k, base, keys, sizes, depth, False
                base, keys, sizes, k = key, [], [], k + 1
            key = hashlib.blake2b(key + said, digest_size=16).digest()
            keys.append(key)
            sizes.append(size)
            depth += 1
        yield conv, k, base, keys, sizes, depth, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((r for conv, mine in runs(batches) for r in chained(conv, mine)), CHAIN_ARROW)
    in_order = [F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "said"]
    return rows.repartition("conv_id").sortWithinPartitions(*in_order).mapInArrow(run, CHAIN)


def elements(chain: DataFrame) -> DataFrame:
    """Equal conversations together: their number, smallest id and the digest
    of all their ids, streamed in order."""
    last = F.when(F.size("keys") > 0, F.element_at("keys", -1)).otherwise(F.col("base"))
    ended = chain.where("last").select(last.alias("key"), "depth", "band", "conv_id")

    def one(key: bytes, rows: Iterable[tuple]) -> tuple:
        digest, n, least = hashlib.sha256(), 0, None
        for _, depth, band, conv in rows:
            digest.update(b"," * (n > 0) + (b"" if conv is None else str(conv).encode()))
            n, least = n + 1, smallest(least, conv)
        return key, depth, band, n, least, digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((one(key, rows) for key, rows in runs(batches)), ENDS_ARROW)
    return (ended.repartition("key").sortWithinPartitions("key", F.col("conv_id").asc_nulls_first())
            .mapInArrow(run, ENDS))


def peeled(rows: Iterable[tuple], low: int, floor: int) -> Iterator[tuple]:
    """Rows of FOUND of one subtree: elements (group, base, keys, bytes, depth, n,
    conv_id, children, leaves, saved, ends) that share the prefix of depth
    ``floor``; ``low`` is the depth of ``base``."""
    by_end = defaultdict(list)
    for r in rows:
        by_end[r[4]].append(r)

    def merge(level: dict, key: bytes, n: int, conv: int | None, children: int, leaves: int, saved: int,
              ends: str | None, r: tuple) -> None:
        node = level.get(key)
        if node is None:
            level[key] = [n, conv, children, leaves, saved, ends, r]
            return
        node[0] += n
        node[1] = smallest(node[1], conv)
        node[2] += children
        node[3] += leaves
        node[4] += saved
        node[5] = ends or node[5]

    level: dict[bytes, list] = {}
    waiting: list[tuple] = []
    for depth in range(max(by_end), floor - 1, -1):
        at = depth - low
        if depth > floor:
            for r in by_end.get(depth, ()):
                merge(level, r[2][at - 1], *r[5:], r)
        # Nodes of the depth below now know their parents' smallest member.
        for key, parent, (n, conv, children, leaves, saved, ends, _) in waiting:
            of, known = (level[parent][1], True) if depth > floor else (None, False)
            yield (False, key, parent, depth + 1, conv, of, known, n, children, leaves, saved, ends or NO_ENDS, None, None, None)
        if depth == floor:
            break
        waiting, above = [], {}
        for key, node in level.items():
            r = node[6]
            node[3] = node[3] if node[2] else 1
            node[4] += (node[0] - 1) * r[3][at - 1]
            parent = r[2][at - 2] if at > 1 else r[1]
            waiting.append((key, parent, node))
            merge(above, parent, node[0], node[1], 1, node[3], node[4], None, r)
        level = above
    for key, (n, conv, children, leaves, saved, _, r) in level.items():
        yield (True, key, None, floor, conv, None, False, n, children, leaves, saved, None, r[1], r[2][:floor - low],
               r[3][:floor - low])


def peel_subtrees(rows: DataFrame, low: int, floor: int) -> DataFrame:
    group = F.col("base") if floor == low else F.element_at("keys", floor - low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((f for _, mine in runs(batches) for f in peeled(mine, low, floor)), FOUND_ARROW)
    cols = [group.alias("group"), "base", "keys", "bytes", "depth", "n", "conv_id", "children", "leaves", "saved", "ends"]
    return rows.select(*cols).repartition("group").sortWithinPartitions("group").mapInArrow(run, FOUND)


def sums() -> list[Column]:
    """Of what one node is given; its keys are the same in all of it."""
    return [F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.sum("children").alias("children"),
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"),
            F.first("base").alias("base"), F.first("keys").alias("keys"), F.first("bytes").alias("bytes")]


GIVEN = ["key", "n", "conv_id", "children", "leaves", "saved", "ends", "base", "keys", "bytes"]


def last_key() -> Column:
    return F.when(F.size("keys") > 0, F.element_at("keys", -1)).otherwise(F.col("base"))


def peel_level(given: DataFrame, depth: int) -> DataFrame:
    """Nodes of one depth, from what subtrees below give and elements ending
    there: rows of FOUND with their keys."""
    nodes = given.groupBy("key").agg(*sums())
    n = F.size("keys")
    parent = F.when(n > 1, F.try_element_at("keys", F.lit(-2))).when(n == 1, F.col("base"))
    size = F.when(n > 0, F.element_at("bytes", -1)).otherwise(F.lit(0))
    return nodes.select(
        F.lit(False).alias("up"), "key", parent.alias("parent"), F.lit(depth).cast("long").alias("depth"), "conv_id",
        F.lit(None).cast("long").alias("parent_conv_id"), (n == 0).alias("known"), "n", "children",
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * size).cast("long").alias("saved"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"), "base", "keys", "bytes")


def given_up(nodes: DataFrame) -> DataFrame:
    """What the nodes of a depth give to their parents."""
    cut = lambda c: F.slice(c, 1, F.size(c) - 1).alias(c)
    return nodes.select(F.col("parent").alias("key"), "n", "conv_id", F.lit(1).cast("long").alias("children"), "leaves", "saved",
                        F.lit(None).cast("string").alias("ends"), "base", cut("keys"), cut("bytes"))


def floor_of(rows: DataFrame, low: int, limit: int) -> int:
    """The least depth whose subtrees hold at most ``limit`` stored keys."""
    if (rows.agg(F.sum(F.size("keys"))).first()[0] or 0) <= limit:
        return low
    through = rows.select(F.size("keys").alias("w"), F.posexplode("keys").alias("at", "key"))
    deepest = through.groupBy("at", "key").agg(F.sum("w").alias("w")).where(F.col("w") > limit).agg(F.max("at")).first()[0]
    return low + 1 + (0 if deepest is None else deepest + 1)


def trie(turns: DataFrame, ids: DataFrame | None = None, band: int = BAND, limit: int = LIMIT) -> DataFrame:
    """One row for each node, from rows of ``marked``; ``ids`` names the
    conversations (with or without turns), if not those of ``turns``."""
    spark = turns.sparkSession
    ids = (turns if ids is None else ids).select("conv_id").distinct()
    chain, _ = store(chains(turns, ids, band), "chains")
    ended, _ = store(elements(chain), "elements")
    top = chain.agg(F.max("band")).first()[0]
    if top is None:
        return spark.createDataFrame([], NODE)
    found: list[DataFrame] = []
    parents = F.lit(False)
    below = None
    none = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    for k in range(top, -1, -1):
        low = k * band
        mine = ended.where(F.col("band") == k).select("conv_id", "depth", "n", *none, "ends")
        if below is not None:
            mine = mine.unionByName(below.select("conv_id", F.lit(low + band).cast("long").alias("depth"), "n", "children",
                                                 "leaves", "saved", F.lit(None).cast("string").alias("ends")))
        held = chain.where(F.col("band") == k).select(F.col("conv_id").alias("c"), "base", "keys", "bytes")
        rows, _ = store(mine.join(held, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c"), "band")
        floor = floor_of(rows, low, limit)
        cold, _ = store(peel_subtrees(rows.where(F.col("depth") > floor), low, floor), "subtrees")
        found.append(cold.where("not up"))
        given = cold.where("up").select(*GIVEN)
        for depth in range(floor, low - (k == 0), -1):
            there = rows.where(F.col("depth") == depth).withColumn("key", last_key()).select(*GIVEN)
            level, _ = store(peel_level(given.unionByName(there), depth), "level")
            found.append(level)
            given = given_up(level)
        below = given.groupBy("key").agg(*sums())
        parents = parents | F.col("depth").between(low, floor)
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    return with_parents(nodes.drop("up", "base", "keys", "bytes"), parents)


NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")


def with_parents(nodes: DataFrame, parents: Column) -> DataFrame:
    """Nodes whose parent was found elsewhere get its smallest member.  Fewer
    than FREQUENT parents have more than 1 / FREQUENT of these children; they
    are joined by broadcast."""
    cols = [F.col("conv_id"), F.col("depth"), F.col("parent_conv_id"), F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.col("ends").alias("ends_sha256")]
    open_ = nodes.where("not known").drop("parent_conv_id")
    over = nodes.where(parents).select(F.col("key").alias("over"), F.col("conv_id").alias("parent_conv_id"),
                                       F.col("children").alias("here"))
    frequent = F.col("here") * FREQUENT > F.lit(open_.count())
    same = F.col("parent") == F.col("over")
    many = F.broadcast(over.where(frequent))
    return (nodes.where("known").select(*cols)
            .unionByName(open_.join(many, same).select(*cols))
            .unionByName(open_.join(over.where(~frequent), same).select(*cols)))


def spliced(turns: DataFrame, family: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to share beginnings: conversation c gets the first
    h turns of conversation c - c % ``family``, then its own turns after its
    first h; h = crc32(c) % ``modulus``.  A null conv_id keeps its own.  Returns
    the turns (rows of ``marked``) and all ids."""
    h = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % modulus, F.lit(0))
    ids = turns.select("conv_id").distinct().withColumn("h", h)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "said"))
    numbered = turns.withColumn("place", place)
    # A limit on the row number is applied before the shuffle too.
    first = numbered.where(F.col("place") < modulus).withColumnRenamed("conv_id", "of")
    head = (ids.join(first, (F.col("conv_id") - F.col("conv_id") % family) == F.col("of"))
            .where("place <= h").select("conv_id", F.col("place").cast("long").alias("turn"), "said", "bytes"))
    own = numbered.where(F.col("place") > h).select("conv_id", (F.col("place") + modulus).cast("long").alias("turn"), "said",
                                                    "bytes")
    return head.unionByName(own), ids.select("conv_id")
