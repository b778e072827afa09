"""Previous-row lookups within an entity's ordered history, safe under skew.

``LAG(x) OVER (PARTITION BY person ORDER BY admit, claim)`` is the heart of the
readmission measure.  A plain window puts every row of one person into one
task; if one person (or a NULL person id) holds a large share of all rows that
task never ends.  This module computes the same values in two branches:

* cold entities (at most ``hot_key_rows`` rows) -- one hash shuffle on the
  entity and a running window, exactly the plain plan;
* hot entities -- split by the leading order column(s) (the admission day), a
  window per (entity, day), and a fix-up of each day's first row from a small
  table with one row per (entity, day) that carries the day's last member.

Hot entities are found with a pre-aggregated count (map-side combine, so the
count itself is skew-proof).  Their number is at most ``rows / hot_key_rows``,
which bounds the broadcast that tags them.  The hot branch first collapses
exact copies of a row into one row and a multiplicity (map-side, so a heap of
identical rows -- a twice-loaded extract -- never lands in one task) and
restores them at the end in pieces spread over tasks; only rows on hot days
(one entity, one day, more than ``hot_key_rows`` rows) pay for the collapse.  It is a two-pass
parallel prefix scan (chunk windows and chunk tails, then the fix-up), so it
reads its rows twice; with no hot entity AQE drops it at run time and the
plan is the plain window.

Several *tracks* can be computed in the same pass: a track is a subset of rows
(``member``) and the values to carry from the previous member.  The flag
(complete stays, all years) and the rate (stays in the measured years, NULL
discharges kept) each have their own previous stay, and both come out of one
shuffle of the claims instead of two.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import hot_key_rows as _conf_hot_key_rows

_UNB = Window.unboundedPreceding

# Smallest threshold at which the hot keys are broadcast without being measured:
# no more than one row in a hundred, of which the key alone.
BROADCAST_FROM = 100


@dataclass
class Track:
    """Rows of one sequence and the values taken from the previous member."""
    member: Column
    carry: dict[str, Column] = field(default_factory=dict)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _order_key(order: Sequence[str]) -> Column:
    # Struct that sorts like ORDER BY c1 ASC NULLS LAST, c2 ASC NULLS LAST ...
    parts = ", ".join(f"struct(isnull({_q(c)}) AS n, {_q(c)} AS v) AS k{i}" for i, c in enumerate(order))
    return F.expr(f"struct({parts})")


def previous_in_sequence(df: DataFrame, entity: str, order: Sequence[str],
                         tracks: Sequence[Track], *, hot_key_rows: int | None = None,
                         chunk_by: Sequence[str] | None = None,
                         key_source: DataFrame | None = None) -> DataFrame:
    """Add, per track, the carried values of the nearest preceding member row.

    For each row r and track t, the output columns named in ``t.carry`` hold
    the values of the last row p with the same ``entity`` and ``order(p) <
    order(r)`` (ascending, NULLS LAST) for which ``t.member`` is true; NULL if
    there is none.  When every row is a member this is ``LAG(v, 1)``.

    ``hot_key_rows``: entities with more rows are split (default from the
    ``spark.stayflow.hotKeyRows`` setting; a negative value disables the split).
    ``chunk_by``: leading order columns that split a hot entity (default: the
    first order column).
    ``key_source``: a cheaper DataFrame with the ``entity`` column and at least
    as many rows per entity as ``df`` (e.g. the unfiltered source table); the
    per-entity counts are taken from it.  Over-counting only marks more
    entities hot, which is still exact, and the bound rows / threshold holds.
    """
    spark = df.sparkSession
    threshold = _conf_hot_key_rows(spark) if hot_key_rows is None else int(hot_key_rows)
    chunk_by = list(chunk_by) if chunk_by else [order[0]]
    if list(order[:len(chunk_by)]) != chunk_by:
        raise ValueError("chunk_by must be a prefix of order")
    inner_order = list(order[len(chunk_by):])

    base_cols = df.columns
    mnames = [f"__m{i}" for i in range(len(tracks))]
    pnames = [f"__p{i}" for i in range(len(tracks))]
    base = df.select("*", *[
        F.when(t.member, F.struct(*[c.alias(n) for n, c in t.carry.items()])).alias(m)
        for t, m in zip(tracks, mnames)])
    sort_cols = [F.col(c).asc_nulls_last() for c in order]

    def running(w: Window) -> list[Column]:
        frame = w.rowsBetween(_UNB, -1)
        return [F.last(m, ignorenulls=True).over(frame).alias(p) for m, p in zip(mnames, pnames)]

    if threshold < 0:
        # An entity's rows meet in one task, so they should be narrow: a first
        # window, over rows alike in the two leading order columns, replaces the
        # others by their rank; then only what the caller reads travels on.
        if order[2:]:
            tied = Window.partitionBy(entity, *order[:2]).orderBy(*sort_cols[2:])
            base = base.withColumn("__rank", F.row_number().over(tied))
            sort_cols = [*sort_cols[:2], F.col("__rank")]
        out = base.select("*", *running(Window.partitionBy(entity).orderBy(*sort_cols))).drop(*mnames, "__rank")
        return _expand(out, base_cols, tracks, pnames)

    src_keys = key_source.select(entity) if key_source is not None else base.select(entity)
    counts = src_keys.groupBy(entity).agg(F.count(F.lit(1)).alias("__n"))
    hot = (counts.where(F.col("__n") > F.lit(threshold))
           .select(F.col(entity).alias("__hk"), F.lit(True).alias("__hot")))
    # |hot| <= rows / threshold: a proven bound for the broadcast, small from
    # BROADCAST_FROM rows on.  Below, the planner decides by measured size.  (By
    # the size of the counts before the filter, that is: from some hundred thousand
    # entities on it joins by a shuffle that brings a hot entity into one task.)
    small = F.broadcast if threshold >= BROADCAST_FROM else (lambda side: side)
    tagged = base.join(small(hot), F.col(entity).eqNullSafe(F.col("__hk")), "left")

    cold = tagged.where(F.col("__hot").isNull()).drop("__hk", "__hot")
    cold_out = cold.select("*", *running(Window.partitionBy(entity).orderBy(*sort_cols))).drop(*mnames)

    # Exact copies of a row (a twice-loaded extract, say) collapse to one row
    # and its multiplicity; the partial aggregation does this map-side, so a
    # heap of copies never reaches one task.  They are restored at the end.
    # Only days that are themselves hot (more than ``threshold`` rows of one
    # entity) can hold such a heap; they are found with another map-side
    # count (at most rows / threshold of them, broadcast) and only their rows
    # pay for the collapse -- the other hot rows keep multiplicity 1.
    hot_rows0 = tagged.where(F.col("__hot").isNotNull()).drop("__hk", "__hot", *mnames)
    dkeys = [entity, *chunk_by]
    hot_days = (hot_rows0.groupBy(*dkeys).agg(F.count(F.lit(1)).alias("__dn"))
                         .where(F.col("__dn") > F.lit(threshold))
                         .select(*[F.col(k).alias(f"__d{i}") for i, k in enumerate(dkeys)],
                                 F.lit(True).alias("__hotday")))
    dcond = None
    for i, k in enumerate(dkeys):
        e = F.col(k).eqNullSafe(F.col(f"__d{i}"))
        dcond = e if dcond is None else dcond & e
    day_tagged = hot_rows0.join(small(hot_days), dcond, "left").drop(*[f"__d{i}" for i in range(len(dkeys))])
    collapsed = (day_tagged.where(F.col("__hotday").isNotNull()).drop("__hotday")
                           .groupBy(*base_cols).agg(F.count(F.lit(1)).alias("__mult")))
    single = day_tagged.where(F.col("__hotday").isNull()).drop("__hotday").withColumn("__mult", F.lit(1).cast("long"))
    distinct = single.unionByName(collapsed).select("*", *[
        F.when(t.member, F.struct(*[c.alias(n) for n, c in t.carry.items()])).alias(m)
        for t, m in zip(tracks, mnames)])
    # Hot rows are keyed by the struct (entity, chunk...): one key for the
    # shuffle, the windows, the tails and the fix-up join, so the join reuses
    # the shuffle, and struct equality matches NULL fields (a NULL entity is
    # a key like any other).  The repartition is explicit: an input already
    # hash-partitioned or bucketed by the entity would otherwise satisfy the
    # (entity, chunk) windows and keep a hot entity in one task.
    key = F.struct(F.col(entity).alias("e"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(chunk_by)])
    hot_rows = distinct.withColumn("__k", key).repartition("__k")
    wc = Window.partitionBy("__k").orderBy(*[F.col(c).asc_nulls_last() for c in inner_order])
    local = hot_rows.select("*", *running(wc) if inner_order else
                            [F.lit(None).cast(hot_rows.schema[m].dataType).alias(p)
                             for m, p in zip(mnames, pnames)])
    okey = _order_key(order)
    tails = hot_rows.groupBy("__k").agg(*[
        F.max(F.when(F.col(m).isNotNull(), F.struct(okey.alias("o"), F.col(m).alias("v"))))
        .getField("v").alias(f"__t{i}") for i, m in enumerate(mnames)])
    # One row per (entity, chunk); a hot entity has as many as it has chunks.
    wt = (Window.partitionBy(F.col("__k.e"))
          .orderBy(*[F.col(f"__k.c{i}").asc_nulls_last() for i in range(len(chunk_by))])
          .rowsBetween(_UNB, -1))
    chunk_prev = tails.select(
        "__k", *[F.last(f"__t{i}", ignorenulls=True).over(wt).alias(f"__cp{i}") for i in range(len(mnames))])
    fixed = (local.join(chunk_prev, "__k", "left")
                  .withColumns({p: F.coalesce(F.col(p), F.col(f"__cp{i}")) for i, p in enumerate(pnames)})
                  .drop(*[f"__cp{i}" for i in range(len(pnames))]))
    # Restore the copies.  Entry 0 is the first copy (previous row as found);
    # entries 1..n are pieces of at most ``piece`` later copies, whose
    # previous row is an identical copy (its own values where it is a
    # member).  Pieces are spread over tasks before they are expanded.
    piece = max(1, threshold)
    n_pieces = F.ceil((F.col("__mult") - 1) / F.lit(piece)).cast("long")
    entries = fixed.withColumn("__i", F.explode(F.sequence(F.lit(0).cast("long"), n_pieces)))
    count = F.when(F.col("__i") == 0, F.lit(1)).otherwise(
        F.least(F.lit(piece).cast("long"), F.col("__mult") - 1 - (F.col("__i") - 1) * piece))
    spread = (entries.withColumns({
                  **{p: F.when(F.col("__i") == 0, F.col(p)).otherwise(F.coalesce(F.col(m), F.col(p)))
                     for m, p in zip(mnames, pnames)},
                  "__cnt": count})
                     .drop("__mult", *mnames)
                     .repartition("__k", "__i"))
    hot_out = (spread.withColumn("__c", F.explode(F.array_repeat(F.lit(0), F.col("__cnt").cast("int"))))
                     .drop("__c", "__cnt", "__k", "__i"))

    return _expand(cold_out.unionByName(hot_out), base_cols, tracks, pnames)


def _expand(df: DataFrame, base_cols: list[str], tracks: Sequence[Track], pnames: list[str]) -> DataFrame:
    outs = []
    for t, p in zip(tracks, pnames):
        outs += [F.col(p).getField(n).alias(n) for n in t.carry]
    return df.select("*", *outs).drop(*pnames)


def lag_by_entity(df: DataFrame, entity: str, order: Sequence[str], carry: dict[str, Column],
                  **kw) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY entity ORDER BY order)`` for each carried value."""
    return previous_in_sequence(df, entity, order, [Track(F.lit(True), carry)], **kw)
