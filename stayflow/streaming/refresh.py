"""Incremental refresh of the rates when new claims arrive.

A person's stays depend on that person's claims only, so when a file is appended
just the persons met in it are sequenced again.  The state is a folder of tables,
each written once per run and never changed afterwards:

    claims/run=N/slice=K    claims of run N, by a hash of the person
    touched/run=N           the persons met in run N
    rows/run=N              what those persons' claims count for after run N
    rates/run=N             the whole rate table after run N

A run reads claims of the touched persons alone (their slices, then a semi join),
sequences them, and puts the result beside their rows of earlier runs, which no
longer count: of each person the rows of the latest run that touched that person hold.
The rate table changes only through the claims that the touched persons' old and new
rows name: those are counted with the old rows, taken back, and counted with the new
ones.

A run becomes visible when its rate table, written last, is complete.  A run that
failed or is repeated writes its own folders anew and reads earlier runs only, so
batches that Structured Streaming delivers again change nothing.  Beneficiaries are
taken as they are; where they change, start again from all claims.  A group whose
claims all have NULL ids is not listed.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rates as R
from ..rules import RuleSet
from ..schemas import BeneCols, ClaimCols

# Slices of the persons in the stored claims; a run reads those that it touches.
SLICES = 256


@dataclass(frozen=True)
class RateState:
    """A stored rate that grows by runs."""

    spark: SparkSession
    folder: str
    rules: RuleSet
    c: ClaimCols = ClaimCols()
    b: BeneCols = BeneCols()
    slices: int = SLICES

    def path(self, name: str, run: int | None = None) -> str:
        base = f"{self.folder.rstrip('/')}/{name}"
        return base if run is None else f"{base}/run={run}"

    def runs(self) -> list[int]:
        """Complete runs, oldest first: those whose rate table is committed."""
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path("rates") + "/run=*/_SUCCESS")
        found = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
        return sorted(int(f.getPath().getParent().getName().removeprefix("run=")) for f in found)

    def rates(self) -> DataFrame:
        """The rate table after the last complete run: empty if a planned stay
        has no claim id (SQL ``NOT IN``)."""
        runs = self.runs()
        if not runs:
            raise ValueError(f"no complete run in {self.folder}")
        stored = self.spark.read.parquet(self.path("rates", runs[-1]))
        null_ids = stored.agg(F.sum("__planned_null")).scalar()
        return with_rate(stored.where((F.col("total_admissions") > 0) & (null_ids == 0)).drop("__planned", "__planned_null"))

    def slice_of(self, person: Column) -> Column:
        return F.pmod(F.xxhash64(person), F.lit(self.slices)).cast("int")

    def earlier(self, name: str, before: int) -> DataFrame | None:
        """A table's rows of the complete runs before ``before``, with their run."""
        runs = [r for r in self.runs() if r < before]
        if not runs:
            return None
        read = self.spark.read.option("basePath", self.path(name))
        return read.parquet(*[self.path(name, r) for r in runs])


def with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("readmission_rate", R.ratio("readmissions", "total_admissions"))


def claims_of_touched(state: RateState, run: int) -> DataFrame:
    """All claims, of this run and before, of the persons touched by it: only
    their slices are read."""
    person = state.c.person
    touched = state.spark.read.parquet(state.path("touched", run))
    hit = [r.slice for r in touched.select("slice").distinct().collect()]  # at most ``slices`` numbers
    read = state.spark.read.option("basePath", state.path("claims"))
    runs = [r for r in state.runs() if r < run] + [run]
    claims = read.parquet(*[state.path("claims", r) for r in runs]).where(F.col("slice").isin(hit)).drop("slice", "run")
    return claims.join(touched.select(F.col(person).alias("__t")), F.col(person).eqNullSafe(F.col("__t")), "left_semi")


def holding(state: RateState, before: int) -> DataFrame | None:
    """Rows of earlier runs that still hold: of each person those of the
    latest run that touched that person."""
    rows, touched = state.earlier("rows", before), state.earlier("touched", before)
    if rows is None or touched is None:
        return None
    latest = touched.groupBy(F.col(state.c.person).alias("__t")).agg(F.max("run").alias("__latest"))
    same = F.col(state.c.person).eqNullSafe(F.col("__t")) & (F.col("run") == F.col("__latest"))
    return rows.join(latest, same).drop("__t", "__latest", "run")


def append(state: RateState, new_claims: DataFrame, bene: DataFrame, run: int | None = None, **seq_kw) -> DataFrame:
    """Add claims to the state as run ``run`` (default: the next) and return
    the rate table after it."""
    c, b = state.c, state.b
    run = (state.runs() or [-1])[-1] + 1 if run is None else run
    if any(r >= run for r in state.runs()) or (state.runs() and new_claims.isEmpty()):
        return state.rates()  # delivered before, or nothing new

    (new_claims.withColumn("slice", state.slice_of(F.col(c.person)))
     .write.mode("overwrite").partitionBy("slice").parquet(state.path("claims", run)))
    mine = state.spark.read.parquet(state.path("claims", run))
    mine.select(c.person, "slice").distinct().write.mode("overwrite").parquet(state.path("touched", run))
    touched = state.spark.read.parquet(state.path("touched", run)).select(F.col(c.person).alias("__t"))

    groups = {"__state": b.state, "__sex": b.sex}
    keys = ["year", *groups]
    rows = R.episode_rows(claims_of_touched(state, run), state.rules, c=c, **seq_kw)
    j = rows.join(R.bene_groups(bene, groups, c.person, b), c.person, "left")
    found = j.select(c.claim, c.person, *keys, (F.col("__index") & F.col("__b").isNotNull()).alias("__in"), "__flag", "__planned")
    found.write.mode("overwrite").parquet(state.path("rows", run))
    found = state.spark.read.parquet(state.path("rows", run))

    held = holding(state, run)
    if held is None:
        counts = counted_once(found, keys, c)
    else:
        counts = changed(state, held, found, touched, keys, run)
    counts.select("year", F.col("__state").alias(b.state), F.col("__sex").alias(b.sex), "readmissions", "total_admissions",
                  "__planned", "__planned_null").write.mode("overwrite").parquet(state.path("rates", run))
    return state.rates()


def counted_once(rows: DataFrame, keys: Sequence[str], c: ClaimCols) -> DataFrame:
    """Counts per group as they add up over disjoint sets of claims; the group
    of NULL keys also counts claims with a planned row, and those without id."""
    pairs = R.claim_pairs(rows, list(keys), c)
    known, kept = F.col(c.claim).isNotNull(), ~F.col("__p")
    return pairs.groupBy(*keys).agg(
        F.count_if(F.col("__in") & known & kept & F.col("__f")).alias("readmissions"),
        F.count_if(F.col("__in") & known & kept).alias("total_admissions"),
        F.count_if(~kept).alias("__planned"), F.count_if(~kept & ~known).alias("__planned_null"))


SUMS = ("readmissions", "total_admissions", "__planned", "__planned_null")


def changed(state: RateState, held: DataFrame, found: DataFrame, touched: DataFrame, keys: Sequence[str], run: int) -> DataFrame:
    """The last rate table, without what the affected claims counted before
    and with what they count now."""
    c, b = state.c, state.b
    of_touched = F.col(c.person).eqNullSafe(F.col("__t"))
    old = held.join(touched, of_touched, "left_semi")
    claims = old.select(c.claim).union(found.select(c.claim)).distinct().select(F.col(c.claim).alias("__c"))
    affected = F.col(c.claim).eqNullSafe(F.col("__c"))
    before = held.join(claims, affected, "left_semi")
    others = before.join(touched, of_touched, "left_anti")  # other persons' rows of the same claims
    now = counted_once(others.unionByName(found), keys, c)
    then = counted_once(before, keys, c).withColumns({s: -F.col(s) for s in SUMS})
    last = state.earlier("rates", run).where(F.col("run") == max(r for r in state.runs() if r < run)).select(
        "year", F.col(b.state).alias("__state"), F.col(b.sex).alias("__sex"), *SUMS)
    total = last.unionByName(then).unionByName(now).groupBy(*keys).agg(*[F.sum(s).alias(s) for s in SUMS])
    return total


def refresh_on_arrival(state: RateState, arrivals: DataFrame, bene: DataFrame, checkpoint: str, **seq_kw):
    """Keep the state up with a stream of claims (``ingest.stream_extract``):
    one run per micro-batch, what has arrived by now; returns the started query."""
    def one(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            append(state, batch, bene, run=batch_id, **seq_kw)
    return (arrivals.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(one).start())
