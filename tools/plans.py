"""Summarize the final (adaptive) physical plans of the headline queries.

    python tools/plans.py [sf_dir] > PLANS.md

For each query: the exchanges (shuffles and broadcasts), joins, windows and
aggregates that actually ran, and every Parquet scan with its pushed filters
and read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayflow.plans.catalog import BENCH_QUERIES, QUERIES  # noqa: E402
from stayflow.session import build_session  # noqa: E402

KINDS = [
    ("shuffle", re.compile(r"^Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)")),
    ("broadcast", re.compile(r"^BroadcastExchange")),
    ("join", re.compile(r"^(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)")),
    ("window", re.compile(r"^Window ")),
    ("aggregate", re.compile(r"^(HashAggregate|ObjectHashAggregate|SortAggregate)")),
    ("scan", re.compile(r"^FileScan ")),
]


def summarize(plan: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {k: [] for k, _ in KINDS}
    for raw in plan.splitlines():
        line = re.sub(r"^[\s:+\-|*]+", "", raw).strip()
        line = re.sub(r"^\(\d+\)\s*", "", line)
        for kind, rx in KINDS:
            if rx.search(line):
                if kind == "scan":
                    table = re.search(r"FileScan \w+ ([^\[]*)\[", line)
                    pushed = re.search(r"PushedFilters: (\[.*?\])(?:, ReadSchema|$)", line)
                    schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
                    name = re.search(r"Location: \w+\(\d+ paths\)\[([^\]]*)\]", line)
                    out[kind].append(f"{os.path.basename(name.group(1)) if name else (table.group(1) if table else '?')}"
                                     f" pushed={pushed.group(1) if pushed else '[]'}"
                                     f" read={schema.group(1) if schema else '?'}")
                else:
                    out[kind].append(re.sub(r"#\d+L?", "", line)[:140])
    return out


def final_only(plan: str) -> str:
    """The plan without the initial plans that adaptive execution prints
    beside the final ones, at the top and inside subqueries."""
    kept, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-|"))
        if "== Initial Plan ==" in line:
            skip = depth
        elif skip is not None and (depth < skip or "== Final Plan ==" in line):
            skip = None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", app="stayflow-plans",
                          extra={"spark.sql.maxMetadataStringLength": "1000"})
    print(f"# Final plans of the headline queries ({sf_dir}, local[8], AQE on)\n")
    print("Generated by `tools/plans.py`; adaptive plans after execution.\n")
    for name in BENCH_QUERIES:
        df = QUERIES[name](spark, sf_dir)
        df.toArrow()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = final_only(plan)
        s = summarize(plan)
        print(f"## {name}\n")
        for kind, _ in KINDS:
            items = s[kind]
            if not items:
                continue
            print(f"- **{kind}** ({len(items)})")
            for it in items:
                print(f"  - `{it}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
