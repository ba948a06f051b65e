"""Summarise the physical plan of every registered query (before adaptive re-planning).

Usage: python tools/plan_shapes.py [sf_dir]  -> a markdown table on stdout.
Counts shuffle exchanges, broadcast exchanges, join strategies and windows over all
stages of a query: the intermediate tables it writes, and its result.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from runway.plans import catalog  # noqa: E402
from runway.session import build_session  # noqa: E402
from runway.sources import sinks  # noqa: E402


def shape(plan: str) -> dict[str, int]:
    return {
        "shuffles": len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "single": plan.count("Exchange SinglePartition"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8,
                          conf={"spark.sql.adaptive.enabled": "false"})
    print("| query | written tables | shuffles | broadcasts | BHJ | SMJ | windows | single-partition |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    stages: list[str] = []
    write = sinks.write_replace

    def noted(df, *args, **kwargs):
        stages.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **kwargs)

    sinks.write_replace = noted
    for name, q in sorted(catalog.QUERIES.items()):
        stages.clear()
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = shape("\n".join([*stages, plan]))
        print(f"| {name} | {len(stages)} | {s['shuffles']} | {s['broadcasts']} | {s['bhj']} | {s['smj']} | "
              f"{s['windows']} | {s['single']} |")


if __name__ == "__main__":
    main()
