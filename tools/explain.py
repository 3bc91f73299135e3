"""Print the final (adaptive) physical plan of registered queries, or a
one-line shape summary per query.

usage: python tools/explain.py [--summary] [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import registry  # noqa: E402
from tessera.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.collect()  # executes through the DataFrame's own QueryExecution
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shape(plan: str) -> str:
    def n(pat):
        return len(re.findall(pat, plan))

    return (
        f"shuffles={n(r'Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin')} "
        f"single_partition={n(r'Exchange SinglePartition')} broadcast_joins={n(r'BroadcastHashJoin')} "
        f"sort_merge_joins={n(r'SortMergeJoin')} nested_loop={n(r'BroadcastNestedLoopJoin|CartesianProduct')} "
        f"windows={n(r'Window \[')} partial_window_limits={n(r'WindowGroupLimit.*Partial')} "
        f"partial_aggs={n(r'partial_')} top_n={n(r'TakeOrderedAndProject')} "
        f"reused={n(r'ReusedExchange')} subqueries={n(r'Subquery ')}"
    )


def main() -> None:
    args = sys.argv[1:]
    summary = "--summary" in args
    args = [a for a in args if a != "--summary"]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = build_session("local[8]", shuffle_partitions=8)
    registry.load_all()
    for name in names or sorted(registry.QUERIES):
        plan = final_plan(registry.QUERIES[name](spark, sf_dir))
        print(f"{name}: {shape(plan)}" if summary else f"===== {name}\n{plan}")


if __name__ == "__main__":
    main()
