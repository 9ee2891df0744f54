"""Write the final (post-AQE) physical plans of the headline queries.

    python tools/show_plans.py [sf_dir] > docs/plans.md

Each query is executed once so that AQE's runtime decisions (broadcast vs
sort-merge join, coalesced or split partitions) appear in the plan.
"""

from __future__ import annotations

import os
import re
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

HEADLINE = ["clean_players", "clean_transactions", "daily_ledger", "segment_totals", "top_n_wide", "extend_transactions"]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from ledgerlake import queries as Q
    from ledgerlake.session import local_session

    spark = local_session(8, 8)
    print(f"# Final physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `tools/show_plans.py`; each query was executed before its plan was read.\n")
    for name in HEADLINE:
        df = Q.REGISTRY[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("\n+- == Initial Plan ==")[0]
        counts = {
            "shuffle exchanges": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition", plan)),
            "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
            "reused stages": len(re.findall(r"Reused", plan)),
            "sort-merge joins": len(re.findall(r"SortMergeJoin", plan)),
            "broadcast joins": len(re.findall(r"BroadcastHashJoin", plan)),
            "window group limits": len(re.findall(r"WindowGroupLimit", plan)),
        }
        print(f"## {name}\n")
        print(", ".join(f"{k}: {v}" for k, v in counts.items()) + "\n")
        print("```")
        print(plan.rstrip())
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
