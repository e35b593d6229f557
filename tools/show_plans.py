"""Summarise the physical plans of named queries: exchanges, joins, Python
nodes, codegen stages and scan pruning.

    python tools/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)),
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
        "scans": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))),
        "pushed": sorted(set(p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p)),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from quire.plans import QUERIES
    from quire.session import get_session

    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:] or sorted(QUERIES):
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(name, summary(plan))


if __name__ == "__main__":
    main()
