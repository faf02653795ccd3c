"""Summarise the physical plan of every registered query (writes PLANS.md).

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Counts, per query, the operators that decide cost at scale: shuffles by kind,
broadcasts, join strategies, partial aggregation, windows and window group
limits, top-k, generators and Python evaluation nodes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = [
    ("hash shuffle", r"Exchange hashpartitioning"),
    ("round-robin shuffle", r"Exchange RoundRobinPartitioning"),
    ("range shuffle", r"Exchange rangepartitioning"),
    ("single-partition shuffle", r"Exchange SinglePartition"),
    ("broadcast", r"BroadcastExchange"),
    ("broadcast hash join", r"BroadcastHashJoin"),
    ("sort-merge join", r"SortMergeJoin"),
    ("partial aggregate", r"(Hash|Sort|ObjectHash)Aggregate\(keys?=\[[^\]]*\], functions=\[partial_"),
    ("window group limit", r"WindowGroupLimit"),
    ("window", r"Window \["),
    ("top-k", r"TakeOrderedAndProject"),
    ("generate", r"Generate "),
    ("pandas UDF (Arrow)", r"ArrowEvalPython"),
    ("applyInPandas", r"FlatMapGroupsInPandas"),
]
TREE = re.compile(r"^[\s:+\-]*")


def summarise(plan: str) -> dict:
    """Operator counts, one per plan line (the node name starts the line)."""
    out = {}
    for line in plan.split("\n"):
        node = TREE.sub("", line)
        for name, pat in KINDS:
            if re.match(pat, node):
                out[name] = out.get(name, 0) + 1
                break
    return out


def main():
    from glean.plans.registry import ORACLES, QUERIES, SURVEY_IDS, load_all
    from glean.session import get_local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    load_all()
    spark = get_local_session("plan-summary")
    print("# Physical plans at a glance\n")
    print(f"Generated by `tools/plan_summary.py` on `{sf_dir}` (initial adaptive plans; AQE may still "
          "turn a sort-merge join into a broadcast join at run time). Not in the list: row-at-a-time "
          "Python UDFs, Cartesian products, nested-loop joins (none exist; see tests/test_plans.py).\n")
    print("| query | survey id | twin | plan operators |")
    print("|---|---|---|---|")
    for name in sorted(QUERIES):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        ops = ", ".join(f"{k} ×{v}" for k, v in s.items())
        print(f"| `{name}` | {SURVEY_IDS[name]} | {'yes' if name in ORACLES else 'rows-only'} | {ops} |")


if __name__ == "__main__":
    main()
