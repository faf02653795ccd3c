"""The plan summary counts operators per plan line."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_summary import summarise  # noqa: E402

PLAN = """AdaptiveSparkPlan isFinalPlan=false
+- SortAggregate(key=[k#1], functions=[min_by(struct(a), o)], output=[x])
   +- Exchange hashpartitioning(k#1, 8), ENSURE_REQUIREMENTS, [plan_id=1]
      +- SortAggregate(key=[k#1], functions=[partial_min_by(struct(a), o)], output=[k])
         +- BroadcastHashJoin [a], [b], Inner, BuildRight, false
            :- Generate inline(array(struct(c))), [x], false, [y]
            +- BroadcastExchange HashedRelationBroadcastMode(List(input[0, bigint, true]),false)"""


def test_summarise_counts_nodes():
    got = summarise(PLAN)
    assert got == {"hash shuffle": 1, "partial aggregate": 1, "broadcast hash join": 1, "generate": 1, "broadcast": 1}
