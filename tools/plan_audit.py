"""Print, for every registered query, the joins and exchanges of its physical
plan and flag Cartesian / nested-loop joins (run on the small tables)."""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ragloom.plans.registry import load_all  # noqa: E402
from ragloom.session import local_session  # noqa: E402

SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = local_session(4, 4)
bad = 0
for name, r in load_all().items():
    try:
        plan = r.fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
    except Exception as e:  # noqa: BLE001
        print(f"{name:28s} ERROR {type(e).__name__}")
        continue
    flags = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in plan]
    joins = len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan))
    ex = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
    wgl = "WGL" if "WindowGroupLimit" in plan else ""
    print(f"{name:28s} joins={joins:2d} exchanges={ex:2d} {wgl:3s} {' '.join(flags)}")
    bad += bool(flags)
print("queries with cartesian/nested-loop joins:", bad)
spark.stop()
