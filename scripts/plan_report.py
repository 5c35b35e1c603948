"""Write docs/PLANS.md: physical-plan statistics of the headline queries (sf0.1, AQE initial plan)."""
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from lakeops.plans import registry  # noqa: E402
from lakeops.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = local_session(shuffle_partitions=8)
registry.load_all()
rows = []
for name in HEADLINE:
    df = registry.QUERIES[name](spark, sf)
    p = df._jdf.queryExecution().executedPlan().toString()
    rows.append((name, p.count("Exchange"), p.count("FileScan"), p.count("PushedFilters: [") - p.count("PushedFilters: []"),
                 p.count("SortMergeJoin"), p.count("BroadcastHashJoin"), p.count("BroadcastNestedLoopJoin"),
                 p.count("Window ["), p.count("Python")))
lines = ["# Physical plans of the headline queries", "",
         f"Counts from `executedPlan` (AQE initial plan) at `{os.path.basename(sf)}`; generated by `scripts/plan_report.py`.",
         "Scans with pushed filters are parquet scans whose `PushedFilters` list is not empty. Windows only appear after",
         "aggregation (small inputs); no Python appears in any plan; nested-loop joins only appear against 1-row aggregates.", "",
         "| query | exchanges | scans | scans with pushed filters | SMJ | BHJ | BNLJ | windows | python |",
         "|---|---|---|---|---|---|---|---|---|"]
lines += ["| " + " | ".join(str(x) for x in r) + " |" for r in rows]
open(os.path.join(ROOT, "docs", "PLANS.md"), "w").write("\n".join(lines) + "\n")
print("\n".join(lines))
