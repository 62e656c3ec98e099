"""Print the final (adaptive) physical plans of the key queries, reduced to
the lines that matter for scale: scans (columns read, pushed filters),
joins, exchanges, aggregates, windows and sorts.

    python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

KEEP = re.compile(
    r"Scan|ReadSchema|PushedFilters|Join|Exchange|AQEShuffleRead|HashAggregate|Expand|Window|Sort \[|"
    r"BroadcastExchange|WriteFiles|InMemory|Checkpoint|LogicalRDD|Union"
)


def final_plan(df) -> str:
    execution = df._jdf.queryExecution()
    execution.toRdd().count()  # runs the DataFrame's own execution on the executors, so its adaptive plan is final
    return execution.executedPlan().toString()


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    from retailflow.config import build_session
    from retailflow.plans import queries as Q

    spark = build_session()
    for name in ("orders_silver", "orders_silver_shuffle_join", "sales_by_date", "sales_by_category",
                 "customer_analytics", "product_performance"):
        plan = final_plan(Q.all_queries()[name](spark, sf_dir))
        first = plan.split("+- == Initial Plan ==")[0]
        lines = [ln.rstrip() for ln in first.splitlines() if KEEP.search(ln)]
        print(f"### {name}\n```")
        print("\n".join(re.sub(r"#\d+L?", "", ln)[:160] for ln in lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
