"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query (plan building included) runs to completion into the ``noop``
sink (all rows computed, nothing collected); its time is the median of
``$BENCH_REPEAT`` (default 3) runs. The raw feeds are landed as files once
(``landing``, timed apart); ``pipeline_end_to_end`` runs every streaming
bronze/silver table over them with ``availableNow`` and writes the seven
gold tables, each time into a fresh warehouse. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from retailflow.config import DEFAULT_AS_OF, DEFAULT_ORDER_DATE, build_session, run_folder  # noqa: E402
from retailflow.plans import queries as Q  # noqa: E402
from retailflow.plans.pipeline import run_pipeline  # noqa: E402
from retailflow.schemas import MONEY_DECIMAL  # noqa: E402
from retailflow.sources.landing import land_test_feeds  # noqa: E402
from retailflow.streaming.runner import Warehouse  # noqa: E402

REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))  # median of this many runs per query

HEADLINE = (
    "orders_silver",
    "sales_by_date",
    "sales_by_category",
    "sales_by_geography",
    "customer_analytics",
    "product_performance",
    "monthly_sales_trend",
    "orders_by_date",
)


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def end_to_end(spark, land) -> None:
    root = run_folder(spark, "bench")
    run_pipeline(spark, land, Warehouse(f"{root}/warehouse"), as_of=DEFAULT_AS_OF, money=MONEY_DECIMAL, order_date_default=DEFAULT_ORDER_DATE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="retailflow-bench")
    qs = Q.all_queries()
    run_noop(qs["sales_by_category"](spark, sf_dir))  # warm-up (JIT, file listing), not timed
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(REPEAT):
            t0 = time.perf_counter()
            run_noop(qs[name](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    t0 = time.perf_counter()
    land = land_test_feeds(spark, sf_dir, run_folder(spark, "bench-landing"))
    landing = round(time.perf_counter() - t0, 3)
    runs = []
    for _ in range(REPEAT):
        t0 = time.perf_counter()
        end_to_end(spark, land)
        runs.append(time.perf_counter() - t0)
    times["pipeline_end_to_end"] = round(statistics.median(runs), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "landing": landing,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
