"""Time the headline queries over the given tables; prints one JSON line.

Each query is run once to warm the JVM and then timed from building the plan to the last row,
into Spark's no-op sink. BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyroll.plans import given_tables  # noqa: E402
from tallyroll.session import local_session  # noqa: E402

HEADLINES = (
    "gold_monthly_sales_summary",
    "silver_sales_enriched",
    "bronze_sales",
    "published_gold",
    "gold_reconciliation",
    "gold_export_rows",
    "silver_violations",
    "dq_sales_grain_unique",
    "dq_sales_product_keys_match",
    "dq_check_results",
    "inspect_gold_head",
    "inspect_channel_totals",
    "forecast_panel",
    "forecast_features",
    "forecast_naive_metrics",
    "forecast_summary",
)
RUNS = 2


def _scale(directory: str) -> float | str:
    name = Path(directory).name.removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, **{"spark.sql.shuffle.partitions": cores})
    queries = given_tables.queries()
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        runs = []
        for _ in range(1 + RUNS):
            started = time.perf_counter()
            queries[name](spark, directory).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": _scale(directory),
            }
        )
    )


if __name__ == "__main__":
    main()
