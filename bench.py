"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query, the median counts (default 3)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from goldseam.plans.bound import QUERIES  # noqa: E402
from goldseam.session import build_session  # noqa: E402

HEADLINE = (
    "kpi_punctuality kpi_maintenance telematics_by_user monthly_sales sales_by_segment "
    "dedupe_lineitem silver_orders silver_customers silver_claims parse_mixed_dates "
    "claim_policy_customer claims_enriched referential_checks join_coverage orphan_documents duplicate_keys "
    "quality_report quality_keys summary_numeric corr_matrix iqr_outliers zscore_outliers "
    "merge_customers events_as_of change_history "
    "claim_rules bi_executive_kpis bi_label_decision bi_histogram bi_mean_median bi_top_makes "
    "best_prediction overall_stats class_distribution label_index split_counts score_batches topk_scores"
).split()


def run_once(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "goldseam-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            # Do not spend time on noting the source line of every column expression.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names[:3]:
        run_once(spark, folder, name)  # the first queries would else pay for a cold JVM
    times = {}
    for name in names:
        run_once(spark, folder, name)  # code generation and file listing are not timed
        times[name] = round(statistics.median(run_once(spark, folder, name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
