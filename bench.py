"""Headline queries, timed.  Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from lossgrid.plans.registry import load_all
from lossgrid.session import ship_package

HEADLINE = (
    "process_portfolio", "stage_hybrid", "stage_metrics", "summary_report", "stage_distribution_view", "regional_risk",
    "product_performance", "executive_summary", "credit_quality_trends", "ecl_type_stage", "report_histograms",
    "portfolio_composition", "exposure_by_stage_income", "join_group_means", "model_performance_snapshot",
    "loan_payments", "payments_per_loan", "loans_without_payments", "macro_asof", "payment_streaks", "stage_rank",
    "split_stratified", "calc_compliance_checks", "schema_checks_loan", "business_rules_loan", "column_profile",
    "iqr_outliers", "features_basic", "features_interactions", "stress_pd", "feature_contributions",
    "explain_stage_text", "eval_auc_ovr", "success_rate_5m", "duration_p95_p99", "throughput", "sessions_by_gap",
    "stream_tumbling", "sink_partitioned_clustered", "quality_gates", "explain_outlier_text", "weighted_readiness",
    "isolation_outliers",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lossgrid-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    queries = load_all()

    def run(key: str) -> float:
        start = time.perf_counter()
        # every output row is computed and nothing is collected
        queries[key].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("stage_metrics")  # start-up of the JVM and the first plan is not a query's cost
    seconds = {key: round(run(key), 3) for key in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
