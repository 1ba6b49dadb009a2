"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contrail.plans.catalog import QUERIES  # noqa: E402
from contrail.session import build_session  # noqa: E402

HEADLINE = [
    "flagship_disruption_by_weather_source",
    "j2_enrich_with_fallback",
    "j5_join_traffic",
    "g1_hourly_weather",
    "g2_region_hourly",
    "g3_causes_by_month",
    "g5_target_encode_airport_month",
    "g7_prior_day_features",
    "g8_hourly_congestion",
    "g9_prior_month_causes",
    "g10_rate_by_day",
    "g11_top_routes_cancelled",
    "g14_crosstab",
    "g15_missingness",
    "g16_describe",
    "g23_box_stats",
    "w1_prev_day_failure",
    "w3_acf",
    "w5_dedup_first",
    "w6_label_encode",
    "w_exact_quantiles",
    "w7_cap_per_group",
    "b2_stratified_split",
    "b6_smote",
    "c1_corr_with",
    "c2_spearman_matrix",
    "c4_cramers_v",
    "d1_duplicates",
    "d6_quality_report",
    "m9_threshold_sweep",
    "m11_confusion",
    "m14_average_precision",
    "job1_build_dataset",
    "job2_build_features",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    QUERIES[names[0]].run(spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
