"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each query is run once after a
warm-up on the same session; its result is written to the no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "web_signal_counters", "web_signal_flags", "bruteforce_offenders", "high_freq_ips", "status_distribution",
    "response_size_stats", "top_paths", "entity_aggregates", "parse_apache_combined", "parse_mixed_lines",
    "parse_by_source", "detect_format", "structured_linux", "standard_log_json", "custom_category_counts",
    "error_flags", "classify_rules", "ip_extract_top", "detections_and_alerts", "threat_summary", "threat_scores",
    "eval_vs_ground_truth", "threshold_sweep", "template_window_counts", "greedy_windows", "event_frequency",
    "file_quota_sample", "numeric_log_features", "tfidf_terms", "mine_templates", "document_line_templates",
    "iforest_scores", "flow_iforest", "line_anomalies", "logreg_anomaly", "stream_ip_rate", "report_sections",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from loomlog.catalog import QUERIES

    only = os.environ.get("BENCH_ONLY")
    names = only.split(",") if only else HEADLINE
    QUERIES["web_signal_counters"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
