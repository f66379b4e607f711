"""Headline queries at one scale; prints one JSON line. Every result is produced in full (no-op sink)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kithscope.plans.registry import all_queries  # noqa: E402
from kithscope.session import local_session  # noqa: E402

HEADLINE = [
    "h7_authenticity", "h10_distributions", "h11_config_sweep", "a1_keyword_stats", "a7_final_scores", "a8_ranked_list",
    "a13_model_stats", "a14_model_agreement", "a24_rollup", "w1_rolling_mean", "w3_top_share", "w5_empirical_cdf",
    "e1_curated_report", "e2_rank_report", "l1_label_work_list", "l6_checked_responses", "u1_upsert_profiles",
    "u3_insert_keywords", "k4_stratified_sample", "b2_numbered_batches", "q7_validate_leads", "s7_high_score_export",
    "p1_flatten_profiles", "p3_normalize_text", "m1_audience_similarity", "t3_first_seen", "t4_weekly_yield",
    "t1_ingest", "t3_firsts_over_batches", "u7_stored_keyword_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    # One untimed query starts the JVM's compilers and reads the parquet footers once.
    queries["h7_authenticity"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
