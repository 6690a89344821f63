"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of cores; query names as
arguments replace the headline list, ``all`` takes every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from fixtrail.checks import load
from fixtrail.session import build_session

HEADLINE = (
    "a1_methods_by_language", "a2_small_fixes", "a3_commit_count", "a6_project_totals", "a7_ranked_columns",
    "a8_cve_cwe_per_project", "a9_weakness_summary", "a10_top_share", "a13_box_stats", "a15_project_scores",
    "a16_days_to_fix", "a17_severity_summary", "a18_project_dmm", "a23_language_levels",
    "l1_extract_fix_links", "l2_classify", "l5_drop_unavailable", "l8_work_units", "l9_resolve_short_hashes",
    "p3_prune_method_change", "p3_prune_cwe", "p7_check_counts",
    "c1_changed_methods", "c3_method_rows", "c7_text_metrics", "c8_maintainability", "c9_label_language",
    "d2_number_diff", "d4_line_diff", "d7_pair_methods", "d8_pair_adjacent", "d9_method_patches",
    "i1_read_advisory_feed", "i4_incremental_ingest",
)


def main(wanted: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("fixtrail-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    names = list(queries) if wanted == ["all"] else wanted or list(HEADLINE)
    # Start the JVM's code paths before the clock runs.
    queries["a21_language_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
