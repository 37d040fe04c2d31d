"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores, BENCH_QUERIES an optional comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from garimpo.queries import REGISTRY  # noqa: E402
from garimpo.session import local_session  # noqa: E402

HEADLINE = [
    "market_overview", "skills_frequency", "top_skills_per_area", "dim_company", "fact_star",
    "incremental_fact", "search_postings", "kpis", "skills_heatmap", "insert_if_absent",
    "unprocessed_rows", "first_source_description", "update_by_key", "append_to_array",
    "field_map_json", "load_counts", "fold_text", "classify_area", "classify_seniority",
    "extract_skills", "new_terms", "work_mode", "classify_pages", "expire_postings", "exact_dedup",
    "token_sort_ratio", "fuzzy_dedup", "resolve_postings", "quality_report", "upsert_run_log",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores, "16g")
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("kpis", "token_sort_ratio"):  # start the JVM's and Python's workers
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
