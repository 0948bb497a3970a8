"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (folder of tables), BENCH_CPUS (local cores),
BENCH_QUERIES (comma separated names, all headline queries by default).
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from lavra.bindings import QUERIES
from lavra.session import build_session

HEADLINE = [
    "delivery_like",
    "delivery_two_branches",
    "delivery_metrics",
    "canonical_priority",
    "canonical_ranked",
    "left_enrich_tax_id",
    "left_key_flag",
    "unmatched_detail",
    "composite_join",
    "duplicate_summary",
    "duplicate_detail",
    "union_periods",
    "group_counts_multi",
    "distinct_counts",
    "coverage_keys",
    "coverage_rows",
    "clean_text",
    "parse_decimal_ptbr",
    "number_format_profile",
    "name_key_strong",
    "key_length_profile",
    "accent_scan",
    "null_profile",
    "expectations_report",
    "csv_charset_roundtrip",
    "byte_pattern_count",
    "file_manifest",
    "raw_to_trusted",
]
RUNS = 3


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        os.environ.get("BENCH_MEMORY", "8g"),
        **{"spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: round(min(run(spark, name, sf_dir) for _ in range(RUNS)), 3) for name in chosen}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_time_of_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
