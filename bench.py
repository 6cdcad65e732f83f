"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` an
optional comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import queries as registered  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "missingness",
    "gate_split",
    "frequency_many",
    "value_sets",
    "casing",
    "numeric_summary",
    "histogram_20",
    "range_flags",
    "sentinel_null",
    "derived_totals",
    "consistency",
    "iqr_flags",
    "dup_rows",
    "dedup_first",
    "value_map",
    "version_diff",
    "classify_sections",
    "typed_table",
    "coercion_report",
    "impute_plan",
    "near_dups_parts",
    "near_dups_titles",
    "near_dups_words",
    "consolidate",
    "data_dictionary",
    "problem_inventory",
    "clean_table",
    "full_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        {
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = registered.queries()
    times: dict[str, float] = {}
    # start the JVM's code paths and the Python workers before the clock
    available["frequency"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in chosen.split(",") if chosen else HEADLINE:
        started = time.perf_counter()
        available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
