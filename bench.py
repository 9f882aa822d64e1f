"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each query runs three times, all rows written to a sink
that drops them, and the fastest run counts.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from waymark.catalog import ENTRIES  # noqa: E402
from waymark.session import build_session  # noqa: E402

HEADLINE = [
    "sampler", "preprocess", "geocode_results", "poi_pipeline", "bootstrap_ci", "retry_until_filled", "adaptive_backfill",
    "dedup_count", "component_coverage", "decode_fields_join", "provider_compare", "reverse_lookup", "running_sum_global",
    "row_index", "random_sample",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    folder = tempfile.mkdtemp(prefix="waymark-bench-")
    spark = build_session(
        "waymark-bench", master=f"local[{cpus}]",
        **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            ENTRIES[name].job(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()
    shutil.rmtree(folder, ignore_errors=True)


if __name__ == "__main__":
    main()
