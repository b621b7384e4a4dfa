"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is executed in full with the ``noop`` sink (no collect), after
one warm-up run of the flagship query (JVM start, code generation).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewatch.plans.catalog import catalog  # noqa: E402
from tidewatch.plans.bench_queries import bench_queries  # noqa: E402
from tidewatch.session import get_spark  # noqa: E402

HEADLINE = [
    "i1_sentiment_counts",      # flagship: panel -> thresholds -> labels
    "i4_features_v3",           # 45 wide features (returns, MAs, ratios)
    "e2_describe",              # exact distributed quantiles
    "i8_drift_report",          # KS / Mann-Whitney / Cohen's d, all features
    "i10_drift_summary",        # feature + target drift summary
    "i15_quality_report",       # data-quality report
    "f5_chrono_split",          # distributed chronological split
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus))
    qs = dict(catalog())
    qs.update(bench_queries())
    names = HEADLINE + [n for n in bench_queries() if n not in HEADLINE]

    def run(name):
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("i1_sentiment_counts")  # warm-up
    times = {n: round(run(n), 3) for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
