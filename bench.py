"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full through the ``noop`` sink (nothing
is collected), once to warm up and then ``BENCH_REPEAT`` times; the median
wall time is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tutorlens.plans import queries as Q  # noqa: E402
from tutorlens.session import local_session  # noqa: E402

HEADLINE = [
    "report_early",
    "report_whole_course",
    "master_early",
    "master_whole_course",
    "early_engagement",
    "early_assessment",
    "clicks_per_student",
    "stratified_split",
    "one_hot_tree",
    "describe_numeric",
    "engagement_by_result",
    "score_by_result",
    "box_clicks_by_result",
    "box_score_by_result",
    "histogram_score",
    "density_score",
    "cleaning_report",
    "value_counts_percent",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = Q.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, int(cpus) * 2))))
    spark = local_session(cores=cpus, shuffle_partitions=partitions, app="tutorlens-bench")
    results = {}
    for name in names:
        run_once(spark, name, sf_dir)
        times = [run_once(spark, name, sf_dir) for _ in range(repeat)]
        results[name] = round(statistics.median(times), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(results.values()), 4),
                "unit": "sec",
                "queries": results,
                "sf": sf,
                "cpus": cpus,
                "repeat": repeat,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
