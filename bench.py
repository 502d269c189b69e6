"""Timings of the headline queries: one JSON line for the tables in ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``."""

import json
import os
import statistics
import time

from tierflow import workload
from tierflow.runtime import build_session, clear_scratch

HEADLINE = (
    "top3_categories",
    "category_pivot_events",
    "category_pivot_orders",
    "conditional_pivot_zero",
    "argmax_category",
    "rfm_metrics_events",
    "rfm_metrics_customers",
    "activeness",
    "rfm_scores_global",
    "rfm_scores_by_segment",
    "gold_profile",
    "gold_join",
    "rfm_code_sql",
    "user_lookup_left",
    "json_logs_roundtrip",
    "literal_lines_parse",
    "quality_report",
    "publish_read_back",
    "zorder_keeps_rows",
    "layered_run",
)


def session(cpus):
    spark = build_session(
        "tierflow-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus),
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__sql__warehouse__dir="/tmp/tierflow-bench-warehouse",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(build, repeat):
    """Median time to build and fully run a query; one run before to warm up."""
    times = []
    for attempt in range(repeat + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        if attempt:
            times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def headline():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = session(cpus)
    times = {name: seconds(lambda n=name: workload.QUERIES[n](spark, sf_dir), repeat) for name in HEADLINE}
    clear_scratch(spark)
    spark.stop()
    line = {
        "metric": "headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    headline()
