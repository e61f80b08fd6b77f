"""Times the headline queries: warm session, median of five runs, full results fetched.

Prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from avspark.plans.catalog import QUERIES  # noqa: E402
from avspark.session import build_session  # noqa: E402

HEADLINE = (
    "a1_on_time_by_carrier", "a2_delay_by_route", "a3_monthly_trends",
    "a4_w1_delay_cause_distribution", "a5_hourly_delay_pattern", "a18_sector_load",
)
WIDER = (
    "a6_t6_scale_sweep", "a15_route_cause_pivot", "a22_route_risk", "a23_flight_route_risk",
    "a29_numeric_summary", "j3_asof_weather", "m1_h12_h13_u1_features", "s15_key_checks",
)


def timed(spark, sf_dir, name, runs):
    # Row-level results are computed in full but not moved to the driver.
    fetch = (lambda df: df.collect()) if name in HEADLINE else (
        lambda df: df.write.format("noop").mode("overwrite").save())
    seconds = []
    for _ in range(runs + 1):
        started = time.perf_counter()
        fetch(QUERIES[name](spark, sf_dir))
        seconds.append(time.perf_counter() - started)
    return statistics.median(seconds[1:])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    headline = {name: round(timed(spark, sf_dir, name, 5), 4) for name in HEADLINE}
    wider = {name: round(timed(spark, sf_dir, name, 2), 4) for name in WIDER}
    total = round(sum(headline.values()), 4)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": total, "unit": "sec",
        "queries": {**headline, **wider},
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
        "input_rows": rows,
        "rows_per_sec": {name: round(rows / s) for name, s in headline.items()},
        "cpus": cpus, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
