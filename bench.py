"""Benchmark: build the warehouse once, then time the headline queries warm.

the five marts.  Each query is executed in full through Spark's ``noop``
sink (every row computed, nothing shipped to the driver); after one warm-up
run the median of five runs is reported.  The one-off warehouse build (landing
documents + two committed load cycles + the employer feed) is timed
separately as ``build_sec``.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (default 5).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hiremart.operators import marts, stats  # noqa: E402
from hiremart.plans import fixture_runs as FR  # noqa: E402
from hiremart.session import build_session  # noqa: E402


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(f"local[{cpus}]", app_name="hiremart-bench",
                          shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    t0 = time.perf_counter()
    wh = FR.warehouse_for(spark, sf_dir)
    ods_employers, dim_employer = FR.employer_feed(spark, sf_dir)
    ods_industries = FR.ods_industries(spark, sf_dir)
    committed_star = FR.star_for(spark, sf_dir)
    build_sec = time.perf_counter() - t0

    def star():
        return committed_star

    headline = {
        "vacancies_count": lambda: stats.row_count(wh.ods_postings, "vacancies"),
        "employers_count": lambda: stats.row_count(ods_employers, "employers"),
        "salary_industries_count": lambda: stats.row_count(ods_industries, "salary_industries"),
        "vacancies_by_area": lambda: stats.count_by(wh.ods_postings, "area_name"),
        "vacancies_by_employer": lambda: stats.count_by(wh.ods_postings, "employer_name"),
        "mart_salary": lambda: marts.mart_salary(star()),
        "mart_regions": lambda: marts.mart_regions(star()),
        "mart_trends": lambda: marts.mart_trends(star()),
        "mart_top_employers": lambda: marts.mart_top_employers(star(), k=20),
        "mart_currency": lambda: marts.mart_currency(star()),
    }
    medians: dict[str, float] = {}
    for name, make in headline.items():
        run_noop(make())                      # warm-up
        times = []
        for _ in range(runs):
            t = time.perf_counter()
            run_noop(make())
            times.append(time.perf_counter() - t)
        medians[name] = round(statistics.median(times), 4)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_median_total",
        "value": round(sum(medians.values()), 4),
        "unit": "sec",
        "queries": medians,
        "sf": float(m.group(1)) if m else None,
        "build_sec": round(build_sec, 3),
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
