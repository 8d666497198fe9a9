"""Time the headline queries; prints one JSON line.

First the star schema is built and written, as its users would; the ``*_gold`` entries are the
business questions on those tables. The other entries run whole jobs from the raw layer.
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the number of cores. Each entry runs
once unmeasured, to warm up the JVM, and then ``BENCH_RUNS`` times, of which the best counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.queries import QUERIES, _trips, all_months, backfilled, month_files
from tripmart.plans import gold, marts, silver
from tripmart.session import keep, new_path, release
from tripmart.sources.tables import bronze_zones

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

FROM_RAW = (
    "q2_revenue_tips",
    "q5_temporal_demand",
    "all_trips",
    "dedupe_trips",
    "clean_trips",
    "zone_conformance",
    "check_accepted_values",
    "check_suite",
    "impute_upper_median",
    "load_counts",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(job: Callable[[], None]) -> float:
    job()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='tripmart-bench-')}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    trips = _trips(spark, FOLDER, silver.VENDOR, silver.DURATION, *silver.MINUTES)
    zones = bronze_zones(spark, FOLDER)
    built = []
    times = {
        "build_gold": best(
            lambda: built.append(gold.build_gold(trips, zones, new_path(spark, "gold")))
        )
    }

    fact, star = built[-1]
    # The same fact in the order of arrival, in as many files, to show what the layout brings.
    files = len(fact.inputFiles())
    arrival = keep(fact.repartition(files), "arrival").df
    month = F.col("pickup_date_sk").between(1200, 1230)
    for name, table in (("clustered", fact), ("arrival", arrival)):
        touched = table.where(month).select(F.col("_metadata.file_path")).distinct().count()
        print(f"{name}: {touched} of {files} files hold the month's rows", file=sys.stderr)
    trips = fact.where(F.col("pickup_date_sk").between(1200, 1230))
    on_gold = {
        "q1_pickup_gold": lambda: run(marts.top_zones_by_month(fact, star)),
        "q1_dropoff_gold": lambda: run(marts.top_zones_by_month(fact, star, "dropoff")),
        "q2_revenue_gold": lambda: run(marts.revenue_tips_by_borough(fact, star)),
        "q2_revenue_one_month_gold": lambda: run(marts.revenue_tips_by_borough(trips, star)),
        "q2_revenue_one_month_unclustered": lambda: run(
            marts.revenue_tips_by_borough(arrival.where(month), star)
        ),
        "q3_speed_gold": lambda: run(marts.average_speed(fact, star)),
        "q4_percentiles_gold": lambda: run(marts.duration_percentiles(fact, star)),
    }
    times |= {name: best(job) for name, job in on_gold.items()}
    times |= {name: best(lambda n=name: run(QUERIES[n](spark, FOLDER))) for name in FROM_RAW}
    source = month_files(spark, FOLDER)
    times["backfill_months"] = best(lambda: backfilled(spark, source, all_months(spark, source)))
    release(spark)
    spark.stop()
    line = {
        "metric": "sum of the best times of all entries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
