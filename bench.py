"""Times the headline queries on local cores and prints one JSON line.

BENCH_SF_DIR is the data folder and BENCH_CPUS the number of cores. Each query is
planned and fully computed; results are discarded without a collect.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from wardline.plans import catalog
from wardline.session import local_session

HEADLINE = [
    "bronze_tnp_trips",
    "silver_trips_enriched",
    "silver_permits_enriched",
    "gold_taxi_hourly_by_zip",
    "gold_taxi_daily_by_zip",
    "gold_route_pairs",
    "gold_covid_hotspots",
    "gold_loan_targets_v1",
    "gold_forecasts",
    "crosswalk_community_zip",
    "permits_upsert",
    "permits_clean",
    "taxi_clean",
    "rush_hour_iqr",
    "v_ccvi_pooled_rides",
    "v_ccvi_trip_activity",
    "daily_trip_metrics",
    "quality_check_table",
    "covid_risk_trend",
    "traffic_model_forecast",
    "covid_model_simple",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores, shuffle_partitions=cores)
    fns = catalog.queries()
    # One small query first, so that the first timing is not the engine's start.
    fns["covid_export"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        fns[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
