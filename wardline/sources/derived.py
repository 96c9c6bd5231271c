"""Domain tables derived from the shared benchmark tables, in SQL that two engines run alike.

Every text below is plain SQL over ``{events}``, ``{orders}`` and so on. Spark binds
the names to DataFrames; the checking engine binds them to its own views.
Money has at most two decimals, miles, forecasts and scores have five, and points stay off
polygon borders, so that results are comparable to the last digit.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW_TRIPS = """
SELECT 't' || CAST(event_id AS STRING) AS trip_id,
  'x' || CAST(user_id % 40 AS STRING) AS taxi_id,
  CASE WHEN event_id % 3 = 0 THEN 'taxi' ELSE 'tnp' END AS source_dataset,
  ts AS trip_start_timestamp,
  ts + INTERVAL '1' SECOND * CAST(CASE WHEN event_id % 113 = 0 THEN -60
    ELSE 30 + (event_id * 37) % 4000 END AS INT) AS trip_end_timestamp,
  CASE WHEN event_id % 107 = 0 THEN 0 WHEN event_id % 109 = 0 THEN 120000
    ELSE 30 + (event_id * 37) % 4000 END AS trip_seconds,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN -1e0
    WHEN event_id % 103 = 0 THEN 600e0
    ELSE (floor(value * 10e0) * 1000e0 + (event_id * 7919) % 499) / 100000e0 END AS trip_miles,
  CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN 1500e0
    WHEN event_id % 79 = 0 THEN -5e0 ELSE 3e0 + floor(value * 25e0) / 100e0 END AS fare,
  CASE WHEN event_id % 73 = 0 THEN -1e0 ELSE 4e0 + floor(value * 33e0) / 100e0 END AS trip_total,
  floor(value * 5e0) / 100e0 AS tips,
  CASE WHEN event_id % 50 = 0 THEN '' ELSE CAST(1 + user_id % 77 AS STRING) END AS pickup_community_area,
  CAST(1 + (user_id + event_id) % 77 AS STRING) AS dropoff_community_area,
  CASE WHEN event_id % 127 = 0 THEN NULL
    ELSE 41.555e0 + ((event_id * 7919) % 60) / 100e0 END AS pickup_centroid_latitude,
  -87.9975e0 + ((event_id * 10473) % 55) / 100e0 AS pickup_centroid_longitude,
  41.555e0 + ((event_id * 6131) % 60) / 100e0 AS dropoff_centroid_latitude,
  -87.9975e0 + ((event_id * 3571) % 55) / 100e0 AS dropoff_centroid_longitude,
  event_id % 4 = 0 AS shared_trip_authorized,
  1 + event_id % 3 AS trips_pooled,
  CASE event_type WHEN 'purchase' THEN 'Credit Card' WHEN 'click' THEN 'Mobile' ELSE 'Cash' END AS payment_type,
  'Company ' || CAST(user_id % 7 AS STRING) AS company
FROM {events}
"""

RAW_PERMITS = """
SELECT 'p' || CAST(o_orderkey AS STRING) AS id,
  CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE 'N' || CAST(o_orderkey AS STRING) END AS permit_,
  'r' || CAST(o_orderkey AS STRING) AS row_id,
  o_orderstatus AS permit_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'PERMIT - NEW CONSTRUCTION'
    WHEN '2-HIGH' THEN 'PERMIT - RENOVATION/ALTERATION' WHEN '3-MEDIUM' THEN 'PERMIT - WRECKING/DEMOLITION'
    WHEN '4-NOT SPECIFIED' THEN 'PERMIT - SIGNS' ELSE 'PERMIT - ELECTRICAL WIRING' END AS permit_type,
  CASE WHEN o_orderkey % 7 = 0 THEN 'New Construction shell' ELSE 'Interior' END AS work_type,
  'work ' || CAST(o_orderkey % 100 AS STRING) AS work_description,
  CAST(NULL AS STRING) AS permit_condition,
  CAST(o_orderdate - INTERVAL '1' DAY * CAST(o_orderkey % 90 AS INT) AS DATE) AS application_start_date,
  CAST(o_orderdate AS DATE) AS issue_date,
  o_orderkey % 90 AS processing_time,
  o_orderkey % 9999 AS street_number, 'N' AS street_direction,
  'STREET ' || CAST(o_custkey % 50 AS STRING) AS street_name,
  CASE WHEN o_orderkey % 40 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN 0e0 WHEN o_orderkey % 43 = 0 THEN -10e0
    WHEN o_orderkey % 47 = 0 THEN 20000000e0 ELSE floor(o_totalprice * 2e0) / 100e0 END AS total_fee,
  CASE WHEN o_orderkey % 25 = 0 THEN 0e0 WHEN o_orderkey % 53 = 0 THEN NULL
    ELSE floor(o_totalprice / 1000e0) * 4000e0 END AS reported_cost,
  CAST(NULL AS STRING) AS pin_list,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN 99
    ELSE 1 + o_custkey % 77 END AS community_area,
  CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE 41.555e0 + ((o_orderkey * 7919) % 60) / 100e0 END AS latitude,
  -87.9975e0 + ((o_orderkey * 10473) % 55) / 100e0 AS longitude,
  CAST(o_orderdate AS TIMESTAMP) AS extracted_at
FROM {orders}
"""

# 2023-12-31 is a Sunday, so whole weeks counted from it start on Sundays.
RAW_COVID = """
SELECT zip_code, CAST(w + 1 AS BIGINT) AS week_number,
  CAST(DATE '2023-12-31' + INTERVAL '1' DAY * (7 * w) AS DATE) AS week_start,
  CAST(DATE '2023-12-31' + INTERVAL '1' DAY * (7 * w + 6) AS DATE) AS week_end,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS cases_weekly,
  CAST(count(*) AS BIGINT) AS tests_weekly,
  CAST(sum(CASE WHEN event_type = 'purchase' AND value > 80 THEN 1 ELSE 0 END) AS BIGINT) AS deaths_weekly,
  CAST(3000 + 737 * max(z) AS BIGINT) AS population,
  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) * 100000e0 / (3000 + 737 * max(z)) AS case_rate_weekly,
  5e0 AS percent_tested_positive_weekly,
  zip_code || '-' || CAST(w AS STRING) AS row_id
FROM (SELECT CAST(60601 + user_id % 25 AS STRING) AS zip_code, CAST(floor(dayofyear(ts) / 7e0) AS INT) AS w,
        user_id % 25 AS z, event_type, value FROM {events})
GROUP BY zip_code, w
"""

ZIP_BOXES = """
SELECT CASE n_nationkey WHEN 22 THEN 60666 WHEN 23 THEN 60638 WHEN 24 THEN 60018 ELSE 60601 + n_nationkey END AS zip,
  -87.95e0 + (n_nationkey % 5) * 0.09e0 AS x0, -87.95e0 + (n_nationkey % 5 + 1) * 0.09e0 AS x1,
  41.6e0 + floor(n_nationkey / 5e0) * 0.1e0 AS y0, 41.6e0 + (floor(n_nationkey / 5e0) + 1) * 0.1e0 AS y1
FROM {nation}
"""

AREA_BOXES = """
SELECT n_nationkey + 1 AS area_numbe, n_name AS community,
  -87.93e0 + (n_nationkey % 5) * 0.09e0 AS x0, -87.93e0 + (n_nationkey % 5 + 1) * 0.09e0 AS x1,
  41.62e0 + floor(n_nationkey / 5e0) * 0.1e0 AS y0, 41.62e0 + (floor(n_nationkey / 5e0) + 1) * 0.1e0 AS y1
FROM {nation}
"""

HOOD_BOXES = """
SELECT r_name AS pri_neigh, r_name || ' SIDE' AS sec_neigh,
  -87.95e0 + r_regionkey * 0.09e0 AS x0, -87.95e0 + (r_regionkey + 1) * 0.09e0 AS x1,
  41.6e0 AS y0, 42.1e0 AS y1
FROM {region}
"""

WARD_BOXES = """
SELECT n_nationkey + 1 AS ward, 'Member for ' || n_name AS alderman,
  -87.96e0 + (n_nationkey % 5) * 0.09e0 AS x0, -87.96e0 + (n_nationkey % 5 + 1) * 0.09e0 AS x1,
  41.58e0 + floor(n_nationkey / 5e0) * 0.11e0 AS y0, 41.58e0 + (floor(n_nationkey / 5e0) + 1) * 0.11e0 AS y1
FROM {nation}
"""

TRACT_BOXES = """
SELECT CAST(10000 + n_nationkey * 100 AS STRING) AS tractce10,
  -87.94e0 + (n_nationkey % 5) * 0.08e0 AS x0, -87.94e0 + (n_nationkey % 5 + 1) * 0.08e0 AS x1,
  41.63e0 + floor(n_nationkey / 5e0) * 0.09e0 AS y0, 41.63e0 + (floor(n_nationkey / 5e0) + 1) * 0.09e0 AS y1
FROM {nation}
"""

RAW_CCVI = """
SELECT kind AS geography_type, place AS community_area_or_zip, max(score) AS ccvi_score,
  CASE WHEN max(score) >= 30e0 THEN 'HIGH' WHEN max(score) >= 15e0 THEN 'MEDIUM' ELSE 'LOW' END AS ccvi_category,
  'POINT (-87.' || CAST(max(s_suppkey) AS STRING) || ' 41.8)' AS location
FROM (SELECT s_suppkey, 4e0 + (s_suppkey * 7) % 60 AS score,
        CASE WHEN s_suppkey % 2 = 0 THEN 'CA' ELSE 'ZIP' END AS kind,
        CASE WHEN s_suppkey % 2 = 0 THEN CAST(1 + s_suppkey % 77 AS STRING)
          ELSE CAST(60601 + s_suppkey % 25 AS STRING) END AS place
      FROM {supplier})
GROUP BY kind, place
"""

RAW_HEALTH = """
SELECT n_nationkey + 1 AS community_area, n_name AS community_area_name,
  CASE WHEN n_nationkey % 11 = 7 THEN NULL ELSE 20000e0 + n_nationkey * 1500e0 END AS per_capita_income,
  5e0 + (n_nationkey * 7) % 11 AS unemployment, 10e0 + (n_nationkey * 3) % 17 AS below_poverty_level
FROM {nation}
"""

TRAFFIC_FORECASTS = """
SELECT zip_code, forecast_date, 'daily' AS forecast_type, (n * 100000 + n * 7919 % 100000) / 100000e0 AS yhat,
  (n * 80000 + n * 6131 % 10000) / 100000e0 AS yhat_lower, (n * 120000 + n * 3571 % 100000) / 100000e0 AS yhat_upper,
  10e0 + n % 4 AS trend, n % 7 / 10e0 AS yearly, n % 5 / 10e0 AS weekly,
  DATE '2024-01-09' AS model_trained_date, CAST(400 + n AS BIGINT) AS training_days, 'v1' AS model_version
FROM (SELECT CAST(CASE user_id % 25 WHEN 22 THEN 60666 WHEN 24 THEN 60018 ELSE 60601 + user_id % 25 END AS STRING) AS zip_code,
        CAST(CAST(ts AS DATE) + INTERVAL '1' DAY * CAST(30 * (event_id % 4) AS INT) AS DATE) AS forecast_date,
        CAST(count(*) AS BIGINT) AS n
      FROM {events} GROUP BY 1, 2)
"""

COVID_FORECASTS = """
SELECT zip_code, forecast_date, risk AS predicted_risk_score,
  CASE WHEN risk < 0.5e0 THEN 'Low' WHEN risk < 1.5e0 THEN 'Medium' ELSE 'High' END AS predicted_risk_category,
  n * 3e0 AS predicted_case_rate, n % 10 * 1e0 AS predicted_positivity_rate,
  CASE WHEN risk > 0.3e0 THEN risk - 0.3e0 ELSE 0e0 END AS risk_score_lower, risk + 0.4e0 AS risk_score_upper,
  n * 150e0 AS predicted_mobility_index, cases AS predicted_cases_weekly, n AS predicted_tests_weekly,
  CASE WHEN risk >= 2e0 THEN 'CRITICAL' WHEN risk >= 1.5e0 THEN 'WARNING' WHEN risk >= 0.8e0 THEN 'CAUTION'
    ELSE 'NONE' END AS alert_level,
  'ZIP ' || zip_code AS alert_message, DATE '2024-01-09' AS model_trained_date,
  CAST(60 + n AS BIGINT) AS training_weeks, 'v1' AS model_version
FROM (SELECT zip_code, forecast_date, n, cases, ((n * 7) % 31 * 10000 + (n * 7919) % 10000) / 100000e0 AS risk FROM (
        SELECT CAST(60601 + user_id % 25 AS STRING) AS zip_code,
          CAST(DATE '2024-01-01' + INTERVAL '1' DAY * CAST(7 * (event_id % 12) AS INT) AS DATE) AS forecast_date,
          CAST(count(*) AS BIGINT) AS n,
          CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS cases
        FROM {events} GROUP BY 1, 2))
"""

FORECAST_METRICS = """
SELECT CASE WHEN z % 2 = 0 THEN 'traffic_forecast_zip_' ELSE 'covid_risk_forecast_zip_' END
    || CAST(60601 + z AS STRING) AS model_name,
  'v' || CAST(z % 3 AS STRING) AS model_version, DATE '2024-01-10' AS trained_date,
  first_day AS train_start_date, last_day AS train_end_date, n AS training_records,
  n % 97 / 10e0 AS mae, n % 89 / 10e0 AS rmse, n % 83 / 4e0 AS mape, n % 101 / 100e0 AS r_squared,
  CAST(60601 + z AS STRING) AS zip_code, 'holdout of one fifth' AS notes
FROM (SELECT user_id % 25 AS z, CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day,
        CAST(count(*) AS BIGINT) AS n FROM {events} GROUP BY 1)
"""

# A long daily history per ZIP: several years of ship dates.
DAILY_HISTORY = """
SELECT CAST(60601 + l_suppkey % 25 AS STRING) AS zip_code, CAST(l_shipdate AS DATE) AS trip_date,
  CAST(count(*) AS BIGINT) AS trip_count
FROM {lineitem} GROUP BY 1, 2
"""

# A long weekly risk history per ZIP; 1994-12-25 is a Sunday.
WEEKLY_HISTORY = """
SELECT zip_code, CAST(DATE '1994-12-25' + INTERVAL '1' DAY * (7 * w) AS DATE) AS week_start,
  CAST(n AS BIGINT) AS cases_weekly, CAST(3 * n AS BIGINT) AS tests_weekly, n * 10e0 AS case_rate_weekly,
  n % 23 / 8e0 AS adjusted_risk_score, CAST(5 * n AS BIGINT) AS total_trips_from_zip,
  CAST(6 * n AS BIGINT) AS total_trips_to_zip, 'Low' AS risk_category, CAST(1000 AS BIGINT) AS population
FROM (SELECT CAST(60601 + l_suppkey % 25 AS STRING) AS zip_code,
        CAST(floor((year(l_shipdate) * 365e0 + dayofyear(l_shipdate) - 1995 * 365e0) / 7e0) AS INT) AS w,
        count(*) AS n FROM {lineitem} GROUP BY 1, 2)
"""

# Whole-number pairs of actual and predicted values, for the error metrics.
PREDICTIONS = """
SELECT CAST(60601 + l_suppkey % 25 AS STRING) AS zip_code, l_quantity AS actual,
  l_linenumber * 6e0 + l_partkey % 11 AS predicted
FROM {lineitem}
"""

FILE_MANIFEST = """
SELECT dataset || '/' || CAST(partition_date AS STRING) || '/batch_001.json' AS file_uri, dataset, partition_date,
  row_count, row_count * 180 AS size_bytes,
  CASE WHEN row_count % 5 = 0 THEN 'failed' ELSE 'passed' END AS validation_status,
  CASE WHEN row_count % 5 = 0 THEN 5 ELSE 7 END AS validation_checks_passed,
  CASE WHEN row_count % 5 = 0 THEN 2 ELSE 0 END AS validation_checks_failed,
  row_count % 5 <> 0 AS loaded_to_bronze, created_at,
  CASE WHEN row_count % 5 = 0 THEN 'quarantined' ELSE 'bronze' END AS processing_stage,
  row_count % 5 = 0 AS quarantined
FROM (SELECT CASE WHEN event_id % 3 = 0 THEN 'taxi' WHEN event_id % 3 = 1 THEN 'tnp' ELSE 'covid' END AS dataset,
        CAST(ts AS DATE) AS partition_date, CAST(count(*) AS BIGINT) AS row_count, max(ts) AS created_at
      FROM {events} GROUP BY 1, 2)
"""

TEXTS = {
    "raw_trips": RAW_TRIPS,
    "raw_permits": RAW_PERMITS,
    "raw_covid": RAW_COVID,
    "zip_boxes": ZIP_BOXES,
    "area_boxes": AREA_BOXES,
    "hood_boxes": HOOD_BOXES,
    "ward_boxes": WARD_BOXES,
    "tract_boxes": TRACT_BOXES,
    "raw_ccvi": RAW_CCVI,
    "raw_health": RAW_HEALTH,
    "traffic_forecasts": TRAFFIC_FORECASTS,
    "covid_forecasts": COVID_FORECASTS,
    "forecast_metrics": FORECAST_METRICS,
    "daily_history": DAILY_HISTORY,
    "weekly_history": WEEKLY_HISTORY,
    "predictions": PREDICTIONS,
    "file_manifest": FILE_MANIFEST,
}


# Declared, so that opening a table runs no job to look at its footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def derive(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text = TEXTS[name]
    inputs = {t: table(spark, folder, t) for t in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **inputs)


def plain_sql(name: str) -> str:
    """The same text with bare table names, for the checking engine."""
    return re.sub(r"\{(\w+)\}", r"\1", TEXTS[name]).strip()
